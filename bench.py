"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.  Every query is
written to Spark's no-op sink, so that all rows and columns are computed and
nothing passes through the driver.  The stage tables that marts read (cells,
observations, issues) are timed as entries of their own.
"""

from __future__ import annotations

import json
import os
import sys
import time

from sheetloom.session import local_session

HEADLINE = [
    "coerce_date", "coerce_float", "coerce_str", "evaluate_pass", "map_meta_labels",
    "sheet_profiles", "column_mapping_log", "row_meta", "observations_long", "dq_issues",
    "misc_rows", "dim_batch", "dim_analyte", "mv_batch_pass_rate", "mv_impurity_trend",
    "mv_spec_violations", "quarantine_review", "compliance_summary", "export_manifest",
    "cells_to_pass_rate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, app="sheetloom-bench")
    spark.sparkContext.setLogLevel("ERROR")

    from catalogue import stages
    from catalogue.grids import cells_table
    from catalogue.queries import QUERIES

    def timed(run) -> float:
        start = time.perf_counter()
        run()
        return round(time.perf_counter() - start, 3)

    spark.read.parquet(f"{sf_dir}/nation.parquet").count()      # start the session up
    times = {
        "stage_cells": timed(lambda: cells_table(spark, sf_dir)),
        "stage_profiles_and_mappings": timed(lambda: stages.silver(spark, sf_dir)),
        "stage_observations": timed(lambda: stages.observations(spark, sf_dir)),
        "stage_issues": timed(lambda: stages.issues(spark, sf_dir)),
    }
    for name in HEADLINE:
        times[name] = timed(lambda: QUERIES[name](spark, sf_dir)
                            .write.format("noop").mode("overwrite").save())
        print(f"{name}: {times[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
