"""What the plans and the times of the workbook part must look like."""

import re
import time

import pytest

from catalogue import stages
from catalogue.grids import GRIDS
from catalogue.queries import QUERIES
from grids import cells_frame, standard_sheet
from pyspark.sql import functions as F
from sheetloom import session
from sheetloom.operators import facts, profile
from sheetloom.plans import gold, reports
from sheetloom.plans.silver import SilverTables, clean


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def outputs(done):
    return {"row_meta": done.row_meta, "observations": done.observations_keyed, "issues": done.issues_keyed,
            "misc_rows": done.misc_rows}


def sample(spark, sheets=3):
    flat = {(2, c): n for c, n in enumerate(["A", "B", "C", "D"], 1)} | {(4 + i, 2): f"v{i}" for i in range(9)}
    rows = [{1: i, 5: f"#{i}", 12: i / 10, 13: " 1"} for i in range(1, 20)]
    grids = {("w.xlsx", f"s{i}"): standard_sheet(["Impurity", "TFMBA"], rows) for i in range(sheets)}
    return cells_frame(spark, grids | {("w.xlsx", "f"): flat})


@pytest.mark.parametrize("limit", [session.BROADCAST_ENTRIES, 0])
def test_stored_rows_are_not_moved_again(spark, monkeypatch, limit):
    lazily = clean(sample(spark))
    expected = {name: sorted(map(str, df.collect())) for name, df in outputs(lazily).items()}
    original = session.broadcast_within
    monkeypatch.setattr(facts, "broadcast_within", lambda df, entries: original(df, entries, limit))
    kept = lazily.keep_rows()
    for name, df in outputs(kept).items():
        plan = plan_of(df)
        # only plans are dealt, and only where they are too many to be sent
        dealt = plan.count("Exchange hashpartitioning")
        assert dealt == 0 if limit else dealt == plan.count("Bucketed: true") > 0, name
        assert sorted(map(str, df.collect())) == expected[name], name


def test_columns_and_mappings_need_no_rows(spark, monkeypatch):
    def refuse(self):
        raise AssertionError("rows are packed")

    monkeypatch.setattr(SilverTables, "keep_rows", refuse)
    monkeypatch.setattr(stages, "_cleaned", {})
    monkeypatch.setattr(stages, "_packed", {})
    for name in ("analyte_columns", "parse_mapping_responses"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_buckets_follow_the_stored_size(spark, monkeypatch):
    lazily = clean(session.durable(sample(spark)))
    expected = {name: sorted(map(str, df.collect())) for name, df in outputs(lazily).items()}
    assert session.partitions_for(lazily.cells) == 4
    assert session.partitions_for(sample(spark).repartition(3).rdd.toDF(lazily.cells.schema)) == 4     # of unknown size
    monkeypatch.setattr(session, "PARTITION_BYTES", -(-session._stored_bytes(lazily.cells) // 9))
    more = session.partitions_for(lazily.cells)
    assert more > 4 and f", {more}), REPARTITION_BY_NUM" in plan_of(lazily.packed)
    for name, df in outputs(lazily.keep_rows()).items():
        assert "Exchange hashpartitioning" not in plan_of(df), name
        assert sorted(map(str, df.collect())) == expected[name], name


def test_a_run_moves_the_cells_once(spark):
    done = clean(sample(spark))
    packing = plan_of(done.packed)
    assert packing.count("Exchange hashpartitioning(workbook") == 1
    kept = done.keep_rows()
    assert sum(plan_of(df).count("Exchange hashpartitioning") for df in outputs(kept).values()) == 0


def test_no_broadcast_hint_for_many_tall_sheets(spark, tmp_path):
    flat = spark.range(20_000).selectExpr(
        "'w' as workbook", "cast(id as string) as sheet", "'misc_flat' as layout", "3 as flat_header_row",
        "1000000 as max_row")
    flat.write.parquet(str(tmp_path / "classified"))
    classified = spark.read.parquet(str(tmp_path / "classified"))
    cells = cells_frame(spark, {("w", "1"): {(3, 1): "a"}})
    rows = profile.flat_extents(cells, classified)._jdf.queryExecution()
    logical = rows.optimizedPlan().toString()
    assert "explode" not in logical.lower() and "sequence" not in logical
    # one short row a sheet may be sent, for its header rows; nothing that grows with the height
    plans = spark.range(20_000).selectExpr("array_repeat(1, 20) as analytes")
    assert session.broadcast_within(plans, F.size("analytes")) is None
    assert session.broadcast_within(plans.limit(50), F.size("analytes")) is not None
    many = spark.range(session.BROADCAST_ROWS + 1)
    many.write.parquet(str(tmp_path / "many"))
    stored = spark.read.parquet(str(tmp_path / "many"))
    small = session.broadcast_if_small(stored.select("id"), stored)
    assert "broadcast" not in small._jdf.queryExecution().logical().toString().lower()


def largest_method(spark, df) -> int:
    """Bytes of the largest method generated for a plan; the JVM never compiles one beyond 8,000."""
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        planned = df.select("*")._jdf.queryExecution()
        text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(planned, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text)))


def test_methods_of_the_grids_are_compiled(spark):
    for name, grid in GRIDS.items():
        assert 0 < largest_method(spark, grid(spark, "/root/testdata/sf0.001")) <= 8000, name


def test_methods_of_the_quality_log_are_compiled(spark):
    done = clean(sample(spark)).keep_rows()
    for name, df in outputs(done).items():
        assert 0 < largest_method(spark, df) <= 8000, name


@pytest.mark.parametrize("mart", [gold.mv_spec_violations, gold.mv_batch_pass_rate, reports.first_violations])
def test_methods_behind_a_filter_on_the_verdict_are_compiled(spark, mart):
    assert 0 < largest_method(spark, mart(clean(sample(spark)).observations_keyed)) <= 8000


def test_the_second_pass_over_observations_finds_them_stored(spark, monkeypatch):
    for name, empty in (("_packed", {}), ("_stored", {}), ("_passed", set())):
        monkeypatch.setattr(stages, name, empty)
    first, second = (stages.observations_once(spark, "/root/testdata/sf0.001") for _ in range(2))
    assert "ObjectHashAggregate" in plan_of(first) and "ObjectHashAggregate" not in plan_of(second)
    assert first.columns == second.columns and first.exceptAll(second).isEmpty() and first.count() == second.count()


def test_a_column_mapped_in_both_roles_is_logged_in_both(spark):
    done = clean(sample(spark, 1))
    both = done.plans.withColumn("metas", F.transform("metas", lambda m, i: F.when(
        i == 12, F.struct(F.lit("Also").alias("label"), F.lit("batch_no").alias("canonical"))).otherwise(m)))
    issues = facts.dq_issues(facts.planned_rows(done.packed, both)).where("column_index = 13")
    counted = {(r["column"], r.rule, r.repaired_value): r.n for r in issues.groupBy(
        "column", "rule", "repaired_value").agg(F.count("*").alias("n")).collect()}
    assert counted == {("TFMBA", "whitespace", "1.0"): 19, ("batch_no", "whitespace", "1"): 19}


def test_only_flat_sheets_have_bitmaps(spark):
    done = clean(sample(spark))
    classified = session.durable(profile.classify(profile.header_bands(done.cells)))
    extents = profile.flat_extents(done.cells, classified)
    assert plan_of(extents).count("LeftSemi") == 1
    assert [(r.sheet, r.flat_rows) for r in extents.collect()] == [("f", 9)]


def test_bitmaps_equal_rows_counted_one_by_one(spark):
    import random
    rng = random.Random(3)
    grids = {}
    for i in range(12):
        header = rng.choice([3, 5, 7])
        grid = {(header, c): f"label {c}" for c in range(1, 6)}
        for _ in range(rng.choice([0, 1, 30, 200])):
            grid[(header + 1 + rng.randrange(300), rng.randint(1, 7))] = rng.choice(["x", "", "y"])
        grids[("w.xlsx", f"f{i}")] = grid
    found = {r.sheet: (r.data_start_row, r.n_data_rows)
             for r in profile.sheet_profiles(cells_frame(spark, grids)).collect()}
    for (_, sheet), grid in grids.items():
        header = min(r for r, c in grid if c == 1 and str(grid[(r, c)]).startswith("label"))
        filled = {r for (r, c), v in grid.items() if r > header and c <= 5 and v != ""}
        last = max([header, *[r for r, _ in grid]])
        assert found[sheet] == (min(filled, default=last + 1), len(filled)), sheet


def wide_cells(spark, width, rows):
    """A standard sheet of ``width`` columns, every cell filled."""
    header = {4: "Impurity", 5: 1.0, 9: "Max", 10: 0.5}
    labels = ["Date of Sampling", "Time of sampling", "Time of Reporting", "Batch No.", "Instrument ID", "Stage"]
    top = [(4, c + 2, "s", None, n) for c, n in enumerate(labels)]
    top += [(5, 1, "s", None, "RT"), (9, 1, "s", None, "Specification"), (4, 1, "s", None, "No")]
    head = spark.createDataFrame(top, "row int, col int, kind string, num double, raw string")
    band = spark.range(10, width + 1).selectExpr("cast(id as int) as col")
    for row, value in header.items():
        text = isinstance(value, str)
        head = head.unionByName(band.selectExpr(
            f"{row} as row", "col", f"'{'s' if text else 'n'}' as kind",
            "cast(null as double) as num" if text else f"double({value}) as num", f"'{value}' as raw"))
    data = spark.range(rows).crossJoin(spark.range(1, width + 1).withColumnRenamed("id", "c")).selectExpr(
        "cast(13 + id as int) as row", "cast(c as int) as col", "'n' as kind", "double(1) as num", "'1' as raw")
    return head.unionByName(data).selectExpr(
        "'w.xlsx' as workbook", "'s' as sheet", "1 as sheet_pos", "row", "col", "kind", "num",
        "cast(null as timestamp_ntz) as dt", "cast(null as string) as tm", "raw")


def test_time_for_a_row_is_linear_in_its_width(spark):
    seconds = {}
    for width in (2_000, 16_000):
        done = clean(wide_cells(spark, width, 24)).keep_rows()
        assert done.observations_keyed.count() == 24 * (width - 9)
        for df in (done.observations_keyed, done.issues_keyed):
            df.write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        for df in (done.observations_keyed, done.issues_keyed):
            df.write.format("noop").mode("overwrite").save()
        seconds[width] = time.perf_counter() - start
    # eight times the width; 64 times the time were quadratic
    assert seconds[16_000] < 20 * seconds[2_000] + 1, seconds


def test_cells_at_one_address_are_logged(spark):
    grid = standard_sheet(["Impurity"], [{1: 1, 5: "#1", 12: 0.5}, {1: 2, 5: "#2", 12: 0.25}])
    flat = {(2, c): n for c, n in enumerate(["A", "B", "C", "D"], 1)} | {(3, 1): "x", (3, 2): "y"}
    cells = cells_frame(spark, {("w.xlsx", "s"): grid, ("w.xlsx", "f"): flat})
    again = cells.where("row in (3, 13) and col in (2, 5, 12)").withColumn(
        "raw", F.when(F.col("col") == 12, "0.75").otherwise(F.col("raw"))).withColumn(
        "num", F.when(F.col("col") == 12, 0.75))
    done = clean(cells.unionByName(again))
    got = {(r.sheet, r.row, r.column_index, r.column, r.severity, r.raw_value, r.repaired_value)
           for r in done.issues_keyed.where(F.col("rule") == facts.DUPLICATE_RULE).collect()}
    assert got == {("s", 13, 5, "batch_no", "info", "#1", "#1"), ("s", 13, 12, "Impurity", "warning", "0.5", "0.75"),
                   ("f", 3, 2, "B", "info", "y", "y")}
    values = [r.value for r in done.observations_keyed.orderBy("row").collect()]
    assert values == [0.75, 0.25]
    assert clean(cells).issues_keyed.where(F.col("rule") == facts.DUPLICATE_RULE).count() == 0
