"""The medallion run: workbooks → bronze → silver → gold → export.

Each layer is written as tables and the next one reads them, so a lost executor
costs at most the stage at hand and no layer recomputes another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetloom.operators.facts import published_issues
from sheetloom.operators.responses import Responder
from sheetloom.plans import gold
from sheetloom.plans.gold import quarantine_sql
from sheetloom.plans.reports import unanswered_sheets
from sheetloom.plans.silver import clean
from sheetloom.sources.canonical import CanonicalNames, DEFAULT_NAMES
from sheetloom.sources.folder import list_files, workbook_catalog
from sheetloom.sources.tables import Layout, create_layers, create_view, export_workbooks, save_table
from sheetloom.sources.xlsx import read_workbooks


def run_bronze(spark: SparkSession, folder: str, *, layout: Layout = Layout()) -> DataFrame:
    """Decode the files of a folder once; catalogue them from the result."""
    create_layers(spark, layout)
    cells = save_table(read_workbooks(spark, folder), "bronze", "cells", layout=layout)
    save_table(workbook_catalog(cells, list_files(spark, folder, ".xlsx")),
               "bronze", "raw_workbooks", layout=layout, skip_empty=True)
    return cells


def run_silver(cells: DataFrame, *, names: CanonicalNames = DEFAULT_NAMES,
               responder: Responder | None = None, replies: str | None = None,
               layout: Layout = Layout()) -> dict[str, DataFrame]:
    spark = cells.sparkSession
    create_layers(spark, layout)
    result = clean(cells, names=names, responder=responder, replies=replies).keep_rows()
    tables = {
        "sheet_profiles": result.profiles,
        "column_mapping_log": result.mappings,
        "unanswered_sheets": unanswered_sheets(result.profiles, result.mappings),
        "observations_long": result.observations_keyed,
        "dq_issues": result.issues_keyed,
        "misc_rows": result.misc_rows,
    }
    saved = {name: save_table(df, "silver", name, layout=layout) for name, df in tables.items()}
    saved["quarantine_review"] = create_view(
        spark, "silver", "quarantine_review",
        quarantine_sql(layout.name("silver", "column_mapping_log"), layout.name("silver", "dq_issues")),
        layout=layout)
    return saved


def run_gold(spark: SparkSession, *, layout: Layout = Layout()) -> dict[str, DataFrame]:
    observations = spark.table(layout.name("silver", "observations_long"))
    fact = save_table(gold.fact_observation(observations), "gold", "fact_observation", layout=layout)
    marts = {
        "dim_batch": gold.dim_batch(observations),
        "dim_analyte": gold.dim_analyte(observations),
        "mv_batch_pass_rate": gold.mv_batch_pass_rate(fact),
        "mv_impurity_trend": gold.mv_impurity_trend(fact),
        "mv_spec_violations": gold.mv_spec_violations(fact),
    }
    return {"fact_observation": fact,
            **{name: save_table(df, "gold", name, layout=layout) for name, df in marts.items()}}


def run_export(spark: SparkSession, folder: str, fmt: str = "parquet", *,
               layout: Layout = Layout()) -> None:
    """Cleaned tables of every workbook, the facts as the gold layer publishes them."""
    export_workbooks({
        "observations": spark.table(layout.name("gold", "fact_observation")),
        "dq_issues": published_issues(spark.table(layout.name("silver", "dq_issues"))),
        "column_mapping_log": spark.table(layout.name("silver", "column_mapping_log")),
        "misc": spark.table(layout.name("silver", "misc_rows")),
    }, folder, fmt)


def run_all(spark: SparkSession, source: str, target: str, *, fmt: str = "parquet",
            names: CanonicalNames = DEFAULT_NAMES, responder: Responder | None = None,
            replies: str | None = None, layout: Layout = Layout()) -> None:
    cells = run_bronze(spark, source, layout=layout)
    run_silver(cells, names=names, responder=responder, replies=replies, layout=layout)
    run_gold(spark, layout=layout)
    run_export(spark, target, fmt, layout=layout)
