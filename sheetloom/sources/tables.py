"""Sinks: medallion tables, CSV folders and per-workbook exports."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetloom.functions.coerce import serialize
from sheetloom.session import durable

LAYERS = ["bronze", "silver", "gold"]


@dataclass(frozen=True)
class Layout:
    """Where tables live and how they are stored: an optional catalogue in front of the
    layer, an optional prefix of the layer's name, and a table format (the session's
    default where none is given)."""

    catalog: str | None = None
    prefix: str = ""
    table_format: str | None = None

    def layer(self, layer: str) -> str:
        own = f"`{self.prefix}{layer}`"
        return f"`{self.catalog}`.{own}" if self.catalog else own

    def name(self, layer: str, table: str) -> str:
        return f"{self.layer(layer)}.`{table}`"


# Row order within an export.
EXPORT_ORDER = {
    "observations": ["sheet", "row_seq", "analyte"],
    "dq_issues": ["sheet", "row_seq"],
    "column_mapping_log": ["sheet", "column_index"],
    "misc": ["sheet", "row_seq"],
}


def create_layers(spark: SparkSession, layout: Layout = Layout()) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layout.layer(layer)}")


# Formats that replace a table, schema included, in one commit of their own.
TRANSACTIONAL = {"delta", "iceberg", "hudi"}
VERSION = "table_version"       # property of a table's view: the version that it shows


def save_table(df: DataFrame, layer: str, table: str, *, layout: Layout = Layout(),
               skip_empty: bool = False) -> DataFrame:
    """Replace a table, schema included, and read it back.

    Readers see the old rows or the new ones, never a mixture or nothing: the rows are
    written as a table of their own, ``<table>__v...``, and the table's name is a view that
    is pointed to it last.  A run that fails or is lost before that leaves the old table as
    it was, and a table may be rewritten from itself.  The version before stays for those
    who are still reading it, older ones go.  A transactional format does all this itself.

    With ``skip_empty`` an existing table is left alone when there is no row; the result
    is then stored once and looked at, not computed twice.
    """
    spark, name = df.sparkSession, layout.name(layer, table)
    if skip_empty:
        df = durable(df)
        if df.isEmpty():
            return df
    if (layout.table_format or "").lower() in TRANSACTIONAL:
        (df.write.mode("overwrite").option("overwriteSchema", True)
         .format(layout.table_format).saveAsTable(name))
        return spark.table(name)
    version = f"{table}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    writer = df.write.format(layout.table_format) if layout.table_format else df.write
    try:
        writer.saveAsTable(layout.name(layer, version))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {layout.name(layer, version)}")
        raise
    _point_to(spark, layer, table, version, layout)
    return spark.table(name)


def table_version(spark: SparkSession, layer: str, table: str, layout: Layout = Layout()) -> str | None:
    """The version that a table's name shows now; None for no table, or one of another kind."""
    name = layout.name(layer, table)
    if not spark.catalog.tableExists(name):
        return None
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return shown.get(VERSION)


def _point_to(spark: SparkSession, layer: str, table: str, version: str, layout: Layout) -> None:
    name, before = layout.name(layer, table), table_version(spark, layer, table, layout)
    if before is None and spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {name}")         # a plain table makes room for the view once
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION}' = '{version}') "
              f"AS SELECT * FROM {layout.name(layer, version)}")
    # names sort by time; a run that started earlier and is not done yet is newer than `before`
    oldest = min(before or version, version)
    for row in spark.sql(f"SHOW TABLES IN {layout.layer(layer)} LIKE '{table}__v*'").collect():
        if row["tableName"] < oldest:
            spark.sql(f"DROP TABLE IF EXISTS {layout.name(layer, row['tableName'])}")


def create_view(spark: SparkSession, layer: str, view: str, query: str, *,
                layout: Layout = Layout()) -> DataFrame:
    """A lasting view over stored tables, as SQL: other sessions read it too."""
    name = layout.name(layer, view)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def serialized(df: DataFrame) -> DataFrame:
    """Every column as the text an exported file holds."""
    return df.select(*[serialize(F.col(f"`{name}`"), kind).alias(name) for name, kind in df.dtypes])


CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": "",
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, folder: str) -> None:
    serialized(df).write.mode("overwrite").options(**CSV).csv(folder)


def _csv_text(text: Column) -> Column:
    doubled = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[",\r\n]'), doubled).otherwise(text)


def _csv_line(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: _csv_text(F.coalesce(v, F.lit("")))), ",")


def write_misc(misc: DataFrame, folder: str) -> None:
    """Flat rows as CSV, each workbook with columns of its own: the keys, then the labels
    that its rows have, sorted.  A workbook that spans files has the header in each."""
    def under_headers(batches):     # local, so that it travels with its tasks
        book, place = None, 0
        for batch in batches:
            out = []
            for name, header, line in zip(batch["export_name"], batch["header"], batch["line"]):
                if name != book:
                    out.append((name, place := place + 1, header))
                    book = name
                out.append((name, place := place + 1, line))
            yield pd.DataFrame(out, columns=["export_name", "place", "value"])

    labels = (misc.select("workbook", F.explode(F.map_keys("fields")).alias("label")).distinct()
              .groupBy("workbook").agg(F.array_sort(F.collect_list("label")).alias("labels")))
    keys = ["workbook", "sheet", "row_seq"]
    order = ["workbook", *EXPORT_ORDER["misc"]]
    lines = misc.join(labels, "workbook", "left").select(
        *order, export_name(F.col("workbook")).alias("export_name"),
        _csv_line(F.concat(F.array(*[F.lit(k) for k in keys]), "labels")).alias("header"),
        _csv_line(F.concat(F.array(*[F.col(k).cast("string") for k in keys]), F.transform(
            "labels", lambda label: F.try_element_at("fields", label)))).alias("line"))
    arranged = lines.repartitionByRange(*order).sortWithinPartitions("export_name", *order)
    (arranged.select("export_name", "header", "line")
     .mapInPandas(under_headers, "export_name string, place long, value string")
     .sortWithinPartitions("export_name", "place").select("export_name", "value")
     .write.mode("overwrite").partitionBy("export_name").text(folder))


def export_workbooks(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Write each table once, split by workbook and ordered within it.

    Ranges over (workbook, order) are balanced by size: a small workbook lands in
    one file, a huge one in as many as it needs, in order.  A CSV holds every value as the
    text that ``serialized`` gives it; flat rows have the columns of their workbook there
    (:func:`write_misc`), and are maps in other formats.
    """
    for name, df in tables.items():
        if fmt == "csv" and "fields" in df.columns:
            write_misc(df, f"{folder}/{name}")
            continue
        order = ["workbook", *EXPORT_ORDER[name]]
        arranged = (df.withColumn("export_name", export_name(F.col("workbook")))
                    .repartitionByRange(*order).sortWithinPartitions("export_name", *order))
        writer = arranged.write
        if fmt == "csv":
            writer = serialized(arranged).write.options(**CSV)
        writer.mode("overwrite").partitionBy("export_name").format(fmt).save(f"{folder}/{name}")


def export_name(workbook: Column) -> Column:
    """``x.xlsx`` -> ``x_CLEAN.xlsx``, whatever the case of the suffix."""
    return F.regexp_replace(workbook, r"(?i)\.xlsx", "_CLEAN.xlsx")
