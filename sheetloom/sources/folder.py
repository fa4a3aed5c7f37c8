"""Listing and cataloguing of workbook files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetloom.contracts import MARKER_KIND


FILES = "name string, path string, size_bytes long, site string, folder string"

# Stores whose folders a task can list by itself.
LISTED_BY_TASKS = {"file", "s3", "gs", "abfs", "abfss"}


def list_files(spark: SparkSession, folder: str | list[str], suffix: str | None = None, *,
               site: str | None = None) -> DataFrame:
    """Files directly in a folder or several, by name; those whose name starts with a dot
    are skipped.

    Each folder is listed by a task of its own, and its rows stay there.  (Spark's file
    index would list on the driver and hide names that start with an underscore.)  A store
    that tasks cannot open is listed through the driver.
    """
    folders = [folder] if isinstance(folder, str) else list(folder)
    jvm, conf = spark.sparkContext._jvm, spark._jsc.hadoopConfiguration()
    named = []
    for name in folders:
        path = jvm.org.apache.hadoop.fs.Path(name)
        store = path.getFileSystem(conf)
        if not store.exists(path):
            raise FileNotFoundError(name)
        named.append((name, str(store.makeQualified(path).toString()), site))
    if all(uri.split(":", 1)[0] in LISTED_BY_TASKS for _, uri, _ in named):
        asked = spark.createDataFrame(named, "folder string, uri string, site string")
        found = asked.repartition(len(named), "folder").mapInPandas(_lister(), FILES)
    else:
        found = spark.createDataFrame(
            [(f.getPath().getName(), f.getPath().toString(), f.getLen(), site, name) for name, uri, _ in named
             for f in jvm.org.apache.hadoop.fs.Path(uri).getFileSystem(conf).listStatus(jvm.org.apache.hadoop.fs.Path(uri))
             if f.isFile()], FILES)
    kept = ~F.col("name").startswith(".")
    if suffix is not None:
        kept &= F.lower("name").endswith(suffix.lower())
    return found.where(kept).orderBy("name", "folder")


def _lister():
    def run(batches):       # local, so that it travels with its tasks
        from pyarrow import fs

        for batch in batches:
            for folder, uri, site in zip(batch["folder"], batch["uri"], batch["site"]):
                local = uri.startswith("file:")
                store, path = (fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")) if local else fs.FileSystem.from_uri(uri)
                files = [f for f in store.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.File]
                for start in range(0, len(files), 10_000):
                    part = files[start:start + 10_000]
                    yield pd.DataFrame({
                        "name": [f.base_name for f in part],
                        "path": [f"{uri.rstrip('/')}/{f.base_name}" for f in part],
                        "size_bytes": [f.size for f in part], "site": [site] * len(part), "folder": [folder] * len(part)})

    return run


def workbook_catalog(cells: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row per workbook: its sheets in tab order, with path and size where the
    files are given (as ``list_files`` returns them)."""
    sheets = (
        cells.where(F.col("kind") == MARKER_KIND)       # one row per sheet
        .groupBy("workbook", "sheet").agg(F.max("sheet_pos").alias("sheet_pos"))
        .groupBy("workbook")
        .agg(F.count("*").cast("int").alias("sheet_count"),
             F.transform(F.array_sort(F.collect_list(F.struct("sheet_pos", "sheet"))),
                         lambda s: s["sheet"]).alias("sheet_names"))
    )
    if files is None:
        located = (sheets.withColumn("source_path", F.lit(None).cast("string"))
                   .withColumn("size_bytes", F.lit(None).cast("bigint")))
    else:
        located = sheets.join(files.select(F.col("name").alias("workbook"),
                                           F.col("path").alias("source_path"), "size_bytes"),
                              "workbook", "left")
    return located.select("workbook", "source_path", "sheet_count", "sheet_names", "size_bytes",
                          F.current_timestamp().alias("ingest_ts"))


def grid_preview(cells: DataFrame, workbook: str | None = None, sheet: str | None = None,
                 rows: int = 18) -> DataFrame:
    """Top rows of one sheet as a table.

    The preferred sheet is shown where the workbook has it, else its first sheet;
    without a workbook name, the first workbook by name.
    """
    book = cells if workbook is None else cells.where(F.col("workbook") == workbook)
    preferred = F.lit(False) if sheet is None else F.col("sheet") == sheet
    chosen = (book.where(F.col("kind") == MARKER_KIND)
              .orderBy("workbook", (~preferred).cast("int"), "sheet_pos").limit(1)
              .select("workbook", "sheet").collect())
    if not chosen:
        return cells.sparkSession.createDataFrame([], "row int")
    pick = chosen[0]
    of_sheet = cells.where((F.col("workbook") == pick["workbook"]) & (F.col("sheet") == pick["sheet"]))
    width = of_sheet.agg(F.max("col")).first()[0] or 0
    columns = list(range(1, width + 1))
    top = of_sheet.where(F.col("row").between(1, rows) & (F.col("col") >= 1))
    grid = top.groupBy("row").agg(*[F.max(F.when(F.col("col") == c, F.col("raw"))).alias(f"c{c}")
                                    for c in columns])
    numbers = cells.sparkSession.range(1, rows + 1).select(F.col("id").cast("int").alias("row"))
    return numbers.join(F.broadcast(grid), "row", "left").orderBy("row")
