"""Stage tables of the catalogue: what one medallion stage leaves for the next.

Each is written once per session and state of the source tables, and every mart
or report reads it, as the reports of a scheduled run read stored tables.  A mart that
passes over the observations once does not have them stored for itself alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from catalogue.grids import cells_table, source_state
from sheetloom.plans.silver import SilverTables, clean
from sheetloom.session import shared_folder

_cleaned: dict[tuple, SilverTables] = {}
_packed: dict[tuple, SilverTables] = {}
_stored: dict[tuple, str] = {}
_passed: set[tuple] = set()


def state(spark: SparkSession, sf_dir: str) -> tuple:
    return source_state(spark, sf_dir)


def sheets(spark: SparkSession, sf_dir: str) -> SilverTables:
    """Sheet-level results (stored), without the rows: what profiles and mappings need."""
    key = source_state(spark, sf_dir)
    if key not in _cleaned:
        _cleaned[key] = clean(cells_table(spark, sf_dir))
    return _cleaned[key]


def silver(spark: SparkSession, sf_dir: str) -> SilverTables:
    """Sheet-level results and packed rows (stored) with the row-level frames bound lazily."""
    key = source_state(spark, sf_dir)
    if key not in _packed:
        _packed[key] = sheets(spark, sf_dir).keep_rows()
    return _packed[key]


def _table(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (name, *source_state(spark, sf_dir))
    if key not in _stored:
        folder = f"{shared_folder(spark)}/sheetloom-{name}-{uuid.uuid4().hex}"
        build(silver(spark, sf_dir)).write.parquet(folder)
        _stored[key] = folder
    return spark.read.parquet(_stored[key])


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "observations", lambda s: s.observations_keyed)


def observations_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations for a reader that passes over them once.

    The first of a session gets them as they are made, of the columns that it reads only: writing
    every column of every row would take longer than all else.  The next finds them stored.
    """
    key = source_state(spark, sf_dir)
    if ("observations", *key) in _stored or key in _passed:
        return observations(spark, sf_dir)
    _passed.add(key)
    return _packed.get(key, sheets(spark, sf_dir)).observations_keyed


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "issues", lambda s: s.issues_keyed)
