"""Documents to training sequences: each stage calls one operator of ``sheetloom.llm``.

The stages, in order: toxic documents go, one document of each near-duplicate group
stays, documents that hold a benchmark passage go, the rest is packed.  Every stage's rows
are written before the next one reads them.  SQL can state none of the first three stages
(a learned grammar, xxHash64 fingerprints, SimHash windows), so there is no expected SQL;
the tests hold the pipeline against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetloom.llm import decontamination, packing, simhash_dedup, toxicity
from sheetloom.llm.shipping import ship
from sheetloom.session import durable

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the filters keep of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
