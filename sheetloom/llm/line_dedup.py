"""Lines that repeat across documents, by levelled sorted runs of line hashes.

A store of runs (:class:`LineRuns`) holds each line key once, as a 128-bit hash with the
number of documents and the largest doc_id of the batch that brought it.  A run is a table
bucketed and sorted by hash.  A new batch is reduced to its own keys, which are anti-joined
with every run by a merge join within the buckets, so only the batch is shuffled; what no
run holds becomes a run of level 0, what some run holds is noted as a repeat.  ``fanout``
runs of one level are compacted into one run of the next, so that there are
``fanout * log(batches)`` runs at most, and a key is rewritten once a level.

Most lines occur once and are only ever read by merge joins; counts over all batches are
made of the repeats alone.  Only DataFrame functions are used.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetloom.session import durable, shared_folder

MIN_CHARS = 40          # code points of a key, from which on a line counts
MIN_DOCS = 5            # documents that make a line a repeated one
BATCHES = 4             # batches that `without_repeated_lines` deals a table into
FANOUT = 3              # runs of one level that are compacted into one

BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HASH = ["h1", "h2"]


def text_lines(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def hashed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, pos, h1, h2`` of every line whose key is long enough."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.where(F.length(F.btrim("line", F.lit(BLANKS))) >= MIN_CHARS).withColumn(
        "key", line_key(F.col("line")))
    return keys.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"),
                       F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """Runs of line keys in a folder that all executors share.

    Batches must not share doc_ids, as documents are counted per batch.  The names that
    the tables need in the session's catalogue go with :meth:`close`; the files stay.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        # as many as a shuffle has partitions: aggregates by hash are bucketed already
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.repeats: list[str] = []
        self._names: list[str] = []

    def _store(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (keys.write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", f"{self.folder}/{name}").saveAsTable(name))
        self._names.append(name)
        return name

    def _files(self, names: list[str]) -> DataFrame:
        """Several runs as plain files, for what deals them anew anyway."""
        schema = self.spark.table(names[0]).schema
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{n}" for n in names])

    def runs(self) -> Iterator[str]:
        for level in self.levels:
            yield from level

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch (``doc_id, h1, h2``); returns its keys that no run held before."""
        own = self.spark.table(self._store(
            lines.select("doc_id", *HASH).distinct()
            .groupBy(*HASH).agg(F.count("*").alias("docs"), F.max("doc_id").alias("top"))))
        run = self._names[-1]
        if any(self.levels):
            fresh = own
            for name in self.runs():
                fresh = fresh.join(self.spark.table(name).select(*HASH).hint("merge"), HASH, "left_anti")
            run = self._store(fresh)
            held = own.join(self.spark.table(run).select(*HASH).hint("merge"), HASH, "left_anti")
            self.repeats.append(self._store(held))
        self._push(run)
        return self.spark.table(run)

    def _push(self, run: str, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._store(self._files(self.levels[level]).repartition(self.buckets, *HASH))
            self.levels[level] = []
            self._push(merged, level + 1)

    def counts(self, min_docs: int = 1) -> DataFrame:
        """``h1, h2, docs, top`` over all batches of the keys in at least ``min_docs`` documents."""
        again = None
        if self.repeats:
            again = self.spark.table(self._store(
                self._files(self.repeats).groupBy(*HASH)
                .agg(F.sum("docs").alias("more"), F.max("top").alias("later")))).hint("merge")
        parts = []
        for name in self.runs():
            run = self.spark.table(name)
            if again is not None:
                run = run.join(again, HASH, "left").select(
                    *HASH, (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"),
                    F.greatest("top", "later").alias("top"))
            parts.append(durable(run.where(F.col("docs") >= min_docs)))
        return reduce(DataFrame.unionByName, parts)

    def close(self) -> None:
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._names = []


def repeated_lines(lines: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS) -> DataFrame:
    """``h1, h2, top`` of the keys found in at least ``min_docs`` documents.

    ``lines`` has a column ``batch`` from 0; one batch after the other goes into the runs.
    """
    spark = lines.sparkSession
    store = LineRuns(spark, f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}")
    try:
        for batch in range(batches):
            store.add(lines.where(F.col("batch") == batch))
        return store.counts(min_docs).select(*HASH, "top")
    finally:
        store.close()


def without_repeated_lines(docs: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``kept_text, n_lines, n_dropped`` beside its columns.

    A line whose key (see :func:`line_key`) has at least ``MIN_CHARS`` code points and is
    found in at least ``min_docs`` documents stays only in the document of the largest
    doc_id that holds it, there each time it occurs.  Shorter lines stay everywhere.

    A null or empty text is one empty line; ``kept_text`` is then empty.  Rows of one
    doc_id count as one document, whatever their texts; rows with a null doc_id too, and
    it is smaller than all others.  Each row gives one row; an empty table gives none.
    Columns named like the results are replaced.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    (hashed_lines(docs).withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
     .write.partitionBy("batch").parquet(folder))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lines = spark.read.schema(
        f"doc_id {id_type}, text_hash long, pos int, h1 long, h2 long, batch int").parquet(folder)
    repeated = repeated_lines(lines, batches, min_docs)
    dropped = (lines.join(repeated, HASH).where(~F.col("doc_id").eqNullSafe(F.col("top")))
               .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
               .agg(F.collect_set("pos").alias("_gone")))
    rest = docs.drop("kept_text", "n_lines", "n_dropped").withColumn("_text_hash", F.xxhash64("text"))
    joined = rest.join(dropped, F.col("doc_id").eqNullSafe(F.col("_id"))
                       & (F.col("_text_hash") == F.col("_hash")), "left")
    # the lines are bound to a variable, so that they are split once and not once a line
    kept = F.transform(F.array(text_lines(F.col("text"))), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone")),
        lambda i: F.get(lines, i)), "\n"))
    return joined.select(
        *[F.col(f"`{c}`") for c in rest.columns if c != "_text_hash"],
        F.when(F.col("_gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.get(kept, 0)).alias("kept_text"),
        F.size(text_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of :func:`without_repeated_lines`."""
    return without_repeated_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
