"""Near-duplicate vectors by p-stable hashing, with exact cosines.

For unit vectors a cosine of ``SIMILARITY`` is a Euclidean distance r.  A projection on a
Gaussian direction moves two vectors apart by a normal deviate of standard deviation r, so
both fall in one cell of width ``WIDTH`` with a probability p that follows from r / WIDTH
(0.89 here).  ``HASHES`` quantised projections make a bucket of one table; ``TABLES``
tables find a link at the very threshold with probability 1 - (1 - p**HASHES)**TABLES
(above 0.9999 here) and closer ones with more.  Every pair found is compared by its exact
cosine in double precision.

Equal vectors form one class first.  A bucket is cut into blocks of at most ``BLOCK``
classes and its pairs of blocks are dealt over tasks; a task compares a pair of blocks by
one matrix product and returns, per class, the number of links and one edge to the root
of its local component - never the pairs.  A pair that meets in several tables is counted
in the first of them only, which the tasks see from the classes' keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sheetloom.llm.components import components
from sheetloom.session import durable

SIMILARITY = 0.98
TABLES = 20
HASHES = 8
WIDTH = 1.5
BLOCK = 1024
SEED = 7


def _projections(dim: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((SEED, dim))
    return rng.standard_normal((dim, TABLES * HASHES)), rng.uniform(0, WIDTH, TABLES * HASHES)


def bucket_keys(unit: np.ndarray) -> np.ndarray:
    """One 32-bit key per table for each unit vector (rows)."""
    directions, shifts = _projections(unit.shape[1])
    cells = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64)
    mix = np.random.default_rng((SEED, 0)).integers(1, 1 << 62, HASHES) | 1
    keys = (cells.reshape(len(unit), TABLES, HASHES) * mix).sum(axis=2, dtype=np.int64)
    return ((keys ^ (keys >> 32)) & 0x7FFFFFFF).astype(np.int32)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for _, same in batch.groupby(batch["embedding"].map(len)):
            vectors = np.array(same["embedding"].tolist(), dtype=np.float64)
            keys = bucket_keys(vectors / np.linalg.norm(vectors, axis=1)[:, None])
            yield same.assign(keys=list(keys))


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of each local component, given links a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _compared(ids, sizes, keys, unit, blocks, table, lo, hi, threshold):
    """Links of one pair of blocks: per class its links counted here, and its root."""
    left, right = np.flatnonzero(blocks == lo), np.flatnonzero(blocks == hi)
    cosine = unit[left] @ unit[right].T
    if lo == hi:
        cosine[np.tril_indices(len(left))] = -1.0
    i, j = np.nonzero(cosine >= threshold)
    a, b = left[i], right[j]
    counted = np.ones(len(a), dtype=bool)
    for t in range(table):
        counted &= keys[a, t] != keys[b, t]
    links = np.zeros(len(ids), dtype=np.int64)
    np.add.at(links, a[counted], sizes[b[counted]])
    np.add.at(links, b[counted], sizes[a[counted]])
    return links, ids[_roots(a, b, len(ids))]


def _bucket_links(threshold: float):
    columns = ["table", "key", "label", "lo", "hi"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Batches come sorted by bucket and block pair; a group may span batches."""
        rest = None
        for batch in _with_end(batches):
            frame = rest if batch is None else batch if rest is None else pd.concat([rest, batch])
            if frame is None or frame.empty:
                continue
            marks = frame[columns].to_numpy()
            starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)])
            ends = np.r_[starts[1:], len(frame)]
            if batch is not None:
                rest = frame.iloc[starts[-1]:]
                starts, ends = starts[:-1], ends[:-1]
            if not len(starts):
                continue
            frame = frame.iloc[:ends[-1]]
            ids = frame["id"].to_numpy(np.int64)
            sizes = frame["n"].to_numpy(np.int64)
            keys = np.array(frame["keys"].tolist(), dtype=np.int32)
            blocks = frame["block"].to_numpy()
            out = []
            lengths = frame["embedding"].map(len).to_numpy()
            vectors = frame["embedding"].to_numpy()
            for s, e in zip(starts.tolist(), ends.tolist()):
                table, lo, hi = int(marks[s, 0]), int(marks[s, 3]), int(marks[s, 4])
                for dim in np.unique(lengths[s:e]).tolist():
                    at = s + np.flatnonzero(lengths[s:e] == dim)
                    if len(at) < 2:
                        continue
                    unit = np.array(vectors[at].tolist(), dtype=np.float64)
                    unit /= np.linalg.norm(unit, axis=1)[:, None]
                    links, roots = _compared(ids[at], sizes[at], keys[at], unit, blocks[at],
                                             table, lo, hi, threshold)
                    use = np.flatnonzero((links > 0) | (roots != ids[at]))
                    if len(use):
                        out.append(pd.DataFrame({"id": ids[at][use], "links": links[use], "root": roots[use]}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def _with_end(batches):
    yield from batches
    yield None


def near_duplicates(vectors: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``.

    Rows of one label (not null) are linked when their cosine is at least ``threshold``;
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    vec_id reachable.  Vectors that are null, empty or zero, hold null or non-finite
    components or have no label link with nothing; vectors of different lengths do not
    link.  Equal vectors of one label link with each other.  A row with a null vec_id
    counts as a link but is named by no one and gets its class's component.  Repeated rows
    each count and each give a row.
    """
    finite = (F.col("embedding").isNotNull() & (F.size("embedding") > 0)
              & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
              & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull())
    rows = (vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                           F.col("embedding").cast("array<double>"))
            .withColumn("valid", F.coalesce(finite, F.lit(False))))
    good = rows.where("valid").drop("valid").withColumn("class", F.xxhash64("label", "embedding"))
    classes = durable(
        good.groupBy("label", "embedding", "class").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
        .where("id is not null")
        .mapInPandas(_keyed, "label long, embedding array<double>, class long, id long, n long, keys array<int>"))
    entries = classes.select("id", "label", F.posexplode("keys").alias("table", "key"))
    crowded = (entries.groupBy("label", "table", "key").agg(F.count("*").alias("m")).where("m > 1")
               .select("*", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    dealt = (entries.join(crowded, ["label", "table", "key"])
             .withColumn("block", F.pmod(F.xxhash64("id", "table"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("id", "label", "table", "key", "block",
                     F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    found = durable(
        dealt.join(classes.select("id", "embedding", "n", "keys"), "id")
        .repartition("label", "table", "key", "lo", "hi")
        .sortWithinPartitions("label", "table", "key", "lo", "hi", "id")
        .select("table", "key", "label", "lo", "hi", "block", "id", "n", "keys", "embedding")
        .mapInPandas(_bucket_links(threshold), "id long, links long, root long"))
    named = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    per_class = (classes.select("id", "label", "class", "n").join(links, "id", "left").join(named, "id", "left")
                 .select("label", "class", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                         F.coalesce("component", "id").alias("component_id")))
    linked = good.select("vec_id", "label", "class").join(per_class, ["label", "class"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return linked.union(alone).select("*", (F.col("vec_id") == F.col("component_id")).alias("kept"))
