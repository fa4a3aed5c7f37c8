"""Near-duplicate documents by SimHash, found in a space of segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits and mapped to the vector of
their bit counts.  Two fingerprints that differ in d bits have vectors at Manhattan
distance d or less, so that distance bounds the bit distance from below.  Written in
unary (0, 1, 2 -> 00, 01, 11) the vector is again a 64-bit word and its Manhattan
distance a bit count.

The range join works on a grid over that space: the 32 coordinates form ``GROUPS``
groups; vectors within ``RADIUS`` can differ in at most ``RADIUS`` groups, so they share
the cell of at least one choice of ``GROUPS - RADIUS`` groups.  Every fingerprint enters
one cell per choice; cell mates pass the Manhattan bound, then the exact bit distance,
inside the join.  No link is lost, at any size.  More groups give smaller cells at the
price of more of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.llm.components import components
from sheetloom.session import durable

BITS = 64
RADIUS = 3
GROUPS = 6
SHINGLE_WORDS = 3
SEED = 42
_SLICE = 1 << 15        # shingles whose bits are unpacked at a time
_EVEN = 0x5555555555555555


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a whole text; zero without a word."""
    if not text:
        return 0
    parts = text.encode("utf-8", "surrogatepass").lower().split()     # bytes: ASCII rules only
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, n, _SLICE):
        hashes = np.array([digest(join(parts[i:i + words]), SEED)
                           for i in range(start, min(n, start + _SLICE))], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_key": batch["text_key"],
                            "fp": np.array([fingerprint(t) for t in batch["text"]], dtype=np.int64)})


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, fp`` for each row; a null text counts as empty."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInPandas(
        _fingerprints, "doc_id long, text_key long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def counts_in_unary(fp: Column) -> Column:
    """The segment bit counts of a fingerprint, two unary digits per segment."""
    even = F.lit(_EVEN)
    high = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(high).bitwiseAND(even)
    both = fp.bitwiseAND(high).bitwiseAND(even)
    return some.bitwiseOR(F.shiftleft(both, 1))


def grid_masks(groups: int = GROUPS, radius: int = RADIUS) -> list[int]:
    """One mask of unary digits for each choice of ``groups - radius`` coordinate groups."""
    segments = np.array_split(np.arange(BITS // 2), groups)
    words = [sum(3 << 2 * int(s) for s in group) for group in segments]
    return [_signed(sum(words[g] for g in chosen))
            for chosen in combinations(range(groups), groups - radius)]


def links(distinct: DataFrame, groups: int = GROUPS, radius: int = RADIUS) -> DataFrame:
    """``u, v`` ids of all pairs of different fingerprints within ``radius`` bits.

    ``distinct`` has ``rep, fp``, each fingerprint once.
    """
    vector = distinct.select("rep", "fp", counts_in_unary(F.col("fp")).alias("vec"))
    cells = vector.select("rep", "fp", "vec", F.posexplode(F.array(*[
        F.col("vec").bitwiseAND(F.lit(m)) for m in grid_masks(groups, radius)])).alias("grid", "cell"))
    a, b = cells.alias("a"), cells.alias("b")
    near = ((F.col("a.fp") < F.col("b.fp"))
            & (F.bit_count(F.col("a.vec").bitwiseXOR(F.col("b.vec"))) <= radius)
            & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius))
    return (a.join(b, (F.col("a.grid") == F.col("b.grid")) & (F.col("a.cell") == F.col("b.cell")) & near)
            .select(F.col("a.rep").alias("u"), F.col("b.rep").alias("v")))


def _named(docs: DataFrame, groups: int = GROUPS, radius: int = RADIUS) -> DataFrame:
    """Rows of :func:`fingerprints` with their component."""
    rows = durable(fingerprints(docs))
    classes = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_same")))
    found = components(links(classes.where("rep is not null").select("rep", "fp"), groups, radius))
    named = (classes.join(found.withColumnRenamed("id", "rep"), "rep", "left")
             .select("fp", F.coalesce("component", "rep").alias("component_id"),
                     F.col("rep").alias("class_id"), "n_same"))
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, groups: int = GROUPS, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id, class_id, n_same`` for each row of ``docs``.

    Rows are linked when their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest doc_id reachable.  Copies (equal fingerprints) form
    one class, named by its smallest doc_id and counted in ``n_same``; only classes are
    joined, so that a huge group of copies costs one row.  A null or wordless text has
    fingerprint zero and is linked like any other.  Repeated rows each give a row; a row
    with a null doc_id gets the component of its class, which is null if no row of the
    class has an id.  Columns besides doc_id and text are ignored.
    """
    return _named(docs, groups, radius).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        "class_id", "n_same")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its component: one document of each group.

    Each row is judged by its own text: of several rows with one doc_id, those whose text
    is no copy of another document's stay.  Rows without a doc_id cannot be named and stay.
    """
    dropped = _named(docs).where("component_id != doc_id").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_key"))
    return docs.join(dropped, same, "left_anti")
