"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is two shuffles over the links; no component is ever gathered in one task
(a hub's links meet its minimum in a join, which adaptive execution can split).  The
links shrink to stars around each component's smallest vertex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheetloom.session import durable


def _mins(links: DataFrame, own: bool) -> DataFrame:
    low = F.min("v")
    return links.groupBy("u").agg((F.least("u", low) if own else low).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_mins(both, own=True), "u").where("v > u")
            .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .where("u != v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Links come as (larger u, smaller v)."""
    mins = _mins(links, own=False)
    moved = links.join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(mins.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``u, v`` links (64-bit ids, any direction) -> ``id, component`` for every id that
    is not the smallest of its component; the smallest reachable id is the component.

    Self-links, repeated links and links with a null end add nothing; an empty table
    gives an empty one.  Raises if ``rounds`` do not suffice (they suffice for any
    component of fewer than 2**30 vertices in practice).
    """
    now = durable(links.where("u is not null and v is not null and u != v")
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(now)
    if before[0] == 0:
        return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    for _ in range(rounds):
        now = durable(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")
