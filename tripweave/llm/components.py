"""Connected components of a link table by alternating star contractions.

Each round joins and aggregates the link table with itself; nothing is collected but one row
of counters. A hub's links are many rows of one key: the minimum combines before the shuffle,
and the join that follows is a plain sort-merge join, whose large keys Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import written


def _with_least(links: DataFrame) -> DataFrame:
    """Links ``(u, v)`` with ``least``: the smallest of u and all its neighbours v."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return links.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _with_least(both)
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .where("u != v")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    known = _with_least(down)
    moved = known.select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = known.select("u", F.col("least").alias("v"))
    return moved.unionByName(own).where("u != v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` of every node of the links, component being its smallest node.

    Links are pairs of longs; NULLs and loops are ignored, repeated links count once. The
    loop ends when a round changes nothing, whatever the number of rounds.
    """
    rows = (
        links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
        .where("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    mark = lambda df: tuple(
        df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )
    rows = written(rows, "links")
    before = mark(rows)
    while before[0]:
        rows = written(_small_star(_large_star(rows)), "links")
        after = mark(rows)
        if after == before:
            break
        before = after
    stars = rows.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = rows.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres)
