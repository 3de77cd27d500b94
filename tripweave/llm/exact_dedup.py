"""Exact dedup: a 128-bit content hash first, then the bytes themselves.

Texts are equal when they are identical without ASCII white space. Rows group by
(hash, normalised text), so the aggregation compares bytes and a collision of the hash stays
two groups; equal texts combine in each task before the shuffle, so a text that a third of
all rows repeat sends one row per task. The rows then find their group by hash and SHA-256 in
a plain equi-join of narrow rows, whose large keys Spark splits. All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"


def _normal(text: str):
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, "")


#: Decimal places of the two parts of an order number: points * SHIFT + (MIDDLE - id).
SHIFT = "100000000000000000000"
MIDDLE = "10000000000000000000"


def _order(id_column: str, text: str):
    """One number whose maximum decides which row stays: most code points, then the smallest
    id, no id last. A number, unlike a struct, keeps the aggregation a hash aggregation."""
    points = F.length(F.coalesce(F.col(text), F.lit(""))).cast("decimal(10,0)")
    backwards = F.lit(MIDDLE).cast("decimal(20,0)") - F.col(id_column).cast("decimal(19,0)")
    return (points * F.lit(SHIFT).cast("decimal(21,0)") + F.coalesce(backwards, F.lit(0))).cast(
        "decimal(38,0)"
    )


def _points_of(order):
    return F.floor(order / F.lit(SHIFT).cast("decimal(21,0)")).cast("int")


def _id_of(order):
    rest = order % F.lit(SHIFT).cast("decimal(21,0)")
    return F.when(rest > 0, (F.lit(MIDDLE).cast("decimal(20,0)") - rest).cast("long"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct normalised text: ``content_hash, sha, group_size, keep_points,
    keep_id``. Of equal texts the row with the most code points stays, then the smallest id.

    NULL text counts as empty, and all empty or blank texts are one group. A NULL id comes
    after every other; ``keep_id`` is NULL only where no row of the group has an id.
    """
    rows = docs.select(
        F.unhex(F.md5(_normal(text))).alias("content_hash"),
        _normal(text).alias("content"),
        _order(id_column, text).alias("first"),
    )
    groups = rows.groupBy("content_hash", "content").agg(
        F.max("first").alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    return groups.select(
        "content_hash",
        F.unhex(F.sha2("content", 256)).alias("sha"),
        "group_size",
        _points_of(F.col("first")).alias("keep_points"),
        _id_of(F.col("first")).alias("keep_id"),
    )


def label_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its group: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Repeated rows of one id and text are one document and share ``kept``; an empty table
    gives an empty result. Only the id and the text are read, whatever other columns exist.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.unhex(F.md5(_normal(text))).alias("content_hash"),
        F.unhex(F.sha2(_normal(text), 256)).alias("sha"),
    )
    groups = exact_groups(docs, id_column, text)
    return rows.join(groups, ["content_hash", "sha"]).select(
        F.col("doc_id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of which each stands for its group, with all their columns; exactly one row of
    each group, also where one id and text stand in several rows."""
    stamped = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.unhex(F.md5(_normal(text))).alias("content_hash"),
        F.unhex(F.sha2(_normal(text), 256)).alias("sha"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("points"),
        F.col(id_column).alias("own_id"),
    )
    groups = exact_groups(docs, id_column, text)
    first = (
        stamped.join(groups, ["content_hash", "sha"])
        .where(F.col("own_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points")))
        .select("content_hash", "sha", "row")
    )
    return first.dropDuplicates(["content_hash", "sha"]).select("row.*")
