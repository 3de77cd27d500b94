"""First delivery wins: inside a batch, and against what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DELIVERY_ORDER = ["kafka_timestamp", "row_number", "ingestion_id"]


def first_wins(df: DataFrame, key: str = "trip_id", order: list[str] | None = None) -> DataFrame:
    """One row per key, the first delivered.

    With the filter on rank 1 Spark also ranks before the shuffle, so a key with very many
    copies sends one row per map task and not all of them.
    """
    spec = Window.partitionBy(key).orderBy(*(order or DELIVERY_ORDER))
    return df.withColumn("_rank", F.row_number().over(spec)).where("_rank = 1").drop("_rank")


def insert_new(
    batch: DataFrame, stored: DataFrame, key: str = "trip_id", order: list[str] | None = None
) -> DataFrame:
    """What an insert-only merge adds to ``stored``: first deliveries of unknown keys.

    The stored keys are first cut to those of the batch. ``stored`` is the big side there,
    so Spark can broadcast a small batch's keys, by its own size threshold, instead of
    shuffling the table. The keys are made distinct by a hash aggregate, which combines the
    copies of a hot key before any shuffle; the anti join then finds its left side already
    partitioned and sorted by the ranking.
    """
    return first_wins(batch, key, order).join(known_keys(batch, stored, key), key, "left_anti")


def known_keys(batch: DataFrame, stored: DataFrame, key: str = "trip_id") -> DataFrame:
    """The stored keys that the batch has too."""
    return stored.select(key).join(batch.select(key).distinct(), key, "left_semi")
