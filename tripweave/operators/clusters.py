"""Trips that start and end in the same cells in the same half hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.cells import cell_number, cell_text
from tripweave.functions.once import with_computed
from tripweave.functions.times import (
    bucket_number,
    bucket_start,
    iso_week,
    parse_instant,
    time_bucket,
)

PRECISION = 7
MINUTES = 30
ENDS = ("origin", "destination")
CLUSTER_KEY = ["origin_cell", "destination_cell", "time_bucket"]


def add_geohashes(df: DataFrame, precision: int = PRECISION) -> DataFrame:
    numbers = {
        f"_{end}_number": cell_number(F.col(f"{end}_lon"), F.col(f"{end}_lat"), precision)
        for end in ENDS
    }
    texts = {f"{end}_geohash": cell_text(F.col(f"_{end}_number"), precision) for end in ENDS}
    return with_computed(df, numbers).withColumns(texts).drop(*numbers)


def add_time_bucket(df: DataFrame, minutes: int = MINUTES) -> DataFrame:
    return df.withColumn("time_bucket", time_bucket(instant_of(df), minutes))


def instant_of(df: DataFrame) -> Column:
    """``datetime`` as an instant, whether the table holds the text or the timestamp."""
    column = F.col("datetime")
    return parse_instant(column) if dict(df.dtypes)["datetime"] == "string" else column


def cluster_counts(
    trips: DataFrame, precision: int = PRECISION, minutes: int = MINUTES, per: tuple[str, ...] = ()
) -> DataFrame:
    """Trips per origin cell, destination cell and bucket, and per ``per`` if given.

    Grouped by three longs, so both aggregation steps hash fixed-width keys; the cells'
    text is made once per group. A stored trip always has an id, so rows are counted and
    the wide id column is not read.
    """
    keys = {
        f"{end}_number": cell_number(F.col(f"{end}_lon"), F.col(f"{end}_lat"), precision)
        for end in ENDS
    } | {"bucket": bucket_number(instant_of(trips), minutes)}
    counted = (
        trips.select(*per, *(expr.alias(name) for name, expr in keys.items()))
        .groupBy(*per, *keys)
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )
    return counted.select(
        cell_text(F.col("origin_number"), precision).alias("origin_cell"),
        cell_text(F.col("destination_number"), precision).alias("destination_cell"),
        bucket_start(F.col("bucket"), minutes).alias("time_bucket"),
        "trip_count",
        *per,
    ).withColumn("iso_week", iso_week(F.col("time_bucket")))


def top_clusters(clusters: DataFrame, n: int = 10) -> DataFrame:
    return clusters.orderBy(F.desc("trip_count"), *CLUSTER_KEY).limit(n)


def clusters_by_week(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("iso_week")
        .agg(F.sum("trip_count").alias("total_trips"))
        .orderBy("iso_week")
    )


def latest_clusters(snapshots: DataFrame) -> DataFrame:
    """The newest snapshot of each cluster, by its batch: one aggregate of plain longs."""
    return (
        snapshots.groupBy(*CLUSTER_KEY)
        .agg(F.max_by("trip_count", "batch_id").alias("trip_count"))
        .withColumn("iso_week", iso_week(F.col("time_bucket")))
    )


def merged_deltas(deltas: DataFrame) -> DataFrame:
    """Clusters from per-batch counts: the counts of a key add up."""
    return (
        deltas.groupBy(*CLUSTER_KEY)
        .agg(F.sum("trip_count").alias("trip_count"))
        .withColumn("iso_week", iso_week(F.col("time_bucket")))
    )
