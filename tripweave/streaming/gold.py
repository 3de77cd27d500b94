"""Silver -> clusters and weekly metrics.

Two ways to the same tables. The roll-ups keep nothing between batches: they store each
silver batch's own counts, which add up in tiers, and a replay overwrites them. They are the ones
to use at scale. The stateful queries keep every trip id and every group in the state store and
read the files of silver as they come; they are for small tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave import schemas
from tripweave.operators.clusters import (
    CLUSTER_KEY,
    cluster_counts,
    latest_clusters,
    merged_deltas,
)
from tripweave.operators.weekly import merged_weeks, weekly_deltas, weekly_metrics
from tripweave.sources.lake import Lake
from tripweave.sources.tables import (
    partition_values,
    read_snapshot,
    table_stream,
    write_batch,
    write_snapshot,
)
from tripweave.streaming.rollup import RollUp
from tripweave.streaming.runner import start

CLUSTER_COUNTS = RollUp(
    "cluster_deltas",
    tuple(CLUSTER_KEY),
    lambda trips: cluster_counts(trips, per=("batch_id",)),
)
WEEK_COUNTS = RollUp(
    "weekly_deltas",
    ("region", "iso_week"),
    lambda trips: weekly_deltas(trips, per=("batch_id",)),
)


def silver_stream(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> DataFrame:
    return table_stream(spark, lake.path("silver"), schemas.SILVER, max_files)


def landed_batches(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> DataFrame:
    """Which batches have landed, or landed again: the arrivals, the last that a batch writes."""
    arrivals = table_stream(spark, lake.path("arrivals"), schemas.ARRIVALS, max_files)
    return arrivals.select("batch_id")


def distinct_trips(
    spark: SparkSession, lake: Lake, max_files: int | None = None
) -> DataFrame:
    """Each trip once, also when a replayed silver batch shows up as new files."""
    return silver_stream(spark, lake, max_files).dropDuplicates(["trip_id"])


def start_clusters(
    spark: SparkSession, lake: Lake, max_files: int | None = None, available_now: bool = False
) -> StreamingQuery:
    return start(
        cluster_counts(distinct_trips(spark, lake, max_files)),
        lambda batch, batch_id: write_snapshot(batch, lake.path("gold_clusters"), batch_id),
        "gold_clusters",
        lake.checkpoint("gold_clusters"),
        "complete",
        available_now,
    )


def start_weekly(
    spark: SparkSession, lake: Lake, max_files: int | None = None, available_now: bool = False
) -> StreamingQuery:
    return start(
        weekly_metrics(distinct_trips(spark, lake, max_files)),
        lambda batch, batch_id: write_snapshot(batch, lake.path("gold_weekly"), batch_id),
        "gold_weekly",
        lake.checkpoint("gold_weekly"),
        "complete",
        available_now,
    )


def start_cluster_snapshots(
    spark: SparkSession,
    lake: Lake,
    max_files: int | None = None,
    available_now: bool = False,
    sink: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """The groups each batch changed, with their new counts, to the lake or another sink."""

    def to_lake(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, lake.path("cluster_snapshots"), batch_id)

    return start(
        cluster_counts(distinct_trips(spark, lake, max_files)),
        sink or to_lake,
        "cluster_snapshots",
        lake.checkpoint("cluster_snapshots"),
        "update",
        available_now,
    )


def start_rollup(
    spark: SparkSession,
    lake: Lake,
    counts: RollUp,
    name: str,
    max_files: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Count each landed batch, from the silver rows that it has now."""
    return start(
        landed_batches(spark, lake, max_files),
        lambda batch, _: counts.add(spark, lake, partition_values(batch, "batch_id")),
        name,
        lake.checkpoint(name),
        available_now=available_now,
    )


def start_cluster_rollup(
    spark: SparkSession, lake: Lake, max_files: int | None = None, available_now: bool = False
) -> StreamingQuery:
    return start_rollup(spark, lake, CLUSTER_COUNTS, "cluster_rollup", max_files, available_now)


def start_weekly_rollup(
    spark: SparkSession, lake: Lake, max_files: int | None = None, available_now: bool = False
) -> StreamingQuery:
    return start_rollup(spark, lake, WEEK_COUNTS, "weekly_rollup", max_files, available_now)


def gold_clusters(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_snapshot(spark, lake.path("gold_clusters"), schemas.CLUSTERS)


def gold_weekly(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_snapshot(spark, lake.path("gold_weekly"), schemas.WEEKLY_METRICS)


def cluster_latest(spark: SparkSession, lake: Lake) -> DataFrame:
    return latest_clusters(lake.read(spark, "cluster_snapshots"))


def rolled_up_weeks(spark: SparkSession, lake: Lake) -> DataFrame:
    return merged_weeks(WEEK_COUNTS.read(spark, lake))


def rolled_up_clusters(spark: SparkSession, lake: Lake) -> DataFrame:
    return merged_deltas(CLUSTER_COUNTS.read(spark, lake))
