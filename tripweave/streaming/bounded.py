"""Silver by a bounded state: trips in time are told apart by state, late ones by the table.

A trip's event time is its own instant, which copies of it share. ``dropDuplicatesWithinWatermark``
holds the ids of the last ``delay`` alone, and passes nothing older. What it drops as late may
still be a first delivery: so the same query hands on all that was sent, and of the rows that are
old enough to have been dropped those that the table does not have are inserted. The table is
asked for these rows only, in the days they belong to. No trip is lost and none comes twice,
however late, and the state does not grow with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave.operators import routing
from tripweave.sources.lake import Lake
from tripweave.sources.tables import write_batch, write_by_day
from tripweave.streaming.runner import start

def sent_and_in_time(events: DataFrame, delay: str) -> DataFrame:
    """All trips of the log, ``kept`` false, beside the first of each id that is in time."""
    routed = routing.with_trip_day(routing.route(routing.decode(events)))
    trips = routed.where("route = 'trip'").select(*routing.SILVER_COLUMNS, "trip_day", "instant")
    first = trips.withWatermark("instant", delay).dropDuplicatesWithinWatermark(["trip_id"])
    return trips.withColumn("kept", F.lit(False)).unionByName(first.withColumn("kept", F.lit(True)))


def _latest(spark: SparkSession, lake: Lake, batch_id: int):
    """The latest instant of the batches before this one, which the last of them has noted."""
    rows = lake.read_batches(spark, "high_water", [batch_id - 1])
    return rows.agg(F.max("latest")).first()[0]


def insert_bounded(
    spark: SparkSession, batch: DataFrame, batch_id: int, lake: Lake, delay: str
) -> None:
    """Trips in time as they come; late ones, and ids that say nothing of their instant, if the
    batches before do not have them."""
    write_batch(batch, lake.path("bounded_batches"), batch_id)  # state is asked once
    staged = lake.read_batches(spark, "bounded_batches", [batch_id])
    latest = _latest(spark, lake, batch_id)
    foreign = F.col("trip_day").startswith(routing.FOREIGN)
    in_time = staged.where(F.col("kept") & ~foreign)
    if latest is None:
        doubtful = staged.where(F.col("kept") & foreign)
    else:
        # Spark's watermark is in milliseconds; a row that was not dropped is found in the batch.
        line = F.lit(latest) - F.expr(f"interval {delay}") + F.expr("interval 1 second")
        old = ~F.col("kept") & (F.col("instant") <= line)
        doubtful = staged.where(old | (F.col("kept") & foreign)).join(
            in_time.select("trip_id"), "trip_id", "left_anti"
        )

    def stored(days: list[str] | None) -> DataFrame:
        if days is None:
            return lake.read(spark, "silver", before=batch_id)
        return lake.read_days(spark, "silver", days, before=batch_id)

    columns = [*routing.SILVER_COLUMNS, "trip_day"]
    late = routing.insert_by_day(doubtful.select(*columns), stored)
    rows = in_time.select(*columns).unionByName(late)
    write_by_day(rows.hint("rebalance", "trip_day"), lake.path("silver"), batch_id)
    reached = staged.agg(F.max("instant").alias("latest")).select(
        F.greatest("latest", F.lit(latest).cast("timestamp")).alias("latest")
    )
    write_batch(reached, lake.path("high_water"), batch_id)


def start_bounded_silver(
    spark: SparkSession, events: DataFrame, lake: Lake, delay: str, available_now: bool = False
) -> StreamingQuery:
    """Keep silver from the log; ``delay`` is how far behind the latest trip state reaches."""
    return start(
        sent_and_in_time(events, delay),
        lambda batch, batch_id: insert_bounded(spark, batch, batch_id, lake, delay),
        "bounded_silver",
        lake.checkpoint("bounded_silver"),
        available_now=available_now,
    )
