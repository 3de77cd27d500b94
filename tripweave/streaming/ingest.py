"""Event log -> bronze, silver, markers and rejected, one pass over each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave.operators import routing
from tripweave.schemas import BRONZE_COMPLETED, SILVER_COMPLETED
from tripweave.sources.lake import Lake
from tripweave.sources.tables import write_batch, write_by_day
from tripweave.streaming.runner import TRIGGER_SECONDS, start
from tripweave.streaming.status import watch_failures


def land_batch(spark: SparkSession, flat: DataFrame, batch_id: int, lake: Lake) -> None:
    """Write the bronze batch, then derive every other table from what was written.

    The bronze files are the durable copy of the batch: the log is read and the JSON parsed
    once, and a lost executor costs a re-read of columnar files. Rows are counted by route and
    broken rule from the narrow columns of these files, so that nothing else is read, or written,
    for a route without rows. (Observed by the writing pass, the counts would be updated row by
    row without generated code, which takes as long as the parsing.)
    ``spark`` is the outer session, whose adaptive execution a micro-batch's own turns off.
    """
    routed = routing.with_trip_day(routing.route(flat)).drop("instant")
    write_batch(routed, lake.path("bronze"), batch_id, ("route",), len(routing.ROUTES))
    landed = lake.landed(spark, batch_id)
    counts = routing.counts_of(landed)
    if not any(counts[name] for name in routing.ROUTES):
        return
    if counts["marker"]:
        markers = routing.markers(landed)
        lake.write_status(markers, BRONZE_COMPLETED, "bronze", batch_id)
    if counts["trip"]:
        merge_silver(spark, landed, batch_id, lake)
    if counts["marker"]:
        write_batch(markers, lake.path("markers"), batch_id)
        lake.write_status(markers, SILVER_COMPLETED, "silver", batch_id)
    if counts["rejected"]:
        write_batch(routing.rejected(landed), lake.path("rejected"), batch_id)
    write_batch(landed_counts(spark, counts), lake.path("landed_counts"), batch_id)
    # Last, because these rows tell the serving job that the batch is complete.
    write_batch(
        landed.groupBy("ingestion_id").agg(F.count(F.lit(1)).alias("received")),
        lake.path("arrivals"),
        batch_id,
    )


def landed_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """What landing has counted: ``kind`` is route or rule."""
    rows = [("route" if n in routing.ROUTES else "rule", n, rows) for n, rows in counts.items()]
    return spark.createDataFrame(rows, "kind string, name string, rows long").coalesce(1)


def merge_silver(spark: SparkSession, landed: DataFrame, batch_id: int, lake: Lake) -> None:
    """Insert the trips whose id is new. Only earlier batches are looked at, so a replay
    decides the same; only the partitions of the batch's days are read."""
    candidates = landed.where("route = 'trip'").select(
        *routing.SILVER_COLUMNS, "trip_day"
    )

    def stored(days: list[str] | None) -> DataFrame:
        if days is None:
            return lake.read(spark, "silver", before=batch_id)
        return lake.read_days(spark, "silver", days, before=batch_id)

    fresh = routing.insert_by_day(candidates, stored)
    # Files by day, a large day over several tasks.
    write_by_day(fresh.hint("rebalance", "trip_day"), lake.path("silver"), batch_id)


def start_ingest(
    spark: SparkSession,
    events: DataFrame,
    lake: Lake,
    available_now: bool = False,
    every: float = TRIGGER_SECONDS,
) -> StreamingQuery:
    watch_failures(spark, lake)
    return start(
        routing.decode(events),
        lambda batch, batch_id: land_batch(spark, batch, batch_id, lake),
        "ingest",
        lake.checkpoint("ingest"),
        available_now=available_now,
        every=every,
    )


def first_deliveries(events: DataFrame) -> DataFrame:
    """Dedup by state instead of by table: the stream of trips, each id once.

    Of copies in different batches the first batch's passes; of copies in one batch any one.
    Every id stays in state, so a trip may come at any time; ``merge_silver`` keeps no state.
    """
    return routing.trips(routing.route(routing.decode(events))).dropDuplicates(["trip_id"])
