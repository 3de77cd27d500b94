"""The streaming jobs over a staged event log, in two deliveries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.times import instant_text
from tripweave.operators import routing
from tripweave.operators.clusters import instant_of
from tripweave.operators.uploads import to_envelope
from tripweave.plans import event_trips as source
from tripweave.schemas import TRIP_FIELDS
from tripweave.session import configure, fresh_dir
from tripweave.sources.event_log import append_events, file_stream
from tripweave.sources.lake import COMPACTED, Lake
from tripweave.sources.tables import overwrite_partitions, write_batch
from tripweave.streaming import answers, gold
from tripweave.streaming.bounded import start_bounded_silver
from tripweave.streaming.ingest import first_deliveries, land_batch, start_ingest
from tripweave.streaming.publish import publish_uploads
from tripweave.streaming.runner import finish, run_until_any_ends, start
from tripweave.streaming.serving import LakeStore, start_serving
from tripweave.streaming.status import all_statuses

GOLD_JOBS: dict[str, Callable] = {
    "clusters": gold.start_clusters,
    "weekly": gold.start_weekly,
    "snapshots": gold.start_cluster_snapshots,
    "rollup": gold.start_cluster_rollup,
    "weekly_rollup": gold.start_weekly_rollup,
    "serving": start_serving,
}


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """First every trip with its end markers, then every trip again with stray events."""
    return [
        source.first_delivery(spark, sf_dir).unionByName(source.marker_events(spark, sf_dir)),
        source.second_delivery(spark, sf_dir).unionByName(source.stray_events(spark, sf_dir)),
    ]


def run(spark: SparkSession, sf_dir: str, *jobs: str) -> Lake:
    """Land both deliveries, with the given jobs brought up to date after each of them.

    Every job stops in between and resumes from its checkpoint."""
    configure(spark)
    lake = Lake(fresh_dir(spark, "lake")).create(spark)
    log = lake.path("log")
    for delivery in deliveries(spark, sf_dir):
        append_events(delivery, log)
        finish(start_ingest(spark, file_stream(spark, log), lake, available_now=True))
        finish(*(GOLD_JOBS[job](spark, lake, available_now=True) for job in jobs))
    return lake


def contents(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """What a reader gets of the lake, each as rows that add up and the number that does."""
    silver, serving = lake.read(spark, "silver"), lake.read(spark, "serving")
    return {
        "silver": silver.select(F.col("row_number").alias("n")),
        "serving": serving.select(F.length("origin_geohash").alias("n")),
        "weeks": gold.rolled_up_weeks(spark, lake).select(F.col("trip_count").alias("n")),
        "clusters": gold.rolled_up_clusters(spark, lake).select(F.col("trip_count").alias("n")),
        "averages": answers.region_averages(spark, lake).select(F.col("total_trips").alias("n")),
    }


def summed(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row for each answer: its rows and their sum."""
    out = None
    for name, rows in contents(spark, lake).items():
        own = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total")).select(
            F.lit(name).alias("answer"), "rows", "total"
        )
        out = own if out is None else out.unionByName(own)
    return out


def compact_closed(spark: SparkSession, lake: Lake, margin: int) -> None:
    """Merge all batches but the newest ``margin`` of the tables that can be merged."""
    for table in COMPACTED:
        newest = lake.newest_batch(spark, table)
        if newest is not None:
            lake.compacted(table).compact(spark, newest + 1 - margin)


def run_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries in several batches; closed batches are merged in between, those of ended
    jobs as well, and what is replaced is dropped. The answers before and after the last time."""
    configure(spark)
    lake = Lake(fresh_dir(spark, "lake")).create(spark)
    log = lake.path("log")
    for delivery in deliveries(spark, sf_dir):
        # By a value: dealt in turn, all events of a task would be sorted first, payloads and all.
        append_events(delivery.repartition(2, "timestamp"), log)
        finish(start_ingest(spark, file_stream(spark, log, 1), lake, available_now=True))
        jobs = ("serving", "rollup", "weekly_rollup")
        finish(*(GOLD_JOBS[job](spark, lake, available_now=True) for job in jobs))
        compact_closed(spark, lake, margin=1)
    before = {r.answer: (r.rows, r.total) for r in summed(spark, lake).collect()}
    compact_closed(spark, lake, margin=0)
    for table in COMPACTED:
        lake.compacted(table).clean(spark)
    same = F.lit(False)
    for answer, (rows, total) in before.items():
        same = same | (
            (F.col("answer") == answer) & (F.col("rows") == rows) & (F.col("total") == total)
        )
    return summed(spark, lake).withColumn("unchanged", same)


def run_batches(spark: SparkSession, sf_dir: str, batches: int, replayed: int) -> Lake:
    """Silver as so many batches, one span of time each, rolled up a few at a time; then one of
    them once more."""
    configure(spark)
    lake = Lake(fresh_dir(spark, "lake")).create(spark)
    trips = routing.with_trip_day(source.routed_first(spark, sf_dir)).where("route = 'trip'")
    span = F.unix_seconds(instant_of(trips)) - F.lit(1704067200)
    number = F.least(
        F.floor(span * batches / F.lit(31 * 86400)), F.lit(batches - 1)
    ).cast("long")
    rows = trips.withColumn("batch_id", number).select(
        *routing.SILVER_COLUMNS, "trip_day", "batch_id"
    )

    def land(some: DataFrame) -> None:
        by_batch = some.repartition("batch_id")
        overwrite_partitions(by_batch, lake.path("silver"), ("batch_id", "trip_day"))
        arrived = some.groupBy("batch_id", "ingestion_id").agg(F.count(F.lit(1)).alias("received"))
        overwrite_partitions(
            arrived.repartition("batch_id"), lake.path("arrivals"), ("batch_id",)
        )

    land(rows)
    finish(gold.start_cluster_rollup(spark, lake, max_files=9, available_now=True))
    land(rows.where(F.col("batch_id") == replayed))
    finish(gold.start_cluster_rollup(spark, lake, available_now=True))
    return lake


def run_foreign(spark: SparkSession, sf_dir: str) -> Lake:
    """Two batches of trips with ids of a producer's own. The second has every 400th trip again,
    a day later, and every 250th under a new id."""
    configure(spark)
    lake = Lake(fresh_dir(spark, "lake")).create(spark)
    sent = source.sent_trips(spark, sf_dir)
    own = F.concat(F.lit("trip-"), F.col("row_number").cast("string"))
    first = sent.withColumn("trip_id", own)
    later = F.col("instant") + F.expr("interval 1 day")
    again = first.where("row_number % 400 = 0").withColumns(
        {"instant": later, "datetime": instant_text(later)}
    )
    new = sent.where("row_number % 250 = 0").withColumn("trip_id", F.concat(F.lit("new-"), own))
    second = again.unionByName(new).withColumn("ingestion_id", F.lit(source.REDELIVERY))
    for batch_id, trips in enumerate((first, second)):
        events = to_envelope(trips, TRIP_FIELDS, F.col("instant"))
        land_batch(spark, routing.decode(events), batch_id, lake)
    return lake


def run_bounded(spark: SparkSession, sf_dir: str, delay: str) -> Lake:
    """The trips of the month's halves, all but every 50th; then those; then all once more. Each
    is a delivery of its own, with a restart in between."""
    configure(spark)
    lake = Lake(fresh_dir(spark, "lake")).create(spark)
    log, held = lake.path("log"), F.col("row_number") % 50 == 0
    sent = source.sent_trips(spark, sf_dir)
    half = F.col("instant") < F.lit("2024-01-16").cast("timestamp")
    parts = [sent.where(half & ~held), sent.where(~half & ~held), sent.where(held)]
    for part in [*parts, source.redelivered(sent).drop("log_time")]:
        append_events(to_envelope(part, TRIP_FIELDS, F.col("instant")), log)
        events = file_stream(spark, log)
        finish(start_bounded_silver(spark, events, lake, delay, available_now=True))
    return lake


def run_limited(spark: SparkSession, sf_dir: str, files: int) -> tuple[Lake, bool]:
    """Land one file a trigger with a running query, and wait until another query ends."""
    configure(spark)
    lake = Lake(fresh_dir(spark, "lake")).create(spark)
    log = lake.path("log")
    sent = source.sent_trips(spark, sf_dir)
    for part in range(files):
        trips = sent.where(F.col("row_number") % files == part)
        # One file, and so one task that writes it; all tasks make the events.
        append_events(to_envelope(trips, TRIP_FIELDS, F.col("instant")).repartition(1), log)
    query = start_ingest(spark, file_stream(spark, log, max_files=1), lake, every=0.5)
    try:
        query.processAllAvailable()
        spark.streams.resetTerminated()
        gold.start_weekly_rollup(spark, lake, available_now=True)
        ended = run_until_any_ends(spark, 300)
    finally:
        query.stop()
    return lake, bool(ended)


class FlakyStore(LakeStore):
    """A store whose first writes fail after they have written."""

    failures = 2

    def insert(self, rows: DataFrame, batch_id: int) -> None:
        super().insert(rows, batch_id)
        if FlakyStore.failures:
            FlakyStore.failures -= 1
            raise OSError("the connection was lost")


def run_guarded(spark: SparkSession, sf_dir: str) -> Lake:
    configure(spark)
    lake = Lake(fresh_dir(spark, "lake")).create(spark)
    flat = routing.decode(source.first_delivery(spark, sf_dir))
    for batch_id, rows in enumerate((flat, flat.where("false"))):
        land_batch(spark, rows, batch_id, lake)
    FlakyStore.failures = 2
    finish(start_serving(spark, lake, FlakyStore(lake), available_now=True))
    return lake


def run_uploads(spark: SparkSession, path: str) -> Lake:
    """CSV files all the way to the serving table."""
    configure(spark)
    lake = Lake(fresh_dir(spark, "lake")).create(spark)
    publish_uploads(spark, path, lake)
    finish(start_ingest(spark, file_stream(spark, lake.path("log")), lake, available_now=True))
    finish(start_serving(spark, lake, available_now=True))
    return lake


def feed_of_all(spark: SparkSession, lake: Lake) -> DataFrame:
    """The status feed of every ingestion, copied out by a stream that reads it once."""
    out = lake.path("feed_copy")
    query = start(
        all_statuses(spark, lake),
        lambda batch, batch_id: write_batch(batch.drop("batch_id"), out, batch_id),
        "status_feed",
        lake.checkpoint(f"status_feed_{uuid.uuid4().hex}"),
        available_now=True,
    )
    finish(query)
    return spark.read.parquet(out)


def run_state_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips deduplicated by state alone, written batch by batch."""
    configure(spark)
    lake = Lake(fresh_dir(spark, "state-dedup"))
    log, out = lake.path("log"), lake.path("first_deliveries")
    for delivery in deliveries(spark, sf_dir):
        append_events(delivery, log)
        query = start(
            first_deliveries(file_stream(spark, log)),
            lambda batch, batch_id: write_batch(batch, out, batch_id),
            "state_dedup",
            lake.checkpoint("state_dedup"),
            available_now=True,
        )
        finish(query)
    return spark.read.parquet(out)
