"""The registered queries: name -> (spark, table directory) -> DataFrame.

Instants leave as text, so that results compare without a zone or unit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.functions.cells import geohash
from tripweave.functions.points import point_lat, point_lon
from tripweave.functions.times import iso_week, iso_year, time_bucket, week_start
from tripweave.operators import (
    clusters as cl,
    completion,
    dedup,
    dimensions,
    regions,
    routing,
    uploads,
    weekly,
)
from tripweave.plans import event_trips as source
from tripweave.plans import pipeline
from tripweave.session import configure, fresh_dir
from tripweave.sources.tables import read_table, write_batch
from tripweave.sources.uploads import read_uploads, upload_files
from tripweave.streaming import answers, gold

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

REGION = "purchase"
BOX = (-6.0, 10.0, 10.0, 25.0)
NOWHERE = (100.0, 60.0, 110.0, 70.0)
SOURCE = "src_3"
#: Boxes across cells, with corners in another order, sides on cells' sides and on points, up to
#: the ends of the world, of no width, and beyond all trips.
BOXES = [
    BOX,
    (10.0, 25.0, -6.0, 10.0),
    (-5.625, 11.25, 5.625, 22.5),
    (-5.0, 13.0, 5.0, 21.0),
    (-5.0, 13.0, 180.0, 90.0),
    (-180.0, -90.0, 180.0, 90.0),
    (-200.0, -95.0, 0.0, 13.0001),
    (4.99999, 20.99999, 5.00001, 21.00001),
    (5.0, 0.0, 5.0, 90.0),
    NOWHERE,
]
HALF_TIME = "2024-01-16 00:00:00"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def text(name: str):
    return F.col(name).cast("string").alias(name)


# --- column functions -------------------------------------------------------------------


@query
def parse_points(spark, sf):
    rows = source.upload_rows(spark, sf)
    return rows.select(
        "ingestion_id",
        "row_number",
        point_lon(F.col("origin_coord")).alias("origin_lon"),
        point_lat(F.col("origin_coord")).alias("origin_lat"),
        point_lon(F.col("destination_coord")).alias("destination_lon"),
        point_lat(F.col("destination_coord")).alias("destination_lat"),
    )


@query
def trip_ids(spark, sf):
    return source.sent_trips(spark, sf).select("ingestion_id", "row_number", "trip_id", "datetime")


@query
def geohash_cells(spark, sf):
    trips = source.raw_trips(spark, sf)
    return cl.add_geohashes(trips).select(
        "ingestion_id", "row_number", "origin_geohash", "destination_geohash"
    )


@query
def geohash_precisions(spark, sf):
    trips = source.raw_trips(spark, sf)
    lon, lat = F.col("origin_lon"), F.col("origin_lat")
    return trips.select(
        "ingestion_id",
        "row_number",
        *(geohash(lon, lat, p).alias(f"geohash_{p}") for p in (1, 4, 8, 12)),
    )


@query
def time_buckets(spark, sf):
    events = source.table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts")
    )
    return events.select(
        "event_id",
        time_bucket(F.col("ts"), 30).cast("string").alias("half_hour"),
        time_bucket(F.col("ts"), 5).cast("string").alias("five_minutes"),
    )


@query
def iso_weeks(spark, sf):
    day = F.col("o_orderdate").cast("timestamp")
    return source.table(spark, sf, "orders").select(
        "o_orderkey",
        iso_week(day).alias("iso_week"),
        iso_year(day).cast("int").alias("iso_year"),
        week_start(day).cast("string").alias("week_start"),
    )


# --- routing ----------------------------------------------------------------------------


@query
def events_flattened(spark, sf):
    flat = routing.decode(source.first_delivery(spark, sf))
    return flat.select(
        "ingestion_id",
        "row_number",
        "trip_id",
        "region",
        "origin_lon",
        "origin_lat",
        "destination_lon",
        "destination_lat",
        "datetime",
        "datasource",
        text("kafka_timestamp"),
    )


@query
def split_counts(spark, sf):
    return (
        source.routed_all(spark, sf)
        .groupBy("route", "reject_reason")
        .agg(F.count(F.lit(1)).alias("events"))
    )


@query
def silver_trips(spark, sf):
    return _silver_columns(routing.trips(source.routed_first(spark, sf)))


def _silver_columns(silver: DataFrame) -> DataFrame:
    return silver.drop("raw_payload", "batch_id", "trip_day").withColumn(
        "kafka_timestamp", F.col("kafka_timestamp").cast("string")
    )


@query
def rejected_trips(spark, sf):
    rejected = routing.rejected(source.routed_all(spark, sf))
    return _rejected_columns(rejected)


def _rejected_columns(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("ingestion_id", "row_number", "trip_id", "reject_reason").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("origin_lon").alias("origin_lon"),
        F.min("origin_lat").alias("origin_lat"),
    )


@query
def markers(spark, sf):
    return routing.markers(source.routed_all(spark, sf)).withColumn(
        "kafka_timestamp", F.col("kafka_timestamp").cast("string")
    )


@query
def contract_expectations(spark, sf):
    return routing.expectations(source.routed_all(spark, sf))


# --- dedup and merge --------------------------------------------------------------------


def _landed(routed: DataFrame) -> DataFrame:
    """The routed log in the run's own folder, as ingest lands it: decoded and parsed once,
    however often the following steps read it."""
    path = fresh_dir(routed.sparkSession, "landed")
    routed.write.parquet(path)
    return routed.sparkSession.read.schema(routed.schema).parquet(path)


def _delivered(spark, sf) -> DataFrame:
    return _landed(routing.trips(source.routed_all(spark, sf)).drop("raw_payload"))


def _keys(trips: DataFrame) -> DataFrame:
    return trips.select("trip_id", "ingestion_id", "row_number", text("kafka_timestamp"))


@query
def dedup_first_wins(spark, sf):
    return _keys(dedup.first_wins(_delivered(spark, sf)))


@query
def merge_insert(spark, sf):
    """Everything delivered, merged into a table that holds the first half of the month."""
    delivered = _delivered(spark, sf)
    stored = dedup.first_wins(delivered.where(F.col("kafka_timestamp") < HALF_TIME))
    return _keys(dedup.insert_new(delivered, stored))


@query
def redelivery(spark, sf):
    """The whole second delivery against the stored first one: nothing is new."""
    first = _landed(routing.trips(source.routed_first(spark, sf)))
    again = _landed(
        routing.trips(routing.route(routing.decode(source.second_delivery(spark, sf))))
    )
    steps = {"stored": first, "delivered": again, "added": dedup.insert_new(again, first)}
    counted = [
        rows.agg(F.count(F.lit(1)).alias("trips")).select(F.lit(step).alias("step"), "trips")
        for step, rows in steps.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# --- clusters and weeks -----------------------------------------------------------------


def _clusters(spark, sf) -> DataFrame:
    return cl.cluster_counts(source.valid_trips(spark, sf))


@query
def clusters(spark, sf):
    return _clusters(spark, sf).withColumn("time_bucket", text("time_bucket"))


@query
def top_clusters(spark, sf):
    return cl.top_clusters(_clusters(spark, sf)).withColumn("time_bucket", text("time_bucket"))


@query
def clusters_by_week(spark, sf):
    return cl.clusters_by_week(_clusters(spark, sf))


@query
def cluster_total(spark, sf):
    return _clusters(spark, sf).agg(F.count(F.lit(1)).alias("clusters"))


@query
def weekly_metrics(spark, sf):
    return weekly.weekly_metrics(source.order_trips(spark, sf))


@query
def weekly_metrics_by_year(spark, sf):
    metrics = weekly.weekly_metrics(source.order_trips(spark, sf), by_year=True)
    return metrics.withColumn("iso_year", F.col("iso_year").cast("int"))


@query
def weekly_metrics_trips(spark, sf):
    return weekly.weekly_metrics(source.valid_trips(spark, sf))


@query
def weekly_average_region(spark, sf):
    return weekly.weekly_average(source.valid_trips(spark, sf), region=REGION)


@query
def weekly_average_bbox(spark, sf):
    return weekly.weekly_average(source.valid_trips(spark, sf), box=BOX)


@query
def weekly_average_none(spark, sf):
    return weekly.weekly_average(source.valid_trips(spark, sf), box=NOWHERE)


@query
def weekly_average_all(spark, sf):
    averages = weekly.weekly_average_by_region(source.valid_trips(spark, sf))
    return averages.withColumn("weekly_average", F.col("weekly_average").cast("double"))


@query
def weekly_average_answer(spark, sf):
    answer = weekly.weekly_average_answer(source.valid_trips(spark, sf), region=REGION, box=BOX)
    return answer.select("answer")


@query
def weekly_counts_bbox(spark, sf):
    inside = weekly.in_box(source.valid_trips(spark, sf), BOX)
    counts = weekly.weekly_counts(inside).orderBy("week_start")
    return counts.withColumn("week_start", text("week_start"))


def _per_box(answer: Callable[[tuple], DataFrame]) -> DataFrame:
    """One answer after the other, with the number of its box."""
    rows = [answer(box).select(F.lit(n).alias("box"), "*") for n, box in enumerate(BOXES)]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


@query
def weekly_average_cover(spark, sf):
    """The averages of several boxes, by ranges of cells, of a table in geohash order."""
    configure(spark)
    path = fresh_dir(spark, "served")
    rows = cl.add_geohashes(source.valid_trips(spark, sf))
    rows.repartitionByRange("origin_geohash").sortWithinPartitions("origin_geohash").write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return _per_box(
        lambda box: weekly.average_of_weeks(
            weekly.weekly_counts(weekly.in_box_by_cells(stored, box))
        )
    )


# --- regions and lookups ----------------------------------------------------------------


@query
def trips_per_region(spark, sf):
    return regions.trips_per_region(source.valid_trips(spark, sf))


@query
def top_regions(spark, sf):
    return regions.busiest_regions(source.valid_trips(spark, sf))


@query
def latest_source_top_regions(spark, sf):
    latest = regions.latest_source(source.valid_trips(spark, sf))
    return latest.withColumn("datetime", text("datetime"))


@query
def regions_of_source(spark, sf):
    return regions.regions_of_source(source.valid_trips(spark, sf), SOURCE)


@query
def stored_per_ingestion(spark, sf):
    return regions.stored_per_ingestion(source.valid_trips(spark, sf))


@query
def dim_regions(spark, sf):
    names = dimensions.new_names(source.valid_trips(spark, sf), "region")
    return dimensions.number_names(names, "region", "region_id")


@query
def dim_datasources(spark, sf):
    """A lookup of many names (one per customer) extended by those not known yet."""
    everyone = source.table(spark, sf, "customer").select(
        F.col("c_name").alias("datasource"), "c_mktsegment"
    )
    known = dimensions.number_names(
        dimensions.new_names(everyone.where("c_mktsegment = 'BUILDING'"), "datasource"),
        "datasource",
        "datasource_id",
    )
    added = dimensions.extend_dimension(everyone, "datasource", "datasource_id", known)
    return known.unionByName(added)


@query
def trip_points(spark, sf):
    return dimensions.with_points(source.valid_trips(spark, sf)).select(
        "trip_id", "origin_geom", "destination_geom"
    )


@query
def serving_trips(spark, sf):
    rows = dimensions.serving_rows(routing.trips(source.routed_first(spark, sf)))
    return rows.withColumn("datetime", text("datetime"))


# --- uploads and completion -------------------------------------------------------------


@query
def upload_split(spark, sf):
    parsed = uploads.parse_trips(source.upload_rows(spark, sf))
    return parsed.select("ingestion_id", "row_number", "trip_id", "datetime", "reject_reason")


@query
def end_markers(spark, sf):
    rows = uploads.parse_trips(source.upload_rows(spark, sf))
    return uploads.end_markers(uploads.accepted(rows), rows)


@query
def sent_progress(spark, sf):
    rows = uploads.parse_trips(source.upload_rows(spark, sf))
    return uploads.sent_progress(uploads.accepted(rows))


@query
def ingestion_status(spark, sf):
    rows = uploads.parse_trips(source.upload_rows(spark, sf))
    return uploads.upload_statuses(uploads.accepted(rows), rows)


@query
def ingestion_completion(spark, sf):
    routed = _landed(source.routed_all(spark, sf))
    stored = dedup.first_wins(routing.trips(routed))
    return completion.completion_report(routing.markers(routed), routed, stored)


@query
def completion_unnumbered(spark, sf):
    """Every document's text as a rejected row without number and id, some of them twice on
    the log: an ingestion per language, announced with the number of its different texts."""
    events = source.unnumbered_events(spark, sf)
    routed = _landed(routing.route(routing.decode(events)))
    stored = dedup.first_wins(routing.trips(routed))
    return completion.completion_report(routing.markers(routed), routed, stored)


def _written_uploads(spark, sf) -> str:
    """The upload rows as CSV files with a header, in the run's own folder."""
    configure(spark)
    path = fresh_dir(spark, "uploads")
    rows = source.upload_rows(spark, sf).drop("row_number", "ingestion_id")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return path


@query
def csv_uploads(spark, sf):
    """CSV files read back, parsed and published as events: what the log then decodes to."""
    path = _written_uploads(spark, sf)
    rows = uploads.assign_ingestions(read_uploads(spark, path), "load-1")
    files = uploads.assign_ingestions(upload_files(spark, path), "load-1")
    trips = uploads.accepted(uploads.parse_trips(rows))
    events = uploads.to_events(trips, files, F.current_timestamp())
    routed = routing.route(routing.decode(events))
    return routing.trips(routed).select(
        "trip_id",
        "region",
        "origin_lon",
        "origin_lat",
        "destination_lon",
        "destination_lat",
        "datetime",
        "datasource",
    )


@query
def csv_mixed_headers(spark, sf):
    """The upload rows as files of three headers: as they are, in another order, and with a
    column that no one asked for; each file read by its own header."""
    configure(spark)
    path = fresh_dir(spark, "uploads")
    rows = source.upload_rows(spark, sf)
    kept = [name for name in rows.columns if name not in ("row_number", "ingestion_id")]
    orders = [kept, kept[::-1], [*kept[2:], "row_number", *kept[:2]]]
    for part, columns in enumerate(orders):
        (
            rows.where(F.col("row_number") % len(orders) == part)
            .select(*columns)
            .write.mode("append")
            .option("header", True)
            .option("escape", '"')
            .csv(path)
        )
    read = read_uploads(spark, path)
    parsed = uploads.parse_trips(read.withColumn("ingestion_id", F.lit("mixed")))
    numbered = read.groupBy("upload_file").agg(
        F.count(F.lit(1)).alias("rows"), F.max("row_number").alias("last")
    )
    right = numbered.agg(F.expr("bool_and(rows = last)").alias("numbered"))
    return uploads.accepted(parsed).select("trip_id", "region", "datetime", "datasource").join(
        F.broadcast(right)
    )


@query
def csv_quoted_breaks(spark, sf):
    """Whole document texts, with their line breaks, quotes and commas, as a field of CSV files
    of three headers, read by many tasks: the text's digest, and whether rows are numbered in
    the order in which each file holds them."""
    configure(spark)
    path = fresh_dir(spark, "uploads")
    docs = source.table(spark, sf, "documents").select(
        F.col("text").alias("region"), F.col("lang").alias("datasource"),
        F.col("doc_id").cast("string").alias("datetime"), F.lit('POINT (1 2), "x"').alias("origin_coord"),
    )
    orders = [docs.columns, docs.columns[::-1], [*docs.columns[2:], *docs.columns[:2]]]
    number = F.col("datetime").cast("long")
    for part, columns in enumerate(orders):
        (
            docs.where(F.pmod(number, F.lit(len(orders))) == part)
            .repartitionByRange(number)
            .sortWithinPartitions(number)
            .select(*columns)
            .write.mode("append")
            .options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
            .csv(path)
        )
    rows = read_uploads(spark, path, multi_line=True)
    in_file = Window.partitionBy("upload_file").orderBy(F.col("datetime").cast("long"))
    return rows.select(
        F.col("datetime").cast("long").alias("doc_id"),
        F.col("datasource").alias("lang"),
        "origin_coord",
        F.sha2(F.coalesce("region", F.lit("")), 256).alias("text_sha256"),
        (F.row_number().over(in_file) == F.col("row_number")).alias("in_order"),
    )


@query
def csv_row_numbers(spark, sf):
    """Row numbers run from 1 to the number of rows in every file, none missing."""
    rows = read_uploads(spark, _written_uploads(spark, sf))
    per_file = rows.groupBy("upload_file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("row_number").alias("first"),
        F.max("row_number").alias("last"),
        F.count_distinct("row_number").alias("numbers"),
    )
    return per_file.agg(
        F.sum("rows").alias("rows"),
        F.expr("bool_and(first = 1 and last = rows and numbers = rows)").alias("numbered_from_1"),
    )


# --- streams ----------------------------------------------------------------------------


@query
def stream_bronze(spark, sf):
    bronze = pipeline.run(spark, sf).read(spark, "bronze")
    return bronze.groupBy("route", "reject_reason").agg(F.count(F.lit(1)).alias("events"))


@query
def stream_silver(spark, sf):
    return _silver_columns(pipeline.run(spark, sf).read(spark, "silver"))


@query
def stream_rejected(spark, sf):
    return _rejected_columns(pipeline.run(spark, sf).read(spark, "rejected"))


@query
def stream_markers(spark, sf):
    written = pipeline.run(spark, sf).read(spark, "markers").drop("batch_id")
    return written.withColumn("kafka_timestamp", text("kafka_timestamp"))


@query
def stream_clusters(spark, sf):
    lake = pipeline.run(spark, sf, "clusters")
    return gold.gold_clusters(spark, lake).withColumn("time_bucket", text("time_bucket"))


@query
def stream_weekly(spark, sf):
    return gold.gold_weekly(spark, pipeline.run(spark, sf, "weekly"))


@query
def stream_cluster_latest(spark, sf):
    lake = pipeline.run(spark, sf, "snapshots")
    return gold.cluster_latest(spark, lake).withColumn("time_bucket", text("time_bucket"))


@query
def stream_cluster_rollup(spark, sf):
    lake = pipeline.run(spark, sf, "rollup")
    return gold.rolled_up_clusters(spark, lake).withColumn("time_bucket", text("time_bucket"))


@query
def stream_weekly_rollup(spark, sf):
    return gold.rolled_up_weeks(spark, pipeline.run(spark, sf, "weekly_rollup"))


@query
def stream_dedup_state(spark, sf):
    return _keys(pipeline.run_state_dedup(spark, sf))


@query
def stream_serving(spark, sf):
    served = pipeline.run(spark, sf, "serving").read(spark, "serving")
    return served.drop("batch_id", "trip_day", "ingested_at").withColumn(
        "datetime", text("datetime")
    )


@query
def stream_lookups(spark, sf):
    lake = pipeline.run(spark, sf, "serving")
    named = [
        lake.read(spark, table).select(
            F.lit(table).alias("lookup"), F.col(id_name).alias("id"), F.col(name).alias("name")
        )
        for table, id_name, name in (
            ("regions", "region_id", "region"),
            ("datasources", "datasource_id", "datasource"),
        )
    ]
    return named[0].unionByName(named[1])


@query
def stream_status(spark, sf):
    return pipeline.run(spark, sf, "serving").read(spark, "status").select(
        "ingestion_id", "status", "total_rows", "stored_rows"
    )


@query
def stream_box_average(spark, sf):
    """The same boxes from counts of whole cells and the served trips of border cells."""
    lake = pipeline.run(spark, sf, "serving")
    return _per_box(lambda box: answers.box_average(spark, lake, box))


@query
def stream_region_averages(spark, sf):
    """Every region's average from the counts beside the served trips."""
    averages = answers.region_averages(spark, pipeline.run(spark, sf, "serving"))
    return averages.withColumn("weekly_average", F.col("weekly_average").cast("double"))


@query
def stream_expectations(spark, sf):
    """Rows that break each contract rule, as landing has counted them batch by batch."""
    counts = pipeline.run(spark, sf).read(spark, "landed_counts").where("kind = 'rule'")
    return counts.groupBy(F.col("name").alias("rule")).agg(F.sum("rows").alias("broken"))


@query
def foreign_redelivery(spark, sf):
    """Trips whose ids were made by another rule, some of them sent again with another time
    beside new ones: what is stored, and under which ingestion."""
    lake = pipeline.run_foreign(spark, sf)
    return lake.read(spark, "silver").select("trip_id", "ingestion_id", "row_number")


@query
def stream_rate_limited(spark, sf):
    """Five files of events, one a trigger, by a query that keeps running until another ends:
    the events of each batch."""
    lake, ended = pipeline.run_limited(spark, sf, files=5)
    bronze = lake.read(spark, "bronze")
    return bronze.groupBy("batch_id").agg(F.count(F.lit(1)).alias("events")).select(
        "events", F.lit(ended).alias("ended")
    )


@query
def stream_guards(spark, sf):
    """A batch of trips and one of nothing, served by a store whose first writes fail: stored
    trips, those with a time of insertion, and the batches that have rows."""
    lake = pipeline.run_guarded(spark, sf)
    served = lake.read(spark, "serving").agg(
        F.count(F.lit(1)).alias("served"), F.count("ingested_at").alias("stamped")
    )
    landed = lake.read(spark, "bronze").agg(F.count_distinct("batch_id").alias("batches"))
    return served.join(F.broadcast(landed))


@query
def upload_ingestions(spark, sf):
    """Every file of a load is an ingestion with an id of its own, the same each time."""
    path = _written_uploads(spark, sf)
    rows = read_uploads(spark, path).select("upload_file", "row_number")
    ids = [
        uploads.assign_ingestions(rows, load).withColumnRenamed("ingestion_id", name)
        for load, name in (("load-1", "first"), ("load-1", "again"), ("load-2", "other"))
    ]
    on = ["upload_file", "row_number"]
    both = ids[0].join(ids[1], on).join(ids[2], on)
    form = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return both.agg(
        F.count_if(F.col("first").rlike(form)).alias("rows"),
        F.count_if((F.col("first") != F.col("again")) | (F.col("first") == F.col("other"))).alias("wrong"),
        (F.count_distinct("first") - F.count_distinct("upload_file")).alias("too_many"),
    )


@query
def table_additive_column(spark, sf):
    """A table whose first half was written before ``ingestion_id`` was a column."""
    configure(spark)
    trips = source.valid_trips(spark, sf).select("trip_id", "ingestion_id", "datetime")
    path = fresh_dir(spark, "additive")
    old = F.col("datetime") < HALF_TIME
    write_batch(trips.where(old).drop("ingestion_id"), path, 0)
    write_batch(trips.where(~old), path, 1)
    schema = trips.schema.add("batch_id", "long")
    return (
        read_table(spark, path, schema)
        .groupBy("ingestion_id")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query
def stream_bounded_dedup(spark, sf):
    """Silver kept by a state of three days: trips that come first long after their time, and
    copies of all of them at the end."""
    lake = pipeline.run_bounded(spark, sf, "3 days")
    return lake.read(spark, "silver").select("trip_id", "region", "datetime", "datasource")


@query
def stream_compacted(spark, sf):
    """What silver, serving and the roll-ups say when closed batches are merged after every
    delivery, and whether the last merge changed it."""
    return pipeline.run_compacted(spark, sf)


@query
def stream_tiered_rollup(spark, sf):
    """Clusters from the tiers of forty batches, one of them counted again."""
    lake = pipeline.run_batches(spark, sf, batches=40, replayed=5)
    return gold.rolled_up_clusters(spark, lake).withColumn("time_bucket", text("time_bucket"))


@query
def stream_status_feed(spark, sf):
    """The statuses of every ingestion as its feed shows them, read as one stream."""
    lake = pipeline.run(spark, sf, "serving")
    return pipeline.feed_of_all(spark, lake).select(
        "ingestion_id", "status", "total_rows", "stored_rows"
    )


@query
def stream_uploads(spark, sf):
    """CSV files published, landed and served: what the completion statuses add up to."""
    lake = pipeline.run_uploads(spark, _written_uploads(spark, sf))
    status = lake.read(spark, "status")
    done = F.col("status") == "TRIPS_PG_COMPLETED"
    return status.agg(
        F.sum(F.when(done, F.col("total_rows"))).alias("announced"),
        F.sum(F.when(done, F.col("stored_rows"))).alias("stored"),
        (F.count_if(done) == F.count_if(F.col("status") == "STARTED")).alias("all_complete"),
    )
