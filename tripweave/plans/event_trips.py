"""Trips, uploads and log events derived from the ``events`` table.

The synthetic columns keep the coordinates on binary fractions and put some of them out of
range or leave them out, so that every routing rule meets rows of a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.points import point_text
from tripweave.functions.times import instant_text
from tripweave.operators.routing import decode, route
from tripweave.operators.uploads import to_envelope, trip_id_of
from tripweave.schemas import MARKER_FIELDS, TRIP_FIELDS
from tripweave.session import configure

REDELIVERY = "ing-re"
EMPTY = "ing-empty"
INCOMPLETE = "ing-3"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event: numbers and instant, no id and no check yet."""
    user = F.col("user_id")
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("ing-"), (event % 4).cast("string")).alias("ingestion_id"),
        (event.cast("long") + 1).alias("row_number"),
        F.col("event_type").alias("region"),
        F.when(event % 97 == 0, F.lit(200.0))
        .when(event % 101 == 0, None)
        .otherwise((user % 4).cast("double") * 10 - 15 + (user % 3).cast("double") / 16384)
        .alias("origin_lon"),
        F.when(event % 89 == 0, F.lit(-95.0))
        .otherwise((user % 4).cast("double") * 8 + 5 + (event % 3).cast("double") / 16384)
        .alias("origin_lat"),
        ((event % 2).cast("double") * 10 - 25).alias("destination_lon"),
        ((event % 2).cast("double") * 15 - 20).alias("destination_lat"),
        F.col("ts").cast("timestamp").alias("instant"),
        F.concat(F.lit("src_"), (user % 5).cast("string")).alias("datasource"),
    )


def sent_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip records as a producer sends them, with their ids."""
    return (
        raw_trips(spark, sf_dir)
        .withColumn("trip_id", trip_id_of("instant"))
        .withColumn("datetime", instant_text(F.col("instant")))
    )


def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored trips with a typed instant, for the questions asked of the serving table.

    The range checks stay plain comparisons on the scanned columns."""
    raw = raw_trips(spark, sf_dir)
    good = raw.where(
        F.col("origin_lon").between(-180.0, 180.0)
        & F.col("origin_lat").between(-90.0, 90.0)
        & F.col("destination_lon").between(-180.0, 180.0)
        & F.col("destination_lat").between(-90.0, 90.0)
    )
    return good.withColumn("trip_id", trip_id_of("instant")).withColumnRenamed(
        "instant", "datetime"
    )


def redelivered(trips: DataFrame) -> DataFrame:
    """Every trip once more under another ingestion, 40 days later on the log."""
    return trips.withColumns(
        {
            "ingestion_id": F.lit(REDELIVERY),
            "log_time": F.col("instant") + F.expr("interval 40 days"),
        }
    )


def announced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End markers: one per ingestion, one of them too high by 1, and one of an empty file."""
    first = table(spark, sf_dir, "events").select(
        F.concat(F.lit("ing-"), (F.col("event_id") % 4).cast("string")).alias("ingestion_id")
    )
    again = table(spark, sf_dir, "events").select(F.lit(REDELIVERY).alias("ingestion_id"))
    counted = (
        first.unionByName(again)
        .groupBy("ingestion_id")
        .agg(F.count(F.lit(1)).alias("total_rows"))
        .withColumn(
            "total_rows",
            F.when(F.col("ingestion_id") == INCOMPLETE, F.col("total_rows") + 1).otherwise(
                F.col("total_rows")
            ),
        )
    )
    empty = table(spark, sf_dir, "events").agg(F.lit(0).cast("long").alias("total_rows")).select(
        F.lit(EMPTY).alias("ingestion_id"), "total_rows"
    )
    return counted.unionByName(empty).select(
        F.lit("ingestion_end").alias("record_type"),
        "ingestion_id",
        F.concat("ingestion_id", F.lit(":end")).alias("control_id"),
        "total_rows",
    )


def marker_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_envelope(
        announced(spark, sf_dir), MARKER_FIELDS, F.lit("2024-06-01 00:00:00").cast("timestamp")
    )


def first_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = sent_trips(spark, sf_dir)
    return to_envelope(trips, TRIP_FIELDS, F.col("instant"))


def second_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = redelivered(sent_trips(spark, sf_dir))
    return to_envelope(trips, TRIP_FIELDS, F.col("log_time"))


def stray_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that are no trips: other record types, and texts that are no JSON."""
    when = F.lit("2024-06-02 00:00:00").cast("timestamp")
    other = table(spark, sf_dir, "conversations").select(
        F.lit(None).cast("string").alias("ingestion_id"), F.col("role").alias("record_type")
    )
    texts = table(spark, sf_dir, "documents").select(
        F.lit(None).cast("string").alias("key"), F.col("text").alias("value"), when.alias("timestamp")
    )
    return to_envelope(other, ["record_type"], when).unionByName(texts)


def unnumbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of documents as trip records that lack number, id and coordinates, by language;
    those of even id are delivered twice. A marker for each language."""
    when = F.lit("2024-06-03 00:00:00").cast("timestamp")
    texts = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("ingestion_id"), F.col("text").alias("region"), "doc_id"
    )
    twice = texts.unionByName(texts.where("doc_id % 2 = 0")).drop("doc_id")
    ends = texts.groupBy("ingestion_id").agg(F.count_distinct("region").alias("total_rows"))
    markers = ends.select(
        F.lit("ingestion_end").alias("record_type"),
        "ingestion_id",
        F.concat("ingestion_id", F.lit(":end")).alias("control_id"),
        "total_rows",
    )
    return to_envelope(twice, ["ingestion_id", "region"], when).unionByName(
        to_envelope(markers, MARKER_FIELDS, when)
    )


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        first_delivery(spark, sf_dir)
        .unionByName(second_delivery(spark, sf_dir))
        .unionByName(marker_events(spark, sf_dir))
        .unionByName(stray_events(spark, sf_dir))
    )


def routed_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(decode(first_delivery(spark, sf_dir)))


def routed_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(decode(all_events(spark, sf_dir)))


def upload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips as upload text. Some points lack the blank, some are lower case."""
    raw = raw_trips(spark, sf_dir)
    origin = point_text(F.col("origin_lon"), F.col("origin_lat"))
    spelled = (
        F.when(F.col("row_number") % 3 == 0, F.lower(origin))
        .when(F.col("row_number") % 3 == 1, F.replace(origin, F.lit("POINT "), F.lit("POINT")))
        .otherwise(origin)
    )
    return raw.select(
        "row_number",
        "ingestion_id",
        "region",
        spelled.alias("origin_coord"),
        point_text(F.col("destination_lon"), F.col("destination_lat")).alias("destination_coord"),
        F.date_format("instant", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("datetime"),
        "datasource",
    )


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trips of several years, by the customer's region."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    homes = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        table(spark, sf_dir, "orders")
        .join(homes, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("r_name").alias("region"),
            F.col("o_orderkey").cast("string").alias("trip_id"),
            F.col("o_orderdate").cast("timestamp").alias("datetime"),
        )
    )
