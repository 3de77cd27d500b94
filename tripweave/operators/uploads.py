"""From upload rows to trip events, markers and upload statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions.identity import control_id, trip_id
from tripweave.functions.once import with_computed
from tripweave.functions.points import in_lat_range, in_lon_range, point_lat, point_lon
from tripweave.functions.times import instant_text, parse_instant
from tripweave.schemas import COMPLETED, IN_PROGRESS, MARKER_FIELDS, STARTED, TRIP_FIELDS

PROGRESS_STEP = 100
PROGRESS_CHUNK = 1_000_000


def assign_ingestions(rows: DataFrame, load_id: str) -> DataFrame:
    """One ingestion per file: an id that is the same each time the load is evaluated."""
    digest = F.md5(F.concat(F.lit(f"{load_id}|"), "upload_file"))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return rows.withColumn(
        "ingestion_id", F.concat_ws("-", *(F.substring(digest, *cut) for cut in cuts))
    )


def parse_trips(rows: DataFrame) -> DataFrame:
    """Typed trip fields, ``trip_id`` and ``reject_reason`` (NULL for a good row)."""
    typed = with_computed(
        rows,
        {
            "origin_lon": point_lon(F.col("origin_coord")),
            "origin_lat": point_lat(F.col("origin_coord")),
            "destination_lon": point_lon(F.col("destination_coord")),
            "destination_lat": point_lat(F.col("destination_coord")),
            "instant": parse_instant(F.col("datetime")),
        },
    )
    lons = [F.col("origin_lon"), F.col("destination_lon")]
    lats = [F.col("origin_lat"), F.col("destination_lat")]
    required = ["region", "origin_coord", "destination_coord", "datetime", "datasource"]
    reason = (
        F.when(any_of(F.col(name).isNull() for name in required), "missing_field")
        .when(any_of(c.isNull() for c in lons + lats), "bad_point")
        .when(
            any_of([*(~in_lon_range(c) for c in lons), *(~in_lat_range(c) for c in lats)]),
            "coordinate_out_of_range",
        )
        .when(F.col("instant").isNull(), "bad_datetime")
    )
    return (
        typed.withColumn("reject_reason", reason)
        .withColumn(
            "trip_id",
            F.when(F.col("reject_reason").isNull(), trip_id_of("instant")),
        )
        .withColumn("datetime", F.coalesce(instant_text(F.col("instant")), "datetime"))
        .drop("instant", "origin_coord", "destination_coord")
    )


def any_of(conditions) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def trip_id_of(instant: str) -> Column:
    return trip_id(
        F.col("region"),
        F.col("origin_lon"),
        F.col("origin_lat"),
        F.col("destination_lon"),
        F.col("destination_lat"),
        F.col(instant),
        F.col("datasource"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    good = parsed.where("reject_reason is null")
    return good.withColumn("row_number", F.col("row_number").cast("long")).select(*TRIP_FIELDS)


def to_envelope(records: DataFrame, fields: list[str], timestamp: Column) -> DataFrame:
    """Event log rows; NULL fields are left out of the JSON."""
    return records.select(
        F.col("ingestion_id").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        timestamp.alias("timestamp"),
    )


def end_markers(trips: DataFrame, ingestions: DataFrame) -> DataFrame:
    """One marker per ingestion with the number of events sent, zero included."""
    sent = trips.groupBy("ingestion_id").agg(F.count(F.lit(1)).alias("sent"))
    return (
        ingestions.select("ingestion_id")
        .distinct()
        .join(sent, "ingestion_id", "left")
        .select(
            F.lit("ingestion_end").alias("record_type"),
            "ingestion_id",
            control_id(F.col("ingestion_id")).alias("control_id"),
            F.coalesce("sent", F.lit(0)).cast("long").alias("total_rows"),
        )
    )


def to_events(trips: DataFrame, ingestions: DataFrame, timestamp: Column) -> DataFrame:
    """All events of a load. Consumers count against the marker; they need no order."""
    return to_envelope(trips, TRIP_FIELDS, timestamp).unionByName(
        to_envelope(end_markers(trips, ingestions), MARKER_FIELDS, timestamp)
    )


def sent_progress(
    trips: DataFrame, step: int = PROGRESS_STEP, chunk: int = PROGRESS_CHUNK
) -> DataFrame:
    """The running sent count each time it reaches a multiple of ``step``.

    Counts per chunk of row numbers are cheap partial aggregates; a running sum over the
    chunks tells which multiples fall into each. No task sees an ingestion's rows, and no
    row expands to more than ``chunk / step`` values.
    """
    chunks = trips.groupBy(
        "ingestion_id", F.floor(F.col("row_number") / chunk).alias("chunk")
    ).agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("ingestion_id").orderBy("chunk"))
    first = F.col("upto") - F.col("rows")
    low = first - first % step + step
    return (
        chunks.withColumn("upto", upto)
        .where(low <= F.col("upto"))
        .select("ingestion_id", F.explode(F.sequence(low, F.col("upto"), F.lit(step))).alias("rows"))
    )


def upload_statuses(trips: DataFrame, ingestions: DataFrame) -> DataFrame:
    """STARTED, IN_PROGRESS at every 100 rows, COMPLETED with the row count."""
    totals = end_markers(trips, ingestions)
    no_rows = F.lit(None).cast("long")
    return (
        totals.select("ingestion_id", F.lit(STARTED).alias("status"), no_rows.alias("rows"))
        .unionByName(
            sent_progress(trips).select(
                "ingestion_id", F.lit(IN_PROGRESS).alias("status"), "rows"
            )
        )
        .unionByName(
            totals.select(
                "ingestion_id",
                F.lit(COMPLETED).alias("status"),
                F.col("total_rows").cast("long").alias("rows"),
            )
        )
    )
