"""Every table and event schema, in one place. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


S, I, L, D, TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampType(),
)

# Column names of an upload file.
UPLOAD = _fields(
    ("region", S),
    ("origin_coord", S),
    ("destination_coord", S),
    ("datetime", S),
    ("datasource", S),
)

# Fields of the two event kinds that share one stream.
TRIP_FIELDS = [
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
]
MARKER_FIELDS = ["record_type", "ingestion_id", "control_id", "total_rows"]

PAYLOAD = _fields(
    ("record_type", S),
    ("ingestion_id", S),
    ("control_id", S),
    ("total_rows", L),
    ("row_number", L),
    ("trip_id", S),
    ("region", S),
    ("origin_lon", D),
    ("origin_lat", D),
    ("destination_lon", D),
    ("destination_lat", D),
    ("datetime", S),
    ("datasource", S),
)

SENT_TRIPS = T.StructType(
    [*(PAYLOAD[name] for name in TRIP_FIELDS), T.StructField("load_id", S, True)]
)

ENVELOPE = _fields(("key", S), ("value", S), ("timestamp", TS))

# The statuses of an ingestion.
STARTED = "STARTED"
IN_PROGRESS = "IN_PROGRESS"
COMPLETED = "COMPLETED"
BRONZE_COMPLETED = "BRONZE_COMPLETED"
SILVER_COMPLETED = "SILVER_COMPLETED"
TRIPS_PG_COMPLETED = "TRIPS_PG_COMPLETED"
FAILED = "FAILED"

_AUDIT = [T.StructField("raw_payload", S, True), T.StructField("kafka_timestamp", TS, True)]
_BATCH = T.StructField("batch_id", L, True)
_DAY = T.StructField("trip_day", S, True)

# Columns of the silver table.
SILVER_COLUMNS = [*TRIP_FIELDS, "raw_payload", "kafka_timestamp"]

_ROUTING = [
    T.StructField("reject_reason", S, True),
    _DAY,
    _BATCH,
    T.StructField("route", S, True),
]

BRONZE = T.StructType([*PAYLOAD.fields, *_AUDIT, *_ROUTING])
SILVER = T.StructType([*(PAYLOAD[name] for name in TRIP_FIELDS), *_AUDIT, _DAY, _BATCH])
REJECTED = T.StructType(
    [*PAYLOAD.fields, *_AUDIT, T.StructField("reject_reason", S, True), _BATCH]
)
MARKERS = T.StructType(
    [
        *_fields(("ingestion_id", S), ("control_id", S), ("total_rows", L)).fields,
        _AUDIT[1],
        _BATCH,
    ]
)
ARRIVALS = T.StructType([*_fields(("ingestion_id", S), ("received", L)).fields, _BATCH])

STATUS = T.StructType(
    [
        *_fields(
            ("ingestion_id", S),
            ("status", S),
            ("rows", L),
            ("total_rows", L),
            ("stored_rows", L),
            ("message", S),
            ("query", S),
        ).fields,
        _BATCH,
    ]
)

# Columns of the gold tables.
CLUSTERS = _fields(
    ("origin_cell", S),
    ("destination_cell", S),
    ("time_bucket", TS),
    ("trip_count", L),
    ("iso_week", I),
)
CLUSTER_SNAPSHOTS = T.StructType([*CLUSTERS.fields, _BATCH])
WEEKLY_METRICS = _fields(
    ("region", S), ("iso_week", I), ("trip_count", L), ("avg_trips_per_day", D)
)
WEEKLY_DELTAS = T.StructType(
    [*_fields(("region", S), ("iso_week", I), ("trip_count", L)).fields, _BATCH]
)

#: What a batch's landing counted: rows by route, and rows that break each contract rule.
LANDED_COUNTS = T.StructType(
    [*_fields(("kind", S), ("name", S), ("rows", L)).fields, _BATCH]
)

#: A batch of the bounded job as its state has passed it on: all trips sent, and those kept.
BOUNDED_BATCHES = T.StructType(
    [
        *(field for field in SILVER.fields if field.name != "batch_id"),
        *_fields(("instant", TS)).fields,
        T.StructField("kept", T.BooleanType()),
        _BATCH,
    ]
)

#: The latest instant of all trips up to a batch.
HIGH_WATER = T.StructType([*_fields(("latest", TS)).fields, _BATCH])

#: Trips per geohash cell of the origin, region and week, of each serving batch.
CELL_WEEKS = T.StructType(
    [
        *_fields(("cell", S), ("region", S), ("week_start", TS), ("trip_count", L)).fields,
        _BATCH,
    ]
)

# Columns of the serving table.
SERVING_COLUMNS = [
    "trip_id",
    "ingestion_id",
    "region",
    "origin_lon",
    "origin_lat",
    "destination_lon",
    "destination_lat",
    "origin_geohash",
    "destination_geohash",
    "datetime",
    "datasource",
]
SERVING = T.StructType(
    [
        *_fields(
            ("trip_id", S),
            ("ingestion_id", S),
            ("region", S),
            ("origin_lon", D),
            ("origin_lat", D),
            ("destination_lon", D),
            ("destination_lat", D),
            ("origin_geohash", S),
            ("destination_geohash", S),
            ("datetime", TS),
            ("datasource", S),
            ("origin_geom", S),
            ("destination_geom", S),
            ("ingested_at", TS),
        ).fields,
        _DAY,
        _BATCH,
    ]
)


def dimension(id_name: str, name: str) -> T.StructType:
    return T.StructType([*_fields((id_name, L), (name, S)).fields, _BATCH])
