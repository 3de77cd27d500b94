"""Decode log events and send each to exactly one of: trip, rejected, marker, unknown."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.once import with_computed
from tripweave.functions.points import in_lat_range, in_lon_range
from tripweave.functions.times import parse_instant
from tripweave.operators.dedup import first_wins, known_keys
from tripweave.operators.uploads import any_of, trip_id_of
from tripweave.schemas import PAYLOAD, SILVER_COLUMNS
from tripweave.sources.tables import partition_values

#: Ids not made from the trip's own fields are stored by a part of their digest: partitions
#: "other-00" to "other-ff".
FOREIGN = "other-"
StoredTrips = Callable[[list[str] | None], DataFrame]
#: Foreign ids that a table is asked for by name. Scans then skip the row groups whose Bloom
#: filters do not know them; with more ids nearly every row group would be read in any case.
MOST_NAMED = 500
#: Ids of one condition; longer lists would reach the scan as a range only.
NAMED_AT_ONCE = 10


def decode(events: DataFrame) -> DataFrame:
    """JSON value to flat columns, with the raw text and the log's timestamp kept.

    ``inline`` makes the parsed record the output of a generator: filters on its fields
    stay above it, so each value is parsed once however many fields are looked at.
    """
    value = F.col("value").cast("string")
    return events.select(
        F.inline(F.array(F.from_json(value, PAYLOAD))),
        value.alias("raw_payload"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
    )


def reject_reason() -> Column:
    """Why a trip-like row is not a trip; NULL for a valid one. Ranges include both ends."""
    lons = [F.col("origin_lon"), F.col("destination_lon")]
    lats = [F.col("origin_lat"), F.col("destination_lat")]
    outside = any_of(
        F.coalesce(~inside, F.lit(False))
        for inside in [*map(in_lon_range, lons), *map(in_lat_range, lats)]
    )
    nothing_read = F.coalesce(*(F.col(name).cast("string") for name in PAYLOAD.names)).isNull()
    return (
        F.when(nothing_read, "malformed_payload")
        .when(outside, "coordinate_out_of_range")
        .when(any_of(c.isNull() for c in lons + lats), "null_coordinate")
        .when(F.col("trip_id").isNull(), "null_trip_id")
        .when(F.col("instant").isNull(), "bad_datetime")
        .when(F.col("region").isNull() | F.col("datasource").isNull(), "missing_field")
    )


def route(flat: DataFrame) -> DataFrame:
    """Add ``route``, for rejected rows ``reject_reason``, and the parsed ``instant``."""
    kind = F.col("record_type")
    trip_like = kind.isNull() | (kind == "trip")
    timed = with_computed(flat, {"instant": parse_instant(F.col("datetime"))})
    return timed.withColumn("reject_reason", F.when(trip_like, reject_reason())).withColumn(
        "route",
        F.when(kind == "ingestion_end", "marker")
        .when(~trip_like, "unknown")
        .when(F.col("reject_reason").isNull(), "trip")
        .otherwise("rejected"),
    )


def trips(routed: DataFrame) -> DataFrame:
    return routed.where("route = 'trip'").select(*SILVER_COLUMNS)


def markers(routed: DataFrame) -> DataFrame:
    return routed.where("route = 'marker'").select(
        "ingestion_id", "control_id", "total_rows", "kafka_timestamp"
    )


def rejected(routed: DataFrame) -> DataFrame:
    return routed.where("route = 'rejected'").select(
        *PAYLOAD.names, "raw_payload", "kafka_timestamp", "reject_reason"
    )


def with_trip_day(routed: DataFrame) -> DataFrame:
    """The day a trip is stored under; NULL for rows that are no trips.

    An id made from the trip's own fields covers its instant, so two trips with that id
    share the day, and a look-up for the id needs that day's partitions, and the one that
    a foreign row of the same id would be in. Ids made by any other rule go there.
    """
    own_id = F.col("trip_id").eqNullSafe(trip_id_of("instant"))
    day = F.when(own_id, F.to_date("instant").cast("string")).otherwise(foreign_part())
    return routed.withColumn("trip_day", F.when(F.col("route") == "trip", day))


def foreign_part() -> Column:
    """The partition of a trip whose id was made by another rule."""
    return F.concat(F.lit(FOREIGN), F.substring(F.md5("trip_id"), 1, 2))


def days_of(trips: DataFrame) -> list[str]:
    """The partitions of a table of days that can hold an id of these own-id trips."""
    return partition_values(trips, F.array("trip_day", foreign_part()))


def rows_of_ids(ids: DataFrame, stored: StoredTrips) -> DataFrame:
    """All stored rows that can have one of these ids, and perhaps others."""
    rows = stored(None)
    few = [r.trip_id for r in ids.select("trip_id").distinct().limit(MOST_NAMED + 1).collect()]
    if len(few) > MOST_NAMED:
        return rows
    groups = (few[i : i + NAMED_AT_ONCE] for i in range(0, len(few), NAMED_AT_ONCE))
    return rows.where(any_of(F.col("trip_id").isin(group) for group in groups))


def known_trips(trips: DataFrame, stored: StoredTrips) -> DataFrame:
    """The stored ids that the trips have too. ``stored`` gives a table's rows of some days,
    or of all for None.

    Trips with an id of their own look into their partitions. The others, if there are any,
    look everywhere, since an id of that kind says nothing of where it could be; they alone
    do, by name as long as they are few.
    """
    foreign = F.col("trip_day").startswith(FOREIGN)
    own, others = trips.where(~foreign), trips.where(foreign)
    known = known_keys(own, stored(days_of(own)))
    if others.isEmpty():
        return known
    return known.unionByName(known_keys(others, rows_of_ids(others, stored))).distinct()


def stored_of(trips: DataFrame, stored: StoredTrips) -> DataFrame:
    """The ``trip_id, ingestion_id`` of stored rows that the trips have too. Each kind of id is
    looked for where it can be, as in ``known_trips``."""
    foreign = F.col("trip_day").startswith(FOREIGN)
    own, others = trips.where(~foreign), trips.where(foreign)
    columns = ["trip_id", "ingestion_id"]

    def rows_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
        return rows.select(*columns).join(keys.select("trip_id").distinct(), "trip_id", "left_semi")

    found = rows_in(stored(days_of(own)), own)
    if others.isEmpty():
        return found
    return found.unionByName(rows_in(rows_of_ids(others, stored), others)).distinct()


def insert_by_day(trips: DataFrame, stored: StoredTrips) -> DataFrame:
    """What an insert-only merge adds to a table stored by ``trip_day``."""
    return first_wins(trips).join(known_trips(trips, stored), "trip_id", "left_anti")


def contract_rules() -> dict[str, Column]:
    """Contract rules, each as whether a routed row breaks it."""
    like_trip = F.col("route").isin("trip", "rejected")
    is_marker = F.col("route") == "marker"
    return {
        "trip_row_number_from_1": like_trip & ~F.coalesce(F.col("row_number") >= 1, F.lit(False)),
        "trip_required_fields": like_trip
        & any_of(
            F.col(name).isNull()
            for name in PAYLOAD.names
            if name not in ("record_type", "control_id", "total_rows")
        ),
        "marker_total_rows_from_0": is_marker
        & ~F.coalesce(F.col("total_rows") >= 0, F.lit(False)),
        "marker_required_fields": is_marker
        & (F.col("ingestion_id").isNull() | F.col("control_id").isNull()),
        "known_record_type": F.col("route") == "unknown",
    }


def expectations(routed: DataFrame) -> DataFrame:
    """Contract rules with the number of rows that break each, in one pass."""
    rules = contract_rules()
    counted = routed.agg(*(F.count_if(broken).alias(name) for name, broken in rules.items()))
    pairs = F.array(
        *(F.struct(F.lit(name).alias("rule"), F.col(name).alias("broken")) for name in rules)
    )
    return counted.select(F.inline(pairs))


ROUTES = ("trip", "rejected", "marker", "unknown")


def counts_of(routed: DataFrame) -> dict[str, int]:
    """Routed rows by route and by broken rule, in one aggregate."""
    counts = [F.count_if(F.col("route") == name).alias(name) for name in ROUTES]
    broken = [F.count_if(rule).alias(name) for name, rule in contract_rules().items()]
    return routed.agg(*counts, *broken).first().asDict()
