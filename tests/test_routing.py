"""Every event lands in exactly one output."""

import json

from pyspark.sql import functions as F

from tripweave.operators import routing
from tripweave.schemas import SILVER_COLUMNS

TRIP = {
    "ingestion_id": "i",
    "row_number": 1,
    "trip_id": "t",
    "region": "Prague",
    "origin_lon": 14.0,
    "origin_lat": 50.0,
    "destination_lon": 14.1,
    "destination_lat": 50.1,
    "datetime": "2018-05-28T09:03:40Z",
    "datasource": "s",
}


def without(*names, **changes):
    return json.dumps({k: v for k, v in TRIP.items() if k not in names} | changes)


CASES = {
    "good": (json.dumps(TRIP), "trip", None),
    "record_type trip": (without(record_type="trip"), "trip", None),
    "edges": (without(origin_lon=-180, origin_lat=90), "trip", None),
    "missing coordinate": (without("origin_lon"), "rejected", "null_coordinate"),
    "text coordinate": (without(origin_lon="abc"), "rejected", "null_coordinate"),
    "missing and out of range": (
        without("origin_lon", origin_lat=91),
        "rejected",
        "coordinate_out_of_range",
    ),
    "out of range": (without(destination_lon=180.001), "rejected", "coordinate_out_of_range"),
    "nan": (json.dumps(TRIP).replace("14.0", "NaN"), "rejected", "coordinate_out_of_range"),
    "no id": (without("trip_id"), "rejected", "null_trip_id"),
    "bad datetime": (without(datetime="soon"), "rejected", "bad_datetime"),
    "no datetime": (without("datetime"), "rejected", "bad_datetime"),
    "no region": (without("region"), "rejected", "missing_field"),
    "malformed": ("{not json", "rejected", "malformed_payload"),
    "empty object": ("{}", "rejected", "malformed_payload"),
    "no value": (None, "rejected", "malformed_payload"),
    "other type": (json.dumps({"record_type": "foo"}), "unknown", None),
    "marker": (
        json.dumps({"record_type": "ingestion_end", "ingestion_id": "i", "control_id": "i:end", "total_rows": 3}),
        "marker",
        None,
    ),
}


def routed(spark):
    events = spark.createDataFrame(
        [(name, value) for name, (value, _, _) in CASES.items()], "key string, value string"
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    return routing.route(routing.decode(events))


def test_split_matrix(spark):
    got = routed(spark).groupBy("raw_payload", "route", "reject_reason").count().collect()
    expected = {(v, r, reason) for v, r, reason in CASES.values()}
    assert {(r.raw_payload, r.route, r.reject_reason) for r in got} == expected


def test_outputs_are_total_and_disjoint(spark):
    all_rows = routed(spark)
    parts = [routing.trips(all_rows), routing.markers(all_rows), routing.rejected(all_rows)]
    assert sum(p.count() for p in parts) + all_rows.where("route = 'unknown'").count() == len(CASES)
    assert routing.trips(all_rows).columns == SILVER_COLUMNS
    assert {"value", "timestamp"}.isdisjoint(parts[2].columns)


def test_each_value_is_parsed_once(spark, plan_of):
    plan = plan_of(routing.rejected(routed(spark)))
    assert plan.count("from_json") == 1


def test_expectations_count_broken_rules(spark):
    broken = {r.rule: r.broken for r in routing.expectations(routed(spark)).collect()}
    assert broken["known_record_type"] == 1
    assert broken["trip_row_number_from_1"] == 3
    assert broken["marker_total_rows_from_0"] == 0


def test_ids_made_elsewhere_are_looked_up_everywhere(spark):
    days = routing.with_trip_day(routed(spark)).where("route = 'trip'").select("trip_day").distinct()
    assert all(r.trip_day.startswith(routing.FOREIGN) for r in days.collect())
    part = routing.foreign_part()

    def days_in(table):
        return lambda days: table if days is None else table.where(F.col("trip_day").isin(days))

    stored = spark.createDataFrame(
        [("a", "2018-05-28"), ("b", None), ("c", "2018-06-01"), ("d", "2018-05-28")], "trip_id string, trip_day string"
    ).withColumn("trip_day", F.coalesce("trip_day", part))

    def known(*rows):
        trips = spark.createDataFrame(rows, "trip_id string, trip_day string")
        trips = trips.withColumn("trip_day", F.coalesce("trip_day", part))
        return sorted(r.trip_id for r in routing.known_trips(trips, days_in(stored)).collect())

    # Ids of their own look into their day and into the part a foreign copy would be in.
    assert known(("a", "2018-05-28"), ("b", "2018-05-28"), ("c", "2018-05-28")) == ["a", "b"]
    # A foreign id looks everywhere, and it alone does.
    assert known(("a", "2018-07-01"), ("c", None)) == ["c"]
    assert known(("c", "2018-05-28"), ("c", None)) == ["c"]


def test_one_foreign_id_leaves_the_other_look_ups_narrow(spark):
    asked = []

    def stored(days):
        asked.append(days)
        return spark.createDataFrame([("t3", "2018-05-03")], "trip_id string, trip_day string")

    trips = spark.createDataFrame([("t3", "2018-05-03"), ("x", "other-9d")], "trip_id string, trip_day string")
    assert [r.trip_id for r in routing.known_trips(trips, stored).collect()] == ["t3"]
    narrow, everywhere = asked
    assert everywhere is None
    assert len(narrow) == 2 and "2018-05-03" in narrow
