"""Clusters, weekly answers, regions, lookups and completion on small hand-made tables."""

import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripweave.operators import clusters, completion, dimensions, regions, weekly
from tripweave.operators.clusters import cluster_counts
from tripweave.sources.lake import TABLES
from tripweave.sources.tables import read_table

SCHEMA = (
    "trip_id string, region string, origin_lon double, origin_lat double, "
    "destination_lon double, destination_lat double, datetime string, datasource string"
)

TRIPS = [
    ("a", "Prague", 14.40, 50.05, 14.50, 50.10, "2018-05-28T09:03:40Z", "s1"),
    ("b", "Prague", 14.40, 50.05, 14.50, 50.10, "2018-05-28T09:29:59Z", "s2"),
    ("c", "Prague", 14.40, 50.05, 14.50, 50.10, "2018-05-28T09:30:00Z", "s1"),
    ("d", "Prague", 14.00, 50.05, 14.50, 50.10, "2018-06-11T00:00:00Z", "s3"),
    ("e", "Turin", 7.60, 45.00, 7.70, 45.10, "2018-06-11T00:00:00Z", "s1"),
    ("f", "Turin", 7.60, 45.00, 7.70, 45.10, "2019-05-27T00:00:00Z", "s2"),
    ("g", "Hamburg", 10.00, 53.50, 10.10, 53.60, "2018-05-27T23:59:59Z", "s3"),
]


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(TRIPS, SCHEMA)


def test_clusters_group_by_cells_and_half_hour(trips):
    rows = cluster_counts(trips).collect()
    assert sorted(r.trip_count for r in rows) == [1, 1, 1, 1, 1, 2]
    pair = max(rows, key=lambda r: r.trip_count)
    assert pair.time_bucket == dt.datetime(2018, 5, 28, 9, 0) and pair.iso_week == 22
    assert len(pair.origin_cell) == len(pair.destination_cell) == 7


def test_cluster_aggregation_shuffles_longs_once(trips, plan_of):
    plan = plan_of(cluster_counts(trips))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan and "SortAggregate" not in plan
    assert "hashpartitioning(origin_number" in plan


def test_week_metrics_merge_years_unless_asked(trips):
    plain = {(r.region, r.iso_week): r.trip_count for r in weekly.weekly_metrics(trips).collect()}
    assert plain[("Prague", 22)] == 3 and plain[("Turin", 22)] == 1 and plain[("Hamburg", 21)] == 1
    yearly = weekly.weekly_metrics(trips, by_year=True).collect()
    assert {(r.iso_year, r.iso_week) for r in yearly if r.region == "Turin"} == {(2018, 24), (2019, 22)}


def test_weekly_average_divides_by_weeks_with_trips(trips):
    row = weekly.weekly_average(trips, region="Prague").first()
    assert tuple(row) == (2.0, 2, 4)
    assert tuple(weekly.weekly_average(trips, region="prague").first()) == (0.0, 0, 0)
    # A point on the western side does not count.
    assert tuple(weekly.weekly_average(trips, box=(14.0, 50.0, 14.6, 50.2)).first()) == (3.0, 1, 3)


def test_weekly_average_arguments(trips):
    for arguments in ({}, {"box": (1.0, None, 2.0, 3.0)}, {"box": (1.0, 2.0)}):
        with pytest.raises(ValueError):
            weekly.weekly_average(trips, **arguments)
    both = weekly.weekly_average_answer(trips, region="Prague", box=(0, 0, 1, 1)).first()
    assert json.loads(both.answer)["filter"] == {"region": "Prague"}
    boxed = weekly.weekly_average_answer(trips, box=(14, 50, 15, 51)).first()
    assert json.loads(boxed.answer)["filter"] == {
        "bounding_box": {"min_lon": 14.0, "min_lat": 50.0, "max_lon": 15.0, "max_lat": 51.0}
    }


def test_average_of_all_regions_rounds_half_up(spark):
    """Eight weeks, 1 trip each but one week with 2: 1.125 rounds to 1.13."""
    start = dt.date(2018, 1, 1)
    days = [start + dt.timedelta(weeks=w) for w in range(8)] + [start]
    rows = [(str(i), "R", 0.0, 0.0, 0.0, 0.0, str(day), "s") for i, day in enumerate(days)]
    row = weekly.weekly_average_by_region(spark.createDataFrame(rows, SCHEMA)).first()
    assert (str(row.weekly_average), row.num_weeks, row.total_trips) == ("1.13", 8, 9)


def test_area_filters_reach_the_scan(spark, trips, plan_of, tmp_path):
    path = str(tmp_path / "serving")
    trips.withColumn("datetime", F.col("datetime").cast("timestamp")).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(weekly.weekly_average(stored, box=(14.0, 50.0, 14.6, 50.2)))
    scan = plan[plan.index("PushedFilters") :]
    for pushed in ("GreaterThan(origin_lon,14.0)", "LessThan(origin_lat,50.2)"):
        assert pushed in scan
    assert "ReadSchema: struct<origin_lon:double,origin_lat:double,datetime:timestamp>" in scan


def test_latest_source_of_busiest_regions(trips, plan_of):
    latest = regions.latest_source(trips)
    got = {r.region: (r.datasource, r.datetime) for r in latest.collect()}
    assert got == {
        "Prague": ("s3", "2018-06-11T00:00:00Z"),
        "Turin": ("s2", "2019-05-27T00:00:00Z"),
    }
    plan = plan_of(latest)
    assert "WindowGroupLimit [region" in plan and "Partial" in plan


def test_regions_of_source(trips):
    assert [r.region for r in regions.regions_of_source(trips, "s1").collect()] == ["Prague", "Turin"]


def test_latest_clusters_take_the_newest_snapshot(spark):
    bucket = dt.datetime(2018, 5, 28, 9, 0)
    rows = [("x", "y", bucket, 1, 22, 0), ("x", "y", bucket, 3, 22, 4), ("x", "z", bucket, 2, 22, 1)]
    snapshots = spark.createDataFrame(rows, TABLES["cluster_snapshots"][0])
    got = {r.destination_cell: r.trip_count for r in clusters.latest_clusters(snapshots).collect()}
    assert got == {"y": 3, "z": 2}


def test_lookup_ids_are_dense_stable_and_extended(spark):
    names = [(f"name {i}",) for i in range(500)]
    df = spark.createDataFrame(names, "region string").repartition(7)
    first = dimensions.number_names(df, "region", "region_id")
    ids = {r.region: r.region_id for r in first.collect()}
    assert sorted(ids.values()) == list(range(1, 501))
    more = spark.createDataFrame([("name 3",), ("new",), ("new",), (None,)], "region string")
    added = dimensions.extend_dimension(more, "region", "region_id", first).collect()
    assert [tuple(r) for r in added] == [(501, "new")]


def test_serving_rows_have_points_and_cells(trips):
    rows = dimensions.serving_rows(trips.withColumn("ingestion_id", F.lit("i")))
    row = rows.where("trip_id = 'a'").first()
    assert row.origin_geom == "POINT (14.4 50.05)"
    assert row.datetime == dt.datetime(2018, 5, 28, 9, 3, 40)
    assert len(row.origin_geohash) == 7


def test_a_file_without_a_later_column_reads_as_null(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.createDataFrame([("t", "Prague")], "trip_id string, region string").write.parquet(path)
    row = read_table(spark, path, TABLES["serving"][0]).first()
    assert row.trip_id == "t" and row.ingestion_id is None


def test_completion_counts_each_sent_row_once(spark):
    """'late' has every row but one, and one of them delivered three times."""
    sent = [("ok", n, f"t{n}", "trip") for n in range(1, 4)]
    sent += [("again", n, f"t{n}", "trip") for n in range(1, 4)]
    sent += [("late", 1, "x1", "trip")] * 3 + [("late", 2, None, "rejected")]
    routed = spark.createDataFrame(sent, "ingestion_id string, row_number int, trip_id string, route string")
    stored = spark.createDataFrame(
        [("t1", "ok"), ("t2", "ok"), ("t3", "ok"), ("x1", "late")], "trip_id string, ingestion_id string"
    )
    announced = spark.createDataFrame(
        [("ok", 3), ("again", 3), ("late", 3), ("empty", 0), ("silent", 1)], "ingestion_id string, total_rows int"
    )
    report = completion.completion_report(announced, routed, stored).collect()
    assert {r.ingestion_id: tuple(r)[2:] for r in report} == {
        "ok": (3, 0, 0, True),
        "again": (0, 3, 0, True),
        "late": (1, 0, 1, False),
        "empty": (0, 0, 0, True),
        "silent": (0, 0, 0, False),
    }


def test_completion_counts_rejected_rows_without_number_and_id(spark):
    sent = [("i", 1, "t1", "trip", "a"), ("i", None, None, "rejected", "b"), ("i", None, None, "rejected", "c")]
    sent += [("i", None, None, "rejected", "c"), ("j", None, None, "rejected", "b")]
    kinds = "ingestion_id string, row_number int, trip_id string, route string, raw_payload string"
    stored = spark.createDataFrame([("t1", "i")], "trip_id string, ingestion_id string")
    announced = spark.createDataFrame([("i", 3), ("j", 2)], "ingestion_id string, total_rows int")
    report = completion.completion_report(announced, spark.createDataFrame(sent, kinds), stored).collect()
    assert {r.ingestion_id: tuple(r)[2:] for r in report} == {"i": (1, 0, 2, True), "j": (0, 0, 1, False)}


def test_trips_per_region(trips):
    got = {r.region: r.trips for r in regions.trips_per_region(trips).collect()}
    assert got == Counter(row[1] for row in TRIPS)
