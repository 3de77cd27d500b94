"""Column functions against goldens and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tripweave.functions import cells, identity, points, times


def bisected(lon, lat, precision):
    """Textbook geohash: halve the axes in turn, longitude first."""
    spans = [[-180.0, 180.0], [-90.0, 90.0]]
    out, value = "", 0
    for bit in range(precision * 5):
        span, x = spans[bit % 2], (lon, lat)[bit % 2]
        middle = (span[0] + span[1]) / 2
        upper = x >= middle
        span[0 if upper else 1] = middle
        value = value * 2 + upper
        if bit % 5 == 4:
            out, value = out + cells.ALPHABET[value], 0
    return out


def test_geohash_equals_bisection(spark):
    rng = random.Random(7)
    pairs = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(400)]
    pairs += [(0.0, 0.0), (-0.1, 51.5), (2.35, 48.86), (-180.0, -90.0), (180.0, 90.0)]
    df = spark.createDataFrame(pairs, "lon double, lat double")
    lon, lat = F.col("lon"), F.col("lat")
    hashed = df.select(
        "lon", "lat", *(cells.geohash(lon, lat, p).alias(f"p{p}") for p in range(1, 13))
    )
    for row in hashed.collect():
        for p in range(1, 13):
            assert row[f"p{p}"] == bisected(row.lon, row.lat, p)


@pytest.mark.parametrize(
    "lon, lat, expected", [(0.0, 0.0, "s"), (-0.1, 51.5, "g"), (2.35, 48.86, "u")]
)
def test_geohash_known_first_symbols(spark, lon, lat, expected):
    df = spark.range(1).select(cells.geohash(F.lit(lon), F.lit(lat), 1).alias("cell"))
    assert df.first().cell == expected


def test_geohash_clamps_and_leaves_unknown_positions_null(spark):
    df = spark.createDataFrame(
        [(None, 1.0), (1.0, None), (float("nan"), 1.0), (500.0, 100.0), (float("inf"), 90.0)],
        "lon double, lat double",
    )
    got = [r.c for r in df.select(cells.geohash(F.col("lon"), F.col("lat")).alias("c")).collect()]
    assert got[:3] == [None, None, None]
    assert got[3] == got[4] == "zzzzzzz"


def test_geohash_refuses_other_precisions():
    for precision in (0, 13):
        with pytest.raises(ValueError):
            cells.geohash(F.lit(0.0), F.lit(0.0), precision)


def test_six_decimals_rounds_like_the_exact_value(spark):
    rng = random.Random(3)
    values = [rng.uniform(-180, 180) for _ in range(500)]
    # Texts with a 5 in the seventh place: never a tie in binary, often the wrong way round.
    values += [float(f"{rng.uniform(-180, 180):.6f}5") for _ in range(1500)]
    # Exact ties.
    values += [k / 2**21 for k in range(-9, 10)] + [0.0, -0.0, -1e-9, 14.1234565, 200.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", identity.six_decimals(F.col("x")).alias("t")).collect():
        assert row.t == f"{row.x:.6f}"


def trip_id_of(spark, **changes):
    fields = {
        "region": "Prague",
        "origin_lon": 14.4973794,
        "origin_lat": 50.0013687,
        "destination_lon": 14.4310948,
        "destination_lat": 50.0405293,
        "instant": "2018-05-28T09:03:40Z",
        "datasource": "funny_car",
    } | changes
    kinds = {name: "double" if "_l" in name else "string" for name in fields}
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    df = spark.createDataFrame([tuple(fields.values())], schema)
    columns = {name: F.col(name) for name in fields}
    columns["instant"] = times.parse_instant(F.col("instant"))
    return df.select(identity.trip_id(*columns.values()).alias("id")).first().id


def test_trip_id_golden_and_invariances(spark):
    known = "4363cf6f286841a4fc24dfc59aea7b25f57c60225d2b7cd70aefc2e48e713518"
    assert trip_id_of(spark) == known
    assert trip_id_of(spark, region="  pRAGUE\t", datasource="FUNNY_CAR\n") == known
    assert trip_id_of(spark, instant="2018-05-28 11:03:40+0200") == known
    assert trip_id_of(spark, origin_lon=14.4973794 + 1e-9) == known
    assert trip_id_of(spark, origin_lat=50.1013687) != known
    assert trip_id_of(spark, datasource=None) is None


INSTANTS = {
    "2018-05-28 09:03:40": "2018-05-28T09:03:40Z",
    "2018-05-28T09:03:40Z": "2018-05-28T09:03:40Z",
    "2018-05-28T09:03:40+02:00": "2018-05-28T07:03:40Z",
    "2018-05-28T09:03-0530": "2018-05-28T14:33:00Z",
    "2018-05-28T09+02": "2018-05-28T07:00:00Z",
    "2018-05-28T09:03:40,5": "2018-05-28T09:03:40.500000Z",
    "2018-05-28T09:03:40.123456789": "2018-05-28T09:03:40.123456Z",
    "2018-05": "2018-05-01T00:00:00Z",
    "1969-12-31T23:59:59.9": "1969-12-31T23:59:59.900000Z",
    "2018-13-01": None,
    "2018-05-28T25:00": None,
    "12:34": None,
    "2018-05-28T09:03:40 Europe/Paris": None,
    "soon": None,
    None: None,
}


def test_instants_are_normalised_to_utc(spark):
    df = spark.createDataFrame([(t,) for t in INSTANTS], "t string")
    parsed = df.select("t", times.instant_text(times.parse_instant(F.col("t"))).alias("utc"))
    assert {r.t: r.utc for r in parsed.collect()} == INSTANTS


def test_buckets_floor_on_both_sides_of_the_epoch(spark):
    zone = dt.timezone.utc
    moments = [
        dt.datetime(2018, 5, 28, 9, 3, 40, tzinfo=zone),
        dt.datetime(2018, 5, 28, 9, 30, tzinfo=zone),
        dt.datetime(1969, 12, 31, 23, 59, 59, 900000, tzinfo=zone),
        dt.datetime(2300, 1, 1, 0, 29, 59, 999999, tzinfo=zone),
    ]
    df = spark.createDataFrame([(m,) for m in moments], "ts timestamp")
    ts = F.col("ts")
    rows = df.select(
        times.time_bucket(ts).cast("string").alias("a"),
        times.bucket_start(times.bucket_number(ts)).cast("string").alias("b"),
    ).collect()
    assert [r.a for r in rows] == [
        "2018-05-28 09:00:00",
        "2018-05-28 09:30:00",
        "1969-12-31 23:30:00",
        "2300-01-01 00:00:00",
    ]
    assert all(r.a == r.b for r in rows)


def test_points(spark):
    cases = {
        "POINT (14.5 50)": (14.5, 50.0),
        "POINT(14.4973 50.0755)": (14.4973, 50.0755),
        "  point ( 1e1 -2.5 ) ": (10.0, -2.5),
        "POINT (1 2 3)": (None, None),
        "POINT (1.0d 2)": (None, None),
        "POINT (nan 2)": (None, None),
        "POINT 1 2": (None, None),
        "LINE (1 2)": (None, None),
        "": (None, None),
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    t = F.col("t")
    rows = df.select("t", points.point_lon(t).alias("x"), points.point_lat(t).alias("y"))
    assert {r.t: (r.x, r.y) for r in rows.collect()} == cases


def test_box_excludes_its_sides_and_takes_any_corner_order(spark):
    spots = [(1.0, 1.0), (0.0, 1.0), (2.0, 1.0), (1.0, 0.0), (1.0, 2.0), (1.999, 0.001)]
    df = spark.createDataFrame(spots, "lon double, lat double")
    for box in ((0, 0, 2, 2), (2, 2, 0, 0)):
        inside = df.where(points.within_box(F.col("lon"), F.col("lat"), *box)).collect()
        assert {tuple(r) for r in inside} == {(1.0, 1.0), (1.999, 0.001)}
