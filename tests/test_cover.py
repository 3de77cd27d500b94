"""Boxes by ranges of cells: same rows as plain bounds, and fewer rows read."""

import random

from tripweave.functions.cover import cover, range_text
from tripweave.operators import weekly
from tripweave.operators.clusters import add_geohashes

GRID = 360 / 2**18


def boxes(rng):
    yield from [
        (-180, -90, 180, 90), (-181, -91, 181, 91), (0, 0, 0, 0), (179.99, 89.99, 180, 90),
        (14.6, 50.2, 14.0, 49.9), (-GRID, -GRID, GRID, GRID), (5 * GRID, 0, 9 * GRID, 45),
    ]
    for _ in range(12):
        lon, lat = rng.uniform(-180, 180), rng.uniform(-90, 90)
        wide = 10 ** rng.uniform(-4, 2)
        yield (lon, lat, lon + wide, lat + wide * rng.random())


def points(rng):
    out = [(x, y) for x in (-180.0, 180.0, 0.0, GRID, 5 * GRID, 9 * GRID) for y in (-90.0, 90.0, 0.0, GRID)]
    for box in boxes(random.Random(1)):
        for _ in range(30):
            x = rng.choice([box[0], box[2], rng.uniform(box[0], box[2])])
            y = rng.choice([box[1], box[3], rng.uniform(box[1], box[3])])
            out.append((min(max(x, -180.0), 180.0), min(max(y, -90.0), 90.0)))
    return [(float(x), float(y)) for x, y in out] + [(None, 1.0), (1.0, None), (float("nan"), 1.0)]


def test_rows_are_those_of_plain_bounds(spark):
    df = spark.createDataFrame(points(random.Random(2)), "origin_lon double, origin_lat double")
    df = add_geohashes(df.selectExpr("*", "origin_lon as destination_lon", "origin_lat as destination_lat")).cache()
    for box in boxes(random.Random(1)):
        for most in (1, 8, 48):
            got = weekly.in_box_by_cells(df, box, most=most).count()
            assert got == weekly.in_box(df, box).count(), (box, most)


def test_ranges_are_few_sorted_and_apart():
    for box in boxes(random.Random(3)):
        ranges = cover(box, 7)
        assert 1 <= len(ranges) <= 48
        flat = [text for r in ranges for text in (r.first, r.last)]
        assert flat == sorted(flat) and all(len(t) == 7 for t in flat)
    assert range_text(0, 3) == "000" and range_text(2**15 - 1, 3) == "zzz"
    assert [(r.first, r.last) for r in cover((-180, -90, 180, 90), 1, most=1)] == [("0", "z")]


def test_fewer_rows_are_read_than_with_plain_bounds(spark, tmp_path):
    rng = random.Random(7)
    spread = spark.createDataFrame(
        [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(40_000)], "origin_lon double, origin_lat double"
    )
    rows = add_geohashes(spread.selectExpr("*", "0d as destination_lon", "0d as destination_lat"))
    path = str(tmp_path / "sorted")
    (
        rows.coalesce(1).sortWithinPartitions("origin_geohash")
        .write.option("parquet.block.size", 16_384).option("parquet.page.size", 4_096)
        .option("parquet.block.size.row.check.min", 100).option("parquet.page.size.row.check.min", 100)
        .parquet(path)
    )
    stored = spark.read.schema(rows.schema).parquet(path)

    def scanned(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        while plan.children().size():
            plan = plan.children().head()
        return plan.metrics().apply("numOutputRows").value()

    # A box around the meeting point of large cells: row groups next to it span far.
    box = (-2.0, -2.0, 2.0, 2.0)
    by_cells, plain = weekly.in_box_by_cells(stored, box), weekly.in_box(stored, box)
    assert by_cells.count() == plain.count() > 0
    assert scanned(by_cells) < scanned(plain) < 40_000
