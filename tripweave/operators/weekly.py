"""Weekly counts and averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.cells import cell_number, cell_text
from tripweave.functions.cover import MOST_RANGES, within_box_by_cells
from tripweave.functions.points import within_box
from tripweave.functions.times import iso_week, iso_year, week_start
from tripweave.operators.clusters import PRECISION, instant_of

Box = tuple[float, float, float, float]


def weekly_metrics(trips: DataFrame, by_year: bool = False) -> DataFrame:
    """Trips per region and ISO week number. Weeks of different years share a number;
    ``by_year`` keeps them apart."""
    instant = instant_of(trips)
    keys = {"iso_week": iso_week(instant)}
    if by_year:
        keys = {"iso_year": iso_year(instant), **keys}
    return (
        trips.select("region", *(expr.alias(name) for name, expr in keys.items()))
        .groupBy("region", *keys)
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .withColumn("avg_trips_per_day", F.col("trip_count") / F.lit(7.0))
    )


def weekly_deltas(trips: DataFrame, per: tuple[str, ...]) -> DataFrame:
    """Trips per region and ISO week of each part of a table, for example of each batch."""
    return (
        trips.select(*per, "region", iso_week(instant_of(trips)).alias("iso_week"))
        .groupBy(*per, "region", "iso_week")
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )


def merged_weeks(deltas: DataFrame) -> DataFrame:
    """Weekly metrics from counts per part: the counts of a region and week add up."""
    return (
        deltas.groupBy("region", "iso_week")
        .agg(F.sum("trip_count").alias("trip_count"))
        .withColumn("avg_trips_per_day", F.col("trip_count") / F.lit(7.0))
    )


def weekly_counts(trips: DataFrame, *keys: str) -> DataFrame:
    return (
        trips.select(*keys, week_start(instant_of(trips)).alias("week_start"))
        .groupBy(*keys, "week_start")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def in_region(trips: DataFrame, region: str) -> DataFrame:
    return trips.where(F.col("region") == region)


def in_box(trips: DataFrame, box: Box) -> DataFrame:
    """Trips whose origin lies strictly inside (west, south, east, north)."""
    return trips.where(within_box(F.col("origin_lon"), F.col("origin_lat"), *box))


def in_box_by_cells(
    trips: DataFrame,
    box: Box,
    cell: str = "origin_geohash",
    precision: int = PRECISION,
    most: int = MOST_RANGES,
) -> DataFrame:
    """The same trips, of a table that holds each origin's cell: only border cells' coordinates
    are compared, and a table in geohash order is read in a few ranges."""
    lon, lat = F.col("origin_lon"), F.col("origin_lat")
    return trips.where(within_box_by_cells(F.col(cell), lon, lat, box, precision, most))


def cell_weeks(trips: DataFrame, precision: int, per: tuple[str, ...]) -> DataFrame:
    """Trips per origin cell, region and week of each part of a table."""
    number = cell_number(F.col("origin_lon"), F.col("origin_lat"), precision)
    counted = (
        trips.select(
            *per, number.alias("number"), "region", week_start(instant_of(trips)).alias("week_start")
        )
        .groupBy(*per, "number", "region", "week_start")
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )
    return counted.withColumn("cell", cell_text(F.col("number"), precision)).drop("number")


def average_of_weeks(weeks: DataFrame, count: str = "trips") -> DataFrame:
    """One row: mean trips per week over the weeks that have trips, weeks, total trips."""
    return weeks.agg(
        F.coalesce(F.avg(count), F.lit(0.0)).alias("weekly_average"),
        F.count(F.lit(1)).alias("num_weeks"),
        F.coalesce(F.sum(count), F.lit(0)).alias("total_trips"),
    )


def averages_by_region(weeks: DataFrame, count: str = "trips") -> DataFrame:
    """Every region's average of its weeks, rounded half up to two decimals on exact numbers."""
    total = F.sum(count)
    exact = total.cast("decimal(20,0)") / F.count(F.lit(1)).cast("decimal(10,0)")
    return (
        weeks.groupBy("region")
        .agg(
            F.round(exact, 2).alias("weekly_average"),
            F.count(F.lit(1)).alias("num_weeks"),
            total.alias("total_trips"),
        )
        .orderBy("region")
    )


def select_area(
    trips: DataFrame, region: str | None, box: tuple[float | None, ...] | None
) -> tuple[DataFrame, dict]:
    """The trips asked for and the filter in use. A region takes precedence over a box."""
    if region is not None:
        return in_region(trips, region), {"region": region}
    if box is None or len(box) != 4 or any(side is None for side in box):
        raise ValueError(
            "give a region or all four box coordinates: min_lon, min_lat, max_lon, max_lat"
        )
    names = ("min_lon", "min_lat", "max_lon", "max_lat")
    return in_box(trips, box), {"bounding_box": dict(zip(names, map(float, box)))}


def weekly_average(
    trips: DataFrame, region: str | None = None, box: tuple[float | None, ...] | None = None
) -> DataFrame:
    """One row: mean trips per week over the weeks that have trips, weeks, total trips."""
    chosen, _ = select_area(trips, region, box)
    return average_of_weeks(weekly_counts(chosen))


def weekly_average_answer(
    trips: DataFrame, region: str | None = None, box: tuple[float | None, ...] | None = None
) -> DataFrame:
    """The same row with the filter echoed, and the whole as JSON without NULL fields."""
    _, used = select_area(trips, region, box)
    if "region" in used:
        echo = F.struct(F.lit(region).alias("region"))
    else:
        sides = used["bounding_box"].items()
        echo = F.struct(F.struct(*(F.lit(v).alias(k) for k, v in sides)).alias("bounding_box"))
    answer = weekly_average(trips, region, box).withColumn("filter", echo)
    return answer.withColumn("answer", F.to_json(F.struct(*answer.columns)))


def weekly_average_by_region(trips: DataFrame) -> DataFrame:
    """Every region's average, rounded half up to two decimals on exact numbers."""
    return averages_by_region(weekly_counts(trips, "region"))
