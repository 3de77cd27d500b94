"""Weekly answers of the served trips from counts kept beside them.

The serving job counts each of its batches per origin cell, region and week. A region's answer is
made of these counts alone. A box's is made of the counts of cells wholly inside it and of the
trips in cells on its border, which the store, being in geohash order, gives without a scan. Both
sides are of the same batches: those that the counts have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.functions.cover import Box, any_range, cover
from tripweave.functions.points import within_box
from tripweave.operators.clusters import PRECISION
from tripweave.operators.weekly import (
    average_of_weeks,
    averages_by_region,
    cell_weeks,
    weekly_counts,
)
from tripweave.sources.lake import Lake
from tripweave.streaming.rollup import RollUp

#: Cells of about 5 km: few enough to count, small enough for a box of a town.
CELL_PRECISION = 5

CELL_COUNTS = RollUp(
    "cell_weeks",
    ("cell", "region", "week_start"),
    lambda trips: cell_weeks(trips, CELL_PRECISION, per=("batch_id",)),
    source="serving",
)


def border_trips(spark: SparkSession, lake: Lake, box: Box) -> DataFrame:
    """The counted trips in cells on the box's border that are inside the box."""
    newest = CELL_COUNTS.state(spark, lake).newest
    ranges = [r for r in cover(box, CELL_PRECISION) if not r.inside]
    # A cell's text is the beginning of the texts of all finer cells in it.
    longer = PRECISION - CELL_PRECISION
    fine = [
        F.col("origin_geohash").between(r.first + "0" * longer, r.last + "z" * longer)
        for r in ranges
    ]
    near = F.lit(False)
    for one in fine:
        near = near | one
    rows = lake.read(spark, "serving", before=newest + 1).where(near)
    return rows.where(within_box(F.col("origin_lon"), F.col("origin_lat"), *box))


def box_weeks(spark: SparkSession, lake: Lake, box: Box) -> DataFrame:
    """Trips per week inside a box, its sides excluded: ``week_start, trips``."""
    inside = any_range([r for r in cover(box, CELL_PRECISION) if r.inside], F.col("cell"))
    counted = CELL_COUNTS.read(spark, lake).where(inside).select(
        "week_start", F.col("trip_count").alias("trips")
    )
    raw = weekly_counts(border_trips(spark, lake, box)).select("week_start", "trips")
    return counted.unionByName(raw).groupBy("week_start").agg(F.sum("trips").alias("trips"))


def region_weeks(spark: SparkSession, lake: Lake) -> DataFrame:
    """Trips per region and week: ``region, week_start, trips``."""
    counted = CELL_COUNTS.read(spark, lake)
    return counted.groupBy("region", "week_start").agg(F.sum("trip_count").alias("trips"))


def box_average(spark: SparkSession, lake: Lake, box: Box) -> DataFrame:
    return average_of_weeks(box_weeks(spark, lake, box))


def region_average(spark: SparkSession, lake: Lake, region: str) -> DataFrame:
    return average_of_weeks(region_weeks(spark, lake).where(F.col("region") == region))


def region_averages(spark: SparkSession, lake: Lake) -> DataFrame:
    return averages_by_region(region_weeks(spark, lake))
