"""Questions about regions and their sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trips_per_region(trips: DataFrame) -> DataFrame:
    return trips.groupBy("region").agg(F.count(F.lit(1)).alias("trips"))


def busiest_regions(trips: DataFrame, n: int = 2) -> DataFrame:
    return trips_per_region(trips).orderBy(F.desc("trips"), "region").limit(n)


def latest_source(trips: DataFrame, n: int = 2) -> DataFrame:
    """The latest trip's source in each of the ``n`` busiest regions.

    The broadcast side has exactly ``n`` rows. Ranking is cut to one row per region and
    task before the shuffle, so a region with most of the trips is no hot task.
    """
    latest_first = Window.partitionBy("region").orderBy(F.desc("datetime"), "trip_id")
    return (
        trips.select("region", "datasource", "datetime", "trip_id")
        .join(F.broadcast(busiest_regions(trips, n).select("region")), "region")
        .withColumn("_rank", F.row_number().over(latest_first))
        .where("_rank = 1")
        .select("region", "datasource", "datetime")
    )


def regions_of_source(trips: DataFrame, datasource: str) -> DataFrame:
    return (
        trips.where(F.col("datasource") == datasource)
        .select("region")
        .distinct()
        .orderBy("region")
    )


def stored_per_ingestion(trips: DataFrame) -> DataFrame:
    return trips.groupBy("ingestion_id").agg(F.count(F.lit(1)).alias("stored_rows"))
