"""Name lookups with surrogate ids, and the serving row with its point geometries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.functions.points import point_text
from tripweave.operators.clusters import add_geohashes, instant_of
from tripweave.schemas import SERVING_COLUMNS

BUCKET_DIGITS = 3


def new_names(trips: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    names = trips.select(column).where(F.col(column).isNotNull()).distinct()
    return names if known is None else names.join(known.select(column), column, "left_anti")


def number_names(
    names: DataFrame, column: str, id_name: str, known: DataFrame | None = None
) -> DataFrame:
    """Consecutive ids for distinct names, after the largest of ``known`` if there is one; the
    same each time they are computed.

    Names are ranked inside 4,096 digest buckets and shifted by the sizes of the buckets
    before; only that table of at most 4,097 sizes, in which the ids in use come first, goes
    through one task.
    """
    bucketed = names.withColumn("_bucket", F.substring(F.md5(column), 1, BUCKET_DIGITS))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    if known is not None:
        used = known.agg(F.coalesce(F.max(id_name), F.lit(0)).cast("long").alias("_size"))
        sizes = sizes.unionByName(used.select(F.lit("").alias("_bucket"), "_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(column))
    return (
        bucketed.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .select((F.col("_offset") + F.col("_rank")).alias(id_name), column)
    )


def extend_dimension(
    trips: DataFrame, column: str, id_name: str, known: DataFrame
) -> DataFrame:
    """Rows to add for names not yet known, numbered after the largest id in use."""
    return number_names(new_names(trips, column, known), column, id_name, known)


def with_points(df: DataFrame) -> DataFrame:
    """Points as WKT text next to the plain coordinates that filters use."""
    return df.withColumns(
        {
            f"{end}_geom": point_text(F.col(f"{end}_lon"), F.col(f"{end}_lat"))
            for end in ("origin", "destination")
        }
    )


def serving_rows(silver: DataFrame) -> DataFrame:
    """The serving projection; ``trip_day`` stays along when the trips carry it."""
    kept = [name for name in ("trip_day",) if name in silver.columns]
    timed = add_geohashes(silver).withColumn("datetime", instant_of(silver))
    return with_points(timed.select(*SERVING_COLUMNS, *kept))
