"""Where the tables of one run live. Tables and checkpoints share a base directory, so
they are always replaced together and batch ids never start again over old data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave import schemas
from tripweave.sources import compaction
from tripweave.sources.tables import (
    batch_numbers,
    ensure_table,
    overwrite_partitions,
    read_directories,
    read_table,
)

# Table name -> (schema, partition columns).
TABLES = {
    "uploads": (schemas.SENT_TRIPS, ["load_id"]),
    "bronze": (schemas.BRONZE, ["batch_id", "route"]),
    "landed_counts": (schemas.LANDED_COUNTS, ["batch_id"]),
    "silver": (schemas.SILVER, ["batch_id", "trip_day"]),
    "bounded_batches": (schemas.BOUNDED_BATCHES, ["batch_id"]),
    "high_water": (schemas.HIGH_WATER, ["batch_id"]),
    "markers": (schemas.MARKERS, ["batch_id"]),
    "rejected": (schemas.REJECTED, ["batch_id"]),
    "arrivals": (schemas.ARRIVALS, ["batch_id"]),
    "status": (schemas.STATUS, ["query", "batch_id"]),
    "cluster_snapshots": (schemas.CLUSTER_SNAPSHOTS, ["batch_id"]),
    "cluster_deltas": (schemas.CLUSTER_SNAPSHOTS, ["batch_id"]),
    "weekly_deltas": (schemas.WEEKLY_DELTAS, ["batch_id"]),
    "cell_weeks": (schemas.CELL_WEEKS, ["batch_id"]),
    "serving": (schemas.SERVING, ["batch_id", "trip_day"]),
    "regions": (schemas.dimension("region_id", "region"), ["batch_id"]),
    "datasources": (schemas.dimension("datasource_id", "datasource"), ["batch_id"]),
}

#: Tables whose closed batches are merged into one set of files for each day, and the order of
#: rows in these files.
COMPACTED = {"silver": (), "serving": ("origin_geohash",)}

STATUS_FIELDS = ("rows", "total_rows", "stored_rows")


@dataclass(frozen=True)
class Lake:
    base: str

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def checkpoint(self, query: str) -> str:
        return f"{self.base}/checkpoints/{query}"

    def create(self, spark: SparkSession) -> "Lake":
        for table, (schema, partitions) in TABLES.items():
            ensure_table(spark, self.path(table), schema, partitions)
        return self

    def compacted(self, table: str) -> compaction.DayTable:
        """A table of batches and days, whose closed batches are merged day by day."""
        return compaction.DayTable(self.path(table), TABLES[table][0], COMPACTED[table])

    def read(self, spark: SparkSession, table: str, before: int | None = None) -> DataFrame:
        """A table, or only its batches before the given one."""
        if table in COMPACTED:
            return self.compacted(table).read(spark, before=before)
        rows = read_table(spark, self.path(table), TABLES[table][0])
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def read_days(
        self, spark: SparkSession, table: str, days: list[str], before: int | None = None
    ) -> DataFrame:
        """Some days of a table of days: their merged files and, of the batches not merged yet,
        these days' directories. The cost does not grow with the other days, nor with the
        batches that are merged."""
        return self.compacted(table).read(spark, days, before)

    def read_batches(self, spark: SparkSession, table: str, batches: list[int]) -> DataFrame:
        """Some batches of a table, found by their own directories. Batches that wrote nothing
        have no rows."""
        if table in COMPACTED:
            return self.compacted(table).read_batches(spark, batches)
        names = [f"batch_id={batch}" for batch in batches]
        return read_directories(spark, self.path(table), TABLES[table][0], names)

    def newest_batch(self, spark: SparkSession, table: str) -> int | None:
        return max(batch_numbers(spark, self.path(table)), default=None)

    def landed(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """One bronze batch, found by its own directory and not by listing the table."""
        path = self.path("bronze")
        return (
            spark.read.schema(schemas.BRONZE)
            .option("basePath", path)
            .parquet(f"{path}/batch_id={batch_id}")
        )

    def write_status(
        self, rows: DataFrame, status: str | Column, query: str, batch_id: int
    ) -> None:
        """Status rows of one stage and batch; ``rows`` has the id and any counts."""
        counts = [
            (F.col(name) if name in rows.columns else F.lit(None)).cast("long").alias(name)
            for name in STATUS_FIELDS
        ]
        message = F.col("message") if "message" in rows.columns else F.lit(None)
        overwrite_partitions(
            rows.select(
                "ingestion_id",
                (F.lit(status) if isinstance(status, str) else status).alias("status"),
                *counts,
                message.cast("string").alias("message"),
                F.lit(query).alias("query"),
                F.lit(batch_id).cast("long").alias("batch_id"),
            ),
            self.path("status"),
            ("query", "batch_id"),
        )
