"""The status feed: reading it for one ingestion, and FAILED rows for ended queries."""

from __future__ import annotations

import atexit
import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tripweave import schemas
from tripweave.sources.lake import Lake
from tripweave.sources.tables import table_stream


def all_statuses(spark: SparkSession, lake: Lake) -> DataFrame:
    """Statuses of every ingestion from the beginning, as the stages write them."""
    return table_stream(spark, lake.path("status"), schemas.STATUS)


def status_stream(spark: SparkSession, lake: Lake, ingestion_id: str) -> DataFrame:
    """The feed of one ingestion."""
    return all_statuses(spark, lake).where(F.col("ingestion_id") == ingestion_id)


def open_ingestions(spark: SparkSession, lake: Lake) -> DataFrame:
    """Ingestions that have rows or a marker in the lake and are not complete."""
    seen = (
        lake.read(spark, "markers")
        .select("ingestion_id")
        .unionByName(lake.read(spark, "arrivals").select("ingestion_id"))
        .where("ingestion_id is not null")
        .distinct()
    )
    done = lake.read(spark, "status").where(F.col("status") == schemas.TRIPS_PG_COMPLETED)
    return seen.join(done.select("ingestion_id").distinct(), "ingestion_id", "left_anti")


class FailureListener(StreamingQueryListener):
    """Writes a FAILED row for every open ingestion when a query ends with an error, so that
    each ingestion's feed shows it, and one without an ingestion for the query itself."""

    def __init__(self, spark: SparkSession, lake: Lake) -> None:
        self.spark = spark
        self.lake = lake
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name or "unnamed"

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            name = self.names.get(str(event.runId), "unnamed")
            message = F.lit(event.exception).alias("message")
            query = self.spark.range(1).select(F.lit(None).cast("string").alias("ingestion_id"))
            rows = query.unionByName(open_ingestions(self.spark, self.lake)).select("*", message)
            self.lake.write_status(rows, schemas.FAILED, f"failed-{name}-{event.runId}", 0)


_WATCHED: set[tuple[str, str]] = set()


def watch_failures(spark: SparkSession, lake: Lake) -> None:
    """Register the listener, once for each session and lake."""
    key = (spark.sparkContext.applicationId, lake.base)
    if key not in _WATCHED:
        _WATCHED.add(key)
        listener = FailureListener(spark, lake)
        spark.streams.addListener(listener)
        # Events of the session's end must not look for a Python that is gone.
        atexit.register(_forget, spark, listener)


def _forget(spark: SparkSession, listener: FailureListener) -> None:
    with contextlib.suppress(Exception):
        spark.streams.removeListener(listener)
