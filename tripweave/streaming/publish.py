"""CSV uploads -> event log, with the statuses of the upload side."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripweave.operators import uploads
from tripweave.schemas import STARTED
from tripweave.sources.event_log import append_events
from tripweave.sources.lake import Lake
from tripweave.sources.tables import overwrite_partitions
from tripweave.sources.uploads import read_uploads, upload_files


def publish_uploads(
    spark: SparkSession,
    path: str,
    lake: Lake,
    load_id: str | None = None,
    publish=None,
    multi_line: bool = False,
) -> str:
    """Publish every file under ``path`` as one ingestion and return the load's id.

    The files are scanned and parsed once, into a partition of their own; events, markers
    and statuses all come from there. ``publish`` takes the event rows; it defaults to
    files of the log. A load published again under its id repeats events, which the
    consumers drop.
    """
    load_id = load_id or uuid.uuid4().hex
    stage = f"upload-{load_id}"
    files = uploads.assign_ingestions(upload_files(spark, path), load_id)
    lake.write_status(files, STARTED, f"{stage}-started", 0)

    rows = uploads.assign_ingestions(read_uploads(spark, path, multi_line), load_id)
    overwrite_partitions(
        uploads.accepted(uploads.parse_trips(rows)).withColumn("load_id", F.lit(load_id)),
        lake.path("uploads"),
        ("load_id",),
    )
    trips = lake.read(spark, "uploads").where(F.col("load_id") == load_id).drop("load_id")
    events = uploads.to_events(trips, files, F.current_timestamp())
    (publish or (lambda df: append_events(df, lake.path("log"))))(events)

    statuses = uploads.upload_statuses(trips, files).where(F.col("status") != STARTED)
    lake.write_status(statuses, F.col("status"), stage, 0)
    return load_id
