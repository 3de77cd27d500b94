"""Starting, bounding and waiting for the streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

TRIGGER_SECONDS = 5


def start(
    df: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str,
    output: str = "append",
    available_now: bool = False,
    every: float = TRIGGER_SECONDS,
) -> StreamingQuery:
    """Start a query that looks for new rows ``every`` so many seconds, or, with
    ``available_now``, ends when it has seen all there are."""
    writer = (
        df.writeStream.foreachBatch(each_batch)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .outputMode(output)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{round(every * 1000)} milliseconds").start()


def finish(*queries: StreamingQuery) -> None:
    """Wait for ``availableNow`` queries; a failed one raises."""
    for query in queries:
        query.awaitTermination()


def run_until_any_ends(spark: SparkSession, timeout: int | None = None) -> bool | None:
    return spark.streams.awaitAnyTermination(timeout)


def with_retry(
    action: Callable[[], None],
    attempts: int = 3,
    first_wait: float = 2.0,
    sleep: Callable[[float], None] = time.sleep,
) -> None:
    """Run a write again after a failure, waiting twice as long each time.

    Only for writes that may run twice: batch overwrites and insert-if-absent."""
    for attempt in range(attempts):
        try:
            action()
            return
        except Exception:
            if attempt == attempts - 1:
                raise
            sleep(first_wait * 2**attempt)
