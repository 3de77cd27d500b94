"""What the operators share: written intermediate tables and their place."""

from __future__ import annotations

import ctypes
import gc
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.session import fresh_dir

#: Id tables up to this many rows (8 bytes a row) may be broadcast; larger ones are shuffled.
BROADCAST_IDS = 2_000_000


#: The model that this Python worker works with: its key, and the model.
_model: list = [None, None]


def release_memory() -> None:
    """Give back what this Python worker holds free: Arrow's pool, and the heap of the C library
    where that has a call for it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker_model(key: tuple, build: Callable[[], Any]) -> Any:
    """What a Python worker builds once and keeps between tasks. It keeps one: workers live on,
    and the next stage must not find the models and buffers of those before beside its own."""
    if _model[0] != key:
        _model[:] = None, None
        release_memory()
        _model[:] = key, build()
    return _model[1]


#: Seconds without a task after which a Python worker gives its memory back.
IDLE_SECONDS = 2.0
#: Tasks that run in this worker, and those that have begun so far. Reentrant, since collecting
#: garbage may end a task that was not read to its end.
_tasks = [0, 0]
_lock = threading.RLock()


def _rest(begun: int) -> None:
    with _lock:
        if _tasks == [0, begun]:
            _model[:] = None, None
            release_memory()


def gives_back(work: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A task's work on Arrow batches, after which the worker drops its model and frees its memory
    unless another task comes soon. Spark keeps workers that have nothing to do for a minute, as
    many as a stage with several passes needed, beside those that the next stage works with."""

    @wraps(work)
    def task(*args, **named) -> Iterator[pa.RecordBatch]:
        with _lock:
            _tasks[:] = _tasks[0] + 1, _tasks[1] + 1
        try:
            yield from work(*args, **named)
        finally:
            with _lock:
                _tasks[0] -= 1
                timer = threading.Timer(IDLE_SECONDS, _rest, [_tasks[1]])
            timer.daemon = True
            timer.start()

    return task


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as Parquet in the shared folder: lineage ends there, and a lost executor
    costs a read and not the work before it."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what is written meanwhile. A batch of long texts
    is held whole by the JVM, by the Python worker and, being decoded, by its strings."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(rows, int(before)) if int(before) > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def among(
    rows: DataFrame, ids: DataFrame, column: str, how: str = "left_semi"
) -> DataFrame:
    """The rows whose ``column`` is among the distinct ids, a written one-column table; with
    ``left_anti`` those where it is not.

    A counted, small id table goes to every executor, so that wide rows need no shuffle;
    beyond ``BROADCAST_IDS`` both sides are shuffled. Rows are the same either way.
    """
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, column, how)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(id_column: str, folds: int):
    """The fold of a row: crc32 of its id's decimal text, modulo the number of folds."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds
