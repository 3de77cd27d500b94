"""Parquet tables whose unit of writing is one batch.

Each batch owns its partition directories and overwrites them, so running a batch again
leaves the table as it was. Readers pass the schema: a column an older file lacks reads as
a typed NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.sources import files


#: Payloads and hexadecimal ids take about a third less than with the default codec.
CODEC = {"compression": "zstd"}
#: Row groups of the tables of days say which ids they may have.
ID_FILTERS = {
    "parquet.bloom.filter.enabled#trip_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(1 << 20),
}


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, partitions: list[str]
) -> None:
    """Create an empty table where there is none, so that readers can start first."""
    empty = spark.range(0, 0, 1, 1).select(
        *(F.lit(None).cast(field.dataType).alias(field.name) for field in schema)
    )
    empty.write.mode("ignore").partitionBy(*partitions).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_paths(
    spark: SparkSession, base: str, schema: T.StructType, paths: list[str]
) -> DataFrame:
    """Partition directories of a table, given by their paths; no other is listed."""
    if not paths:
        # The condition tells the optimizer that there is nothing: joins with it fall away.
        return spark.createDataFrame([], schema).where("false")
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def read_directories(
    spark: SparkSession, path: str, schema: T.StructType, names: list[str]
) -> DataFrame:
    """Partition directories of a table; those that do not exist have no rows.

    One listing of the table's first level finds them, and only they are listed further.
    A table that is not there at all is an error.
    """
    there = set(files.directories(spark, path)) & set(names)
    return read_paths(spark, path, schema, [f"{path}/{name}" for name in sorted(there)])


def batch_numbers(spark: SparkSession, path: str) -> list[int]:
    """The batches that have directories of their own in a table: one listing."""
    names = files.directories(spark, path)
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id="))


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """The table as a stream of its files. A replayed batch replaces files, so a listed
    file may be gone by the time it is read; its rows come again in the new file."""
    reader = spark.readStream.schema(schema).option("ignoreMissingFiles", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


@contextmanager
def files_side_by_side(spark: SparkSession, most: int) -> Iterator[None]:
    """What is written meanwhile keeps the files of so many partitions open in a task, which then
    need not sort its rows, payloads and all, by partition. With more partitions it sorts."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    also_by: tuple[str, ...] = (),
    values: int = 0,
) -> None:
    """Write one batch's partitions in the batch's own directory, replacing what is there.
    ``values`` is how many the columns ``also_by`` have, where that is known to be few."""
    if not also_by:
        stamped = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        overwrite_partitions(stamped, path, ("batch_id",))
        return
    with files_side_by_side(df.sparkSession, values):
        overwrite_partitions(df, f"{path}/batch_id={batch_id}", also_by)


def write_by_day(
    df: DataFrame, path: str, batch_id: int, ordered_by: tuple[str, ...] = ()
) -> None:
    """Write one batch into its own directory, by day, replacing what the batch has of the days
    it writes. Compaction later turns many batches into one set of files for each day."""
    # The batch's directory is the target, not a column: a constant column in the writer's order
    # would have it sort again and lose the order inside a day.
    if ordered_by:
        df = df.sortWithinPartitions("trip_day", *ordered_by)
    overwrite_partitions(df, f"{path}/batch_id={batch_id}", ("trip_day",), ID_FILTERS)


def overwrite_partitions(
    df: DataFrame, path: str, columns: tuple[str, ...], options: dict[str, str] | None = None
) -> None:
    (
        df.write.mode("overwrite")
        .options(**CODEC, **(options or {}))
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_snapshot(df: DataFrame, path: str, version: int) -> None:
    """Replace the whole content while the previous version stays readable beside it."""
    stamped = df.withColumns(
        {"version": F.lit(version).cast("long"), "slot": F.lit(version % 2)}
    )
    overwrite_partitions(stamped, path, ("slot",))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version. Its number comes from one aggregated row."""
    versioned = T.StructType(
        [
            *schema.fields,
            T.StructField("version", T.LongType()),
            T.StructField("slot", T.IntegerType()),
        ]
    )
    rows = read_table(spark, path, versioned)
    newest = rows.agg(F.max("version").alias("version"))
    return rows.join(F.broadcast(newest), "version").select(*schema.names)


def partition_values(df: DataFrame, values: Column | str) -> list:
    """The distinct values of a partition column, or of an array of them, for pruning.

    One value per directory that the rows touch: as many as the writer lists in any case.
    """
    column = F.col(values) if isinstance(values, str) else F.explode(values)
    return [row[0] for row in df.select(column.alias("value")).distinct().collect()]
