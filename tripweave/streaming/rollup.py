"""Counts of a table's batches that add up, kept in tiers.

Each batch has its own counts (tier 0), so a replay of the batch replaces them. Sixteen
batches that can get no new neighbour are summed into one part of tier 1, sixteen of these into
one of tier 2, and so on. A read takes the highest parts that are whole and, of each lower tier,
the few beside them: of n batches about 16 log n sets instead of n. A replayed batch makes its own
part of each tier anew and no other.

How far each tier is written stands in a small table of its own, which is written last: a reader
sees a run's work when all of it is there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.sources import files
from tripweave.sources.lake import TABLES, Lake
from tripweave.sources.tables import (
    overwrite_partitions,
    read_directories,
    read_snapshot,
    write_snapshot,
)

#: Sets of one tier that make one of the next.
FAN = 16

_STATE = T.StructType(
    [
        T.StructField("newest", T.LongType()),
        T.StructField("tier", T.IntegerType()),
        T.StructField("parts", T.LongType()),
    ]
)


@dataclass(frozen=True)
class State:
    """The newest batch counted, and for each tier from 1 on how many parts are written."""

    newest: int = -1
    parts: tuple[int, ...] = ()


@dataclass(frozen=True)
class RollUp:
    """Counts per ``keys``, from ``count``, which gives a batch's ``trip_count`` per batch and
    keys. ``table`` is the table of tier 0, ``source`` the one whose batches are counted."""

    table: str
    keys: tuple[str, ...]
    count: Callable[[DataFrame], DataFrame]
    source: str = "silver"
    fan: int = FAN

    def tier_path(self, lake: Lake) -> str:
        return lake.path(f"{self.table}_tiers")

    def state(self, spark: SparkSession, lake: Lake) -> State:
        path = f"{self.tier_path(lake)}/state"
        if not files.exists(spark, path):
            return State()
        rows = read_snapshot(spark, path, _STATE).orderBy("tier").collect()
        return State(rows[0].newest, tuple(r.parts for r in rows if r.tier > 0))

    def _schema(self) -> T.StructType:
        counts = [f for f in TABLES[self.table][0] if f.name in (*self.keys, "trip_count")]
        return T.StructType([*counts, T.StructField("part", T.LongType())])

    def _sets(self, spark: SparkSession, lake: Lake, tier: int, numbers: list[int]) -> DataFrame:
        """Sets of one tier as keys, ``trip_count`` and ``part``, the set's number. A set that
        has no row has no directory."""
        if tier == 0:
            rows = lake.read_batches(spark, self.table, numbers).withColumnRenamed("batch_id", "part")
        else:
            path = f"{self.tier_path(lake)}/tier={tier}"
            if not files.exists(spark, path):
                return spark.createDataFrame([], self._schema())
            names = [f"part={n}" for n in numbers]
            rows = read_directories(spark, path, self._schema(), names)
        return rows.select(*self.keys, "trip_count", "part")

    def add(self, spark: SparkSession, lake: Lake, batches: list[int]) -> None:
        """Count these batches, for the first time or again, and bring the tiers up."""
        if not batches:
            return
        counted = self.count(lake.read_batches(spark, self.source, batches))
        overwrite_partitions(counted, lake.path(self.table), ("batch_id",))
        before = self.state(spark, lake)
        newest = max(before.newest, *batches)
        parts: list[int] = []
        width = self.fan
        while (newest + 1) // width:
            tier, whole = len(parts) + 1, (newest + 1) // width
            had = before.parts[tier - 1] if tier <= len(before.parts) else 0
            touched = {b // width for b in batches if b // width < had}
            self._write_tier(spark, lake, tier, sorted(touched | set(range(had, whole))))
            parts.append(whole)
            width *= self.fan
        rows = [(newest, 0, newest + 1), *((newest, t, n) for t, n in enumerate(parts, 1))]
        path = f"{self.tier_path(lake)}/state"
        write_snapshot(
            spark.createDataFrame(rows, _STATE).coalesce(1), path, self._next_version(spark, path)
        )

    def _next_version(self, spark: SparkSession, path: str) -> int:
        if not files.exists(spark, path):
            return 0
        return spark.read.parquet(path).agg(F.max("version")).first()[0] + 1

    def _write_tier(self, spark: SparkSession, lake: Lake, tier: int, parts: list[int]) -> None:
        if not parts:
            return
        below = [n for part in parts for n in range(part * self.fan, (part + 1) * self.fan)]
        summed = (
            self._sets(spark, lake, tier - 1, below)
            .withColumn("part", F.floor(F.col("part") / self.fan).cast("long"))
            .groupBy("part", *self.keys)
            .agg(F.sum("trip_count").alias("trip_count"))
        )
        overwrite_partitions(summed, f"{self.tier_path(lake)}/tier={tier}", ("part",))

    def needed(self, state: State) -> list[tuple[int, list[int]]]:
        """The sets that together hold every batch once: (tier, numbers), highest tier first."""
        out, start = [], 0
        for tier in range(len(state.parts), -1, -1):
            end = state.parts[tier - 1] if tier else state.newest + 1
            out.append((tier, list(range(start, end))))
            start = end * self.fan
        return out

    def read(self, spark: SparkSession, lake: Lake) -> DataFrame:
        """Keys and ``trip_count`` of all counted batches, a few rows for each key."""
        rows = None
        for tier, numbers in self.needed(self.state(spark, lake)):
            if numbers:
                own = self._sets(spark, lake, tier, numbers).drop("part")
                rows = own if rows is None else rows.unionByName(own)
        if rows is None:
            return spark.createDataFrame([], self._schema()).drop("part")
        return rows
