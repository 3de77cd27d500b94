"""Tables of batches and days, and the merge of their closed batches into files by day.

Batches write ``batch_id=B/trip_day=D``. That is right for finding a batch, and for a replayed
batch to replace itself, but a day is soon spread over as many directories as there were batches.
``compact`` merges all batches below a boundary into ``<table>_compacted/generation=G/trip_day=D``:
one set of files for each day. A run rewrites only the days of the batches that it adds; a small
table of its own says which generation holds each day, and where the boundary is. Readers take
days from there and batches from the boundary on from the batches' directories, so that each row
is met once, before, while and after a run.

A run writes its files first and its boundary last. One that is broken off leaves the boundary
as it was, and the next writes the same generation again. Streams of the table's new files do not
see merged ones. ``clean`` drops what no reader needs any more.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.sources import files
from tripweave.sources.tables import (
    CODEC,
    ID_FILTERS,
    batch_numbers,
    partition_values,
    read_paths,
    read_snapshot,
    write_snapshot,
)

_STATE = T.StructType(
    [
        T.StructField("boundary", T.LongType()),
        T.StructField("generation", T.LongType()),
        T.StructField("trip_day", T.StringType()),
        T.StructField("held_by", T.LongType()),
    ]
)


@dataclass(frozen=True)
class State:
    """Batches below ``boundary`` are merged; ``days`` names the generation of each day."""

    boundary: int
    generation: int
    days: dict[str, int]


@dataclass(frozen=True)
class DayTable:
    path: str
    schema: T.StructType
    ordered_by: tuple[str, ...] = ()

    @property
    def merged_path(self) -> str:
        return f"{self.path}_compacted"

    @property
    def state_path(self) -> str:
        return f"{self.merged_path}/state"

    def state(self, spark: SparkSession) -> State:
        if not files.exists(spark, self.state_path):
            return State(0, 0, {})
        rows = read_snapshot(spark, self.state_path, _STATE).collect()  # a row for each day
        days = {r.trip_day: r.held_by for r in rows if r.trip_day is not None}
        return State(rows[0].boundary, rows[0].generation, days)

    # ---- which directories a read needs

    def merged_directories(self, state: State, days: Iterable[str] | None = None) -> list[str]:
        wanted = state.days if days is None else set(days) & set(state.days)
        return [
            f"{self.merged_path}/generation={state.days[day]}/trip_day={day}" for day in sorted(wanted)
        ]

    def open_directories(
        self,
        spark: SparkSession,
        state: State,
        days: Iterable[str] | None = None,
        before: int | None = None,
    ) -> list[str]:
        """Directories of batches that are not merged: the batches', or those of some days."""
        batches = [
            b
            for b in batch_numbers(spark, self.path)
            if b >= state.boundary and (before is None or b < before)
        ]
        found = [f"{self.path}/batch_id={b}" for b in batches]
        if days is None:
            return found
        names = {f"trip_day={day}" for day in days}
        return [f"{at}/{n}" for at in found for n in files.directories(spark, at) if n in names]

    # ---- reading

    def _merged_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("generation", T.LongType())])

    def _both(
        self, spark: SparkSession, merged: list[str], unmerged: list[str]
    ) -> DataFrame:
        old = read_paths(spark, self.merged_path, self._merged_schema(), merged)
        new = read_paths(spark, self.path, self.schema, unmerged)
        old = old.select(*self.schema.names)
        if not merged:
            return new
        return old if not unmerged else old.unionByName(new)

    def read(
        self, spark: SparkSession, days: list[str] | None = None, before: int | None = None
    ) -> DataFrame:
        """The table, or some days of it, or its batches before the given one."""
        state = self.state(spark)
        rows = self._both(
            spark,
            self.merged_directories(state, days),
            self.open_directories(spark, state, days, before),
        )
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def read_batches(self, spark: SparkSession, batches: list[int]) -> DataFrame:
        """Some batches. Those that are merged already are looked for in all days' files, whose
        row groups tell their batches; readers that keep up with the table ask for none."""
        state = self.state(spark)
        there = set(batch_numbers(spark, self.path)) & set(batches)
        unmerged = [f"{self.path}/batch_id={b}" for b in sorted(there) if b >= state.boundary]
        old = [b for b in batches if b < state.boundary]
        merged = self.merged_directories(state) if old else []
        rows = self._both(spark, merged, unmerged)
        return rows.where(F.col("batch_id").isin(batches)) if merged else rows

    # ---- maintenance

    def compact(self, spark: SparkSession, upto: int) -> State:
        """Merge the batches below ``upto``, which must be closed: no query may write one of
        them again. Merging what is merged changes nothing."""
        before = self.state(spark)
        if upto <= before.boundary:
            return before
        added = read_paths(
            spark, self.path, self.schema, self.open_directories(spark, before, before=upto)
        )
        touched = partition_values(added, "trip_day")
        generation = before.generation + 1
        if touched:
            rows = self._rewritten(spark, before, added, touched).hint("rebalance", "trip_day")
            if self.ordered_by:
                rows = rows.sortWithinPartitions("trip_day", *self.ordered_by)
            rows.write.mode("overwrite").options(**CODEC, **ID_FILTERS).partitionBy("trip_day").parquet(
                f"{self.merged_path}/generation={generation}"
            )
        after = State(upto, generation, before.days | dict.fromkeys(touched, generation))
        self._commit(spark, after)
        return after

    def _rewritten(
        self, spark: SparkSession, state: State, added: DataFrame, days: list[str]
    ) -> DataFrame:
        merged = self.merged_directories(state, days)
        if not merged:
            return added
        old = read_paths(spark, self.merged_path, self._merged_schema(), merged)
        return added.unionByName(old.select(*self.schema.names))

    def _commit(self, spark: SparkSession, state: State) -> None:
        rows = [(state.boundary, state.generation, day, g) for day, g in state.days.items()]
        rows.append((state.boundary, state.generation, None, None))
        write_snapshot(
            spark.createDataFrame(rows, _STATE).coalesce(1), self.state_path, state.generation
        )

    def clean(self, spark: SparkSession) -> int:
        """Drop the directories of merged batches and the sets that newer generations replace;
        the number of them. For when no reader of an older state and no stream of the table's
        files is left behind the boundary."""
        state = self.state(spark)
        gone = [
            f"{self.path}/batch_id={b}"
            for b in batch_numbers(spark, self.path)
            if b < state.boundary
        ]
        if files.exists(spark, self.merged_path):
            for name in files.directories(spark, self.merged_path):
                if not name.startswith("generation="):
                    continue
                at, held = f"{self.merged_path}/{name}", set(self.merged_directories(state))
                if int(name.split("=")[1]) > state.generation:
                    continue  # a run that has not committed yet
                days = [f"{at}/{day}" for day in files.directories(spark, at)]
                kept = [day for day in days if day in held]
                gone += [day for day in days if day not in held] if kept else [at]
        for path in gone:
            files.drop_directory(spark, path)
        return len(gone)
