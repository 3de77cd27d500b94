"""Tiers of counts: what a read needs, replays, gaps."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tripweave.sources.lake import Lake
from tripweave.sources.tables import overwrite_partitions
from tripweave.streaming import gold
from tripweave.streaming.rollup import RollUp, State

WEEKS = replace(gold.WEEK_COUNTS, fan=4)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(str(tmp_path / "lake")).create(spark)


def land(spark, lake, batches, times=1):
    rows = [(f"{b}-{i}", "Prague" if i % 2 else "Turin", b) for b in batches for i in range(b % 3 * times + 1)]
    silver = spark.createDataFrame(rows, "trip_id string, region string, batch_id long").selectExpr(
        "*", "'2018-05-28T09:03:40Z' as datetime", "'2018-05-28' as trip_day"
    )
    overwrite_partitions(silver.coalesce(1), lake.path("silver"), ("batch_id", "trip_day"))


def counted(spark, lake):
    got = WEEKS.read(spark, lake).groupBy("region").agg(F.sum("trip_count").alias("n")).collect()
    return {r.region: r.n for r in got}


def expected(spark, lake, upto=None):
    rows = lake.read(spark, "silver", before=upto).groupBy("region").count().collect()
    return {r.region: r["count"] for r in rows}


def test_sets_cover_every_batch_once_and_are_few():
    for newest in [*range(300), 4095, 4096, 70_000]:
        parts, width = [], WEEKS.fan
        while (newest + 1) // width:
            parts.append((newest + 1) // width)
            width *= WEEKS.fan
        needed = WEEKS.needed(State(newest, tuple(parts)))
        spans = sorted((n * WEEKS.fan**tier, (n + 1) * WEEKS.fan**tier) for tier, ns in needed for n in ns)
        assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == newest + 1
        assert sum(len(ns) for _, ns in needed) <= (WEEKS.fan - 1) * (len(parts) + 1)


def test_counts_with_gaps_and_replays(spark, lake):
    rng = random.Random(4)
    assert counted(spark, lake) == {}
    batches = [b for b in range(23) if b not in (3, 8, 9, 10, 11, 15)]  # part 2 of tier 1 is empty
    for start in range(0, len(batches), 5):
        land(spark, lake, batches[start : start + 5])
        WEEKS.add(spark, lake, batches[start : start + 5])
        assert counted(spark, lake) == expected(spark, lake)
    for batch in rng.sample(batches, 3):
        land(spark, lake, [batch], times=3)
        WEEKS.add(spark, lake, [batch])
        assert counted(spark, lake) == expected(spark, lake)


def test_a_replay_writes_its_own_parts_alone(spark, lake, monkeypatch):
    land(spark, lake, range(18))
    WEEKS.add(spark, lake, list(range(18)))
    written = []
    plain = RollUp._write_tier
    monkeypatch.setattr(
        RollUp, "_write_tier", lambda self, s, l, tier, parts: (written.append((tier, parts)), plain(self, s, l, tier, parts))
    )
    land(spark, lake, [6], times=5)
    WEEKS.add(spark, lake, [6])
    assert written == [(1, [1]), (2, [0])]
    assert counted(spark, lake) == expected(spark, lake)


def test_a_run_that_is_broken_off_is_not_seen(spark, lake, monkeypatch):
    land(spark, lake, range(5))
    WEEKS.add(spark, lake, list(range(4)))
    once = counted(spark, lake)
    monkeypatch.setattr("tripweave.streaming.rollup.write_snapshot", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        WEEKS.add(spark, lake, [4])
    assert counted(spark, lake) == once == expected(spark, lake, upto=4)
    monkeypatch.undo()
    WEEKS.add(spark, lake, [4])
    assert counted(spark, lake) == expected(spark, lake)


def test_forty_batches_are_read_from_few_files(spark, lake):
    land(spark, lake, range(40))
    gold.WEEK_COUNTS.add(spark, lake, list(range(40)))
    files = gold.WEEK_COUNTS.read(spark, lake).inputFiles()
    places = {f.rsplit("/", 1)[0] for f in files}
    assert len(places) == 2 + 8  # two parts of tier 1, eight batches beside them
