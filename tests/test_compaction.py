"""Merging closed batches: same rows before and after, repeated and broken-off runs, listings."""

import pytest
from pyspark.sql import functions as F

from tripweave.operators import routing
from tripweave.sources import compaction
from tripweave.sources.lake import Lake
from tripweave.sources.tables import write_by_day
from tripweave.streaming import answers, gold
from tripweave.streaming.ingest import land_batch
from tripweave.streaming.runner import finish
from tripweave.streaming.serving import start_serving
from test_streams import log_rows, marker, trip

DAYS = [f"2018-05-{n:02d}" for n in range(1, 6)]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(str(tmp_path / "lake")).create(spark)


def fill(spark, lake, batches, table="silver"):
    """Each batch has a row in two of five days."""
    for batch in batches:
        days = [DAYS[batch % 5], DAYS[(batch + 1) % 5]]
        rows = spark.createDataFrame([(d, f"{batch}-{d}") for d in days], "trip_day string, trip_id string")
        write_by_day(rows.coalesce(1), lake.path(table), batch)


def content(df):
    return sorted((r.batch_id, r.trip_day, r.trip_id) for r in df.collect())


def test_rows_stay_the_same_and_directories_get_fewer(spark, lake):
    fill(spark, lake, range(12))
    table = lake.compacted("silver")
    once, day = content(lake.read(spark, "silver")), content(lake.read_days(spark, "silver", DAYS[:1], before=9))
    listed = lambda: len(
        table.merged_directories(table.state(spark), DAYS[:2])
        + table.open_directories(spark, table.state(spark), DAYS[:2])
    )
    before = listed()
    table.compact(spark, 8)
    assert listed() < before
    table.compact(spark, 8)  # nothing is left to do
    assert table.state(spark).generation == 1
    table.compact(spark, 11)
    assert table.clean(spark) > 0
    assert listed() == 2 + sum(b >= 11 and d in ((b % 5), (b + 1) % 5) for b in range(12) for d in (0, 1))
    assert content(lake.read(spark, "silver")) == once
    assert content(lake.read_days(spark, "silver", DAYS[:1], before=9)) == day
    assert content(lake.read_batches(spark, "silver", [3, 11, 99])) == [r for r in once if r[0] in (3, 11)]
    assert len(table.merged_directories(table.state(spark))) == 5
    fill(spark, lake, [12])
    assert len(content(lake.read(spark, "silver"))) == len(once) + 2


def test_days_without_new_batches_are_not_written_again(spark, lake):
    fill(spark, lake, [0, 3])  # days 0, 1 and 3, 4
    table = lake.compacted("silver")
    table.compact(spark, 1)
    state = table.compact(spark, 4)
    assert state.days == {DAYS[0]: 1, DAYS[1]: 1, DAYS[3]: 2, DAYS[4]: 2}
    assert content(lake.read(spark, "silver")) == content(lake.read_batches(spark, "silver", [0, 3]))


def test_a_run_that_is_broken_off_changes_nothing(spark, lake, monkeypatch):
    fill(spark, lake, range(4))
    table, once = lake.compacted("silver"), content(lake.read(spark, "silver"))

    def stop(*_):
        raise OSError("gone")

    for generation in (1, 2):
        monkeypatch.setattr(compaction.DayTable, "_commit", stop)
        with pytest.raises(OSError):
            table.compact(spark, 2 * generation)
        monkeypatch.undo()
        assert content(lake.read(spark, "silver")) == once
        assert table.state(spark).boundary == 2 * generation - 2
        table.clean(spark)
        assert content(lake.read(spark, "silver")) == once
        assert table.compact(spark, 2 * generation).generation == generation
        assert content(lake.read(spark, "silver")) == once


def test_jobs_go_on_over_merged_batches(spark, lake):
    def catch_up():
        finish(
            gold.start_cluster_rollup(spark, lake, available_now=True),
            gold.start_weekly_rollup(spark, lake, available_now=True),
            start_serving(spark, lake, available_now=True),
        )

    def state():
        clusters = gold.rolled_up_clusters(spark, lake).collect()
        return (
            sorted(r.trip_id for r in lake.read(spark, "silver").collect()),
            sorted(r.trip_id for r in lake.read(spark, "serving").collect()),
            sorted(map(str, clusters)),
            sorted(map(str, answers.region_averages(spark, lake).collect())),
        )

    first = [trip(n) for n in range(1, 9)]
    land_batch(spark, routing.decode(log_rows(spark, first[:4])), 0, lake)
    land_batch(spark, routing.decode(log_rows(spark, [*first[4:], marker("i1", 8)])), 1, lake)
    catch_up()
    once = state()
    # The first batch is merged before a job that lags behind has seen it.
    for name in ("silver", "serving"):
        lake.compacted(name).compact(spark, 1)
        lake.compacted(name).clean(spark)
    assert state() == once
    # Copies of merged trips are known; the newest batch may still be replayed.
    land_batch(spark, routing.decode(log_rows(spark, [*first[4:], marker("i1", 8)])), 1, lake)
    land_batch(spark, routing.decode(log_rows(spark, [trip(1, "i2"), trip(6, "i2"), marker("i2", 2)], 1)), 2, lake)
    catch_up()
    assert state() == once
    done = lake.read(spark, "status").where("status = 'TRIPS_PG_COMPLETED'").collect()
    assert {(r.ingestion_id, r.stored_rows) for r in done} == {("i1", 8), ("i2", 0)}
    lagging = gold.CLUSTER_COUNTS.count(lake.read_batches(spark, "silver", [0]))
    assert lagging.agg(F.sum("trip_count")).first()[0] == 4
