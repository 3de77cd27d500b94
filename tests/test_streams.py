"""Streaming jobs: several batches, restarts, replays, failures."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tripweave.operators import completion, routing
from tripweave.operators.clusters import cluster_counts
from tripweave.schemas import ENVELOPE
from tripweave.session import fresh_dir
from tripweave.sources import event_log, tables
from tripweave.sources.lake import Lake
from tripweave.sources.tables import ID_FILTERS, partition_values, write_by_day
from tripweave.streaming import gold
from tripweave.streaming.bounded import start_bounded_silver
from tripweave.streaming.ingest import first_deliveries, land_batch, start_ingest
from tripweave.streaming.publish import publish_uploads
from tripweave.streaming.runner import finish, start, with_retry
from tripweave.streaming.serving import JdbcStore, start_serving
from tripweave.streaming.status import FailureListener, status_stream


def trip(n, ingestion="i1", **changes):
    return {
        "ingestion_id": ingestion,
        "row_number": n,
        "trip_id": f"t{n}",
        "region": "Prague" if n % 3 else "Turin",
        "origin_lon": 14.0,
        "origin_lat": 50.0,
        "destination_lon": 14.1,
        "destination_lat": 50.1,
        "datetime": f"2018-05-2{n % 3}T09:03:40Z",
        "datasource": f"s{n % 2}",
    } | changes


def marker(ingestion, total):
    return {
        "record_type": "ingestion_end",
        "ingestion_id": ingestion,
        "control_id": f"{ingestion}:end",
        "total_rows": total,
    }


def log_rows(spark, records, second=0):
    rows = [(r.get("ingestion_id"), json.dumps(r)) for r in records]
    df = spark.createDataFrame(rows, "key string, value string")
    return df.withColumn("timestamp", F.lit(1_527_000_000 + second).cast("timestamp"))


def publish(spark, lake, records, second=0):
    """One file per call, so that one file per trigger is one delivery per batch."""
    event_log.append_events(log_rows(spark, records, second).coalesce(1), lake.path("log"))


def ingest(spark, lake, max_files=1):
    log = event_log.file_stream(spark, lake.path("log"), max_files)
    finish(start_ingest(spark, log, lake, available_now=True))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(str(tmp_path / "lake")).create(spark)


def ids(df):
    return sorted(r.trip_id for r in df.select("trip_id").collect())


def test_batches_fan_out_and_duplicates_are_dropped(spark, lake):
    publish(spark, lake, [trip(1), trip(2), trip(2, row_number=9), marker("i1", 3)])
    publish(spark, lake, [trip(2, "i2"), trip(3, "i2"), trip(4, "i2", origin_lon=200.0), {"record_type": "x"}], 1)
    ingest(spark, lake)
    assert {r.batch_id for r in lake.read(spark, "bronze").collect()} == {0, 1}
    assert ids(lake.read(spark, "silver")) == ["t1", "t2", "t3"]
    kept = lake.read(spark, "silver").where("trip_id = 't2'").first()
    assert (kept.ingestion_id, kept.row_number) == ("i1", 2)
    assert [r.reject_reason for r in lake.read(spark, "rejected").collect()] == ["coordinate_out_of_range"]
    assert [r.total_rows for r in lake.read(spark, "markers").collect()] == [3]
    statuses = {(r.ingestion_id, r.status) for r in lake.read(spark, "status").collect()}
    assert statuses == {("i1", "BRONZE_COMPLETED"), ("i1", "SILVER_COMPLETED")}


def test_running_a_batch_again_changes_nothing(spark, lake):
    flat = [
        routing.decode(log_rows(spark, [trip(1), trip(2), marker("i1", 2)])),
        routing.decode(log_rows(spark, [trip(2, "i2"), trip(3, "i2", region=None)], 1)),
    ]
    tables = ("bronze", "silver", "rejected", "markers", "arrivals", "status")

    def content():
        return {t: sorted(map(str, lake.read(spark, t).collect())) for t in tables}

    for batch_id, batch in enumerate(flat):
        land_batch(spark, batch, batch_id, lake)
    once = content()
    for batch_id in (1, 0, 1):
        land_batch(spark, flat[batch_id], batch_id, lake)
    assert content() == once


def test_text_log_carries_key_and_time(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(trip(1)) + "\n" + json.dumps(marker("i1", 1)) + "\n")
    seen = []
    query = start(
        event_log.text_stream(spark, str(folder), 1),
        lambda batch, _: seen.extend(batch.collect()),
        "text_log",
        str(tmp_path / "checkpoint"),
        available_now=True,
    )
    finish(query)
    assert [r.key for r in seen] == ["i1", "i1"] and all(r.timestamp for r in seen)
    assert set(seen[0].asDict()) == set(ENVELOPE.names)


def test_gold_equals_batch_and_survives_a_replayed_silver_batch(spark, lake):
    jobs = (
        gold.start_clusters,
        gold.start_weekly,
        gold.start_cluster_snapshots,
        gold.start_cluster_rollup,
        gold.start_weekly_rollup,
    )

    def catch_up():
        finish(*(job(spark, lake, max_files=1, available_now=True) for job in jobs))

    def answers():
        sets = (gold.gold_clusters, gold.cluster_latest, gold.rolled_up_clusters)
        return [sorted(map(str, f(spark, lake).select(*columns).collect())) for f in sets]

    columns = ["origin_cell", "destination_cell", "time_bucket", "trip_count", "iso_week"]
    first = routing.decode(log_rows(spark, [trip(n) for n in range(1, 7)]))
    land_batch(spark, first, 0, lake)
    catch_up()
    # The batch runs again before its commit: same rows in new files.
    land_batch(spark, first, 0, lake)
    land_batch(spark, routing.decode(log_rows(spark, [trip(n, "i2") for n in range(5, 10)], 1)), 1, lake)
    catch_up()
    expected = sorted(map(str, cluster_counts(lake.read(spark, "silver")).select(*columns).collect()))
    assert answers() == [expected] * 3
    weekly = {(r.region, r.iso_week): r.trip_count for r in gold.gold_weekly(spark, lake).collect()}
    assert sum(weekly.values()) == 9
    rolled = {(r.region, r.iso_week): r.trip_count for r in gold.rolled_up_weeks(spark, lake).collect()}
    assert rolled == weekly


def test_serving_lookups_and_completion(spark, lake):
    def serve():
        finish(start_serving(spark, lake, max_files=1, available_now=True))

    publish(spark, lake, [trip(1), trip(2), trip(3, origin_lat=99.0), marker("none", 0)])
    ingest(spark, lake)
    serve()

    def completed():
        done = lake.read(spark, "status").where("status = 'TRIPS_PG_COMPLETED'")
        return {r.ingestion_id: (r.total_rows, r.stored_rows) for r in done.collect()}

    assert completed() == {"none": (0, 0)}
    publish(spark, lake, [marker("i1", 3)], 1)
    ingest(spark, lake)
    serve()
    assert completed() == {"none": (0, 0), "i1": (3, 2)}
    # The same upload again: nothing is stored, and it still completes.
    again = [trip(1, "i2"), trip(2, "i2"), trip(3, "i2", origin_lat=99.0), marker("i2", 3)]
    publish(spark, lake, again, 2)
    ingest(spark, lake)
    serve()
    assert completed() == {"none": (0, 0), "i1": (3, 2), "i2": (3, 0)}
    assert lake.read(spark, "status").where("status = 'TRIPS_PG_COMPLETED'").count() == 3
    served = lake.read(spark, "serving")
    assert ids(served) == ["t1", "t2"] and served.where("ingested_at is null").count() == 0
    assert sorted(r.datasource_id for r in lake.read(spark, "datasources").collect()) == [1, 2]

    feed = []
    query = start(
        status_stream(spark, lake, "i2"),
        lambda batch, _: feed.extend(r.status for r in batch.collect()),
        "feed",
        lake.checkpoint("feed"),
        available_now=True,
    )
    finish(query)
    assert sorted(feed) == ["BRONZE_COMPLETED", "SILVER_COMPLETED", "TRIPS_PG_COMPLETED"]


def test_state_dedup_across_batches(spark, lake):
    publish(spark, lake, [trip(1), trip(1), trip(2)])
    publish(spark, lake, [trip(2, "i2"), trip(3, "i2")], 1)
    seen = []
    log = event_log.file_stream(spark, lake.path("log"), 1)
    query = start(
        first_deliveries(log),
        lambda batch, _: seen.extend(r.trip_id for r in batch.collect()),
        "state_dedup",
        lake.checkpoint("state_dedup"),
        available_now=True,
    )
    finish(query)
    assert sorted(seen) == ["t1", "t2", "t3"]


def test_a_failed_query_leaves_a_status(spark, lake):
    listener = FailureListener(spark, lake)
    spark.streams.addListener(listener)
    try:
        publish(spark, lake, [trip(1)])
        publish(spark, lake, [marker("done", 0)], 1)
        ingest(spark, lake)
        finish(start_serving(spark, lake, available_now=True))

        def broken(batch, _):
            raise RuntimeError("sink is gone")

        log = event_log.file_stream(spark, lake.path("log"))
        query = start(log, broken, "broken", lake.checkpoint("broken"), available_now=True)
        with pytest.raises(Exception):
            finish(query)
        for _ in range(100):
            failed = lake.read(spark, "status").where("status = 'FAILED'").collect()
            if failed:
                break
            import time

            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    # One row for the query, and one in the feed of the ingestion that is open.
    assert {r.ingestion_id for r in failed} == {None, "i1"}
    assert all("sink is gone" in r.message for r in failed)
    assert all(r.query.startswith("failed-broken-") for r in failed)


def test_retry_waits_twice_as_long_each_time():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not yet")

    with_retry(flaky, sleep=waits.append)
    assert waits == [2.0, 4.0]
    with pytest.raises(OSError):
        with_retry(lambda: (_ for _ in ()).throw(OSError()), sleep=waits.append)


def test_jdbc_and_kafka_options(spark):
    store = JdbcStore("jdbc:db:x", "trips", "some.Driver", {"user": "u"})
    assert store.options()["connectTimeout"] == "15" and store.options()["socketTimeout"] == "30"
    trips = spark.createDataFrame([("2018-05-28T09:03:40Z",), ("2018-05-28T09:50:00Z",), ("2018-05-29T00:00:00Z",)], "datetime string")
    assert store.hours(trips) == [
        "datetime >= '2018-05-28 09:00:00' and datetime < '2018-05-28 10:00:00'",
        "datetime >= '2018-05-29 00:00:00' and datetime < '2018-05-29 01:00:00'",
    ]
    options = event_log.kafka_options("host:1", "trips.raw", 10)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "10"


def test_a_database_is_asked_for_foreign_ids_by_name(spark, monkeypatch):
    store = JdbcStore("jdbc:db:x", "trips", "some.Driver")
    rows = [("2018-05-28", "own"), ("other-0b", "b'x"), ("other-aa", "a"), ("other-aa", "a")]
    trips = spark.createDataFrame(rows, "trip_day string, trip_id string")
    assert store.foreign_ids(trips) == ["trip_id in ('a', 'b''x')"]
    assert store.foreign_ids(trips.where("trip_id = 'own'")) == []
    monkeypatch.setattr("tripweave.streaming.serving.MOST_IDS", 1)
    parts = store.foreign_ids(trips)
    # Every id lies in one part.
    assert parts[0] == "trip_id < '1'" and parts[-1] == "trip_id >= 'z'" and len(parts) == 36
    monkeypatch.setattr("tripweave.streaming.serving.MOST_IDS", 10)
    monkeypatch.setattr("tripweave.streaming.serving.IDS_PER_QUERY", 1)
    assert store.foreign_ids(trips) == ["trip_id in ('a')", "trip_id in ('b''x')"]


def test_foreign_ids_skip_row_groups(spark, lake):
    """A look-up by name reads fewer rows than the table has, though ids are in no order."""
    rows = spark.range(60_000).selectExpr("'other-00' as trip_day", "concat('f', md5(cast(id as string))) as trip_id")
    rows.write.options(**ID_FILTERS, **{"parquet.block.size": 65_536, "parquet.block.size.row.check.min": 100}).mode(
        "overwrite"
    ).partitionBy("trip_day").parquet(f"{lake.path('silver')}/batch_id=0")
    wanted = rows.where("trip_id in ('f' || md5('17'), 'f' || md5('42000'))").select("trip_id")
    found = routing.rows_of_ids(wanted, lambda _: lake.read(spark, "silver"))
    assert len(found.collect()) == wanted.count() == 2
    plan = found._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    assert plan.metrics().apply("numOutputRows").value() < 60_000 / 2


def test_a_batch_reads_only_the_days_it_asks_for(spark, lake):
    days = [f"2018-05-{n:02d}" for n in range(1, 13)]
    rows = spark.createDataFrame([(day,) for day in days], "trip_day string").selectExpr("trip_day", "trip_day as trip_id")
    for batch_id in range(3):
        write_by_day(rows, lake.path("silver"), batch_id)
    some = lake.read_days(spark, "silver", ["2018-05-02", "2018-05-09", "2020-01-01"], before=2)
    assert sorted((r.trip_day, r.batch_id) for r in some.collect()) == [
        (day, n) for day in ("2018-05-02", "2018-05-09") for n in range(2)
    ]
    assert {path.split("trip_day=")[1].split("/")[0] for path in some.inputFiles()} == {"2018-05-02", "2018-05-09"}
    assert lake.read_days(spark, "silver", ["2020-01-01"]).count() == 0
    assert lake.read_days(spark, "silver", []).count() == 0
    assert set(lake.read_days(spark, "silver", []).columns) == set(lake.read(spark, "silver").columns)
    # A batch is found by its own directory.
    one = lake.read_batches(spark, "silver", [1, 7])
    assert {path.split("batch_id=")[1].split("/")[0] for path in one.inputFiles()} == {"1"} and one.count() == 12


def test_a_lost_table_is_not_an_empty_one(spark, lake):
    for table in ("silver", "bronze"):
        gone = Lake(lake.base + "-elsewhere")
        with pytest.raises(Exception):
            gone.read_batches(spark, table, [0]).collect()
    with pytest.raises(Exception):
        Lake(lake.base + "-elsewhere").read_days(spark, "silver", ["2018-05-02"]).collect()


def test_partition_values(spark):
    df = spark.range(20).selectExpr("id % 3 as id")
    assert sorted(partition_values(df, "id")) == [0, 1, 2]
    assert sorted(partition_values(df, F.array("id", F.col("id") + 5))) == [0, 1, 2, 5, 6, 7]


def test_upload_to_serving(spark, lake, tmp_path):
    """One file of 250 good rows and a bad one, one of a header only, uploaded twice."""
    head = "region,origin_coord,destination_coord,datetime,datasource\n"
    line = "Prague,POINT (14.{n:03d} 50.0),POINT (14.5 50.1),2018-05-28 09:03:40,s1\n"
    folder = tmp_path / "csv"
    folder.mkdir()
    good = [line.format(n=n) for n in range(250)]
    (folder / "a.csv").write_text(head + "".join([*good[:100], "Prague,POINT (1)\n", *good[100:]]))
    (folder / "b.csv").write_text(head)
    loads = []
    for _ in range(2):
        loads.append(publish_uploads(spark, str(folder), lake))
        ingest(spark, lake, None)
        finish(start_serving(spark, lake, available_now=True))
    assert loads[0] != loads[1]
    assert lake.read(spark, "serving").count() == 250
    rows = lake.read(spark, "status").select("ingestion_id", "status", "rows", "stored_rows").collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.ingestion_id, []).append((r.status, r.rows, r.stored_rows))
    assert len(by_id) == 4
    full = [sorted(map(str, v)) for v in by_id.values() if ("IN_PROGRESS", 200, None) in v]
    assert len(full) == 2
    for statuses in by_id.values():
        names = [s for s, _, _ in statuses]
        for once in ("STARTED", "COMPLETED", "BRONZE_COMPLETED", "SILVER_COMPLETED", "TRIPS_PG_COMPLETED"):
            assert names.count(once) == 1
        assert names.count("IN_PROGRESS") in (0, 2)
    stored = sorted(n for v in by_id.values() for s, _, n in v if s == "TRIPS_PG_COMPLETED")
    assert stored == [0, 0, 0, 250]


def test_served_files_are_in_geohash_order(spark, lake):
    spread = [trip(n, origin_lon=float((n * 37) % 170), datetime="2018-05-28T00:00:00Z") for n in range(1, 200)]
    publish(spark, lake, spread)
    ingest(spark, lake)
    finish(start_serving(spark, lake, available_now=True))
    rows = (
        lake.read(spark, "serving")
        .select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), "origin_geohash")
        .orderBy("file", "at")
        .collect()
    )
    assert len(rows) == 199
    for left, right in zip(rows, rows[1:]):
        assert left.file != right.file or left.origin_geohash <= right.origin_geohash


class FakeSession:
    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_runs_live_in_the_shared_folder():
    shared = {"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/"}
    assert fresh_dir(FakeSession(**shared), "x").startswith("hdfs:///shared/tripweave/x-")
    with pytest.raises(RuntimeError):
        fresh_dir(FakeSession(**{"spark.master": "yarn"}), "x")
    with pytest.raises(RuntimeError):
        fresh_dir(FakeSession(**{"spark.master": "local-cluster[2,1,1024]"}), "x")
    local = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/warehouse"}
    assert fresh_dir(FakeSession(**local), "x").startswith("file:/warehouse/tripweave/x-")


def own_trip(n, day, **more):
    """A trip under the id that its own fields give."""
    base = trip(n, datetime=f"2018-05-{day:02d}T09:03:40Z", origin_lon=float(n % 90))
    places = ("origin_lon", "origin_lat", "destination_lon", "destination_lat")
    numbers = [f"{base[name]:.6f}" for name in places]
    text = "|".join([base["region"].lower(), *numbers, base["datetime"], base["datasource"]])
    return base | {"trip_id": hashlib.sha256(text.encode()).hexdigest()} | more


def test_bounded_state_loses_nothing_and_stays_small(spark, lake):
    days = {d: [own_trip(n, d) for n in range(10 * d, 10 * d + 6)] for d in range(1, 10)}
    held = [days[d].pop() for d in (2, 4, 8)]
    for d, trips in days.items():
        publish(spark, lake, trips + trips[:3], d)  # with copies in time
    publish(spark, lake, held, 30)  # first deliveries long after their time
    publish(spark, lake, [t for d in (1, 5, 9) for t in days[d]] + held, 31)  # copies, early and late
    publish(spark, lake, [own_trip(900, 9, trip_id="mine"), own_trip(901, 3, trip_id="mine")], 32)
    publish(spark, lake, [own_trip(902, 1, trip_id="mine"), own_trip(903, 9, trip_id="mine")], 33)
    events = event_log.file_stream(spark, lake.path("log"), 1)
    query = start_bounded_silver(spark, events, lake, "2 days", available_now=True)
    finish(query)
    own = [t["trip_id"] for d in days for t in days[d]] + [t["trip_id"] for t in held]
    assert ids(lake.read(spark, "silver")) == sorted([*own, "mine"])
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert len(sizes) >= 13 and max(sizes) <= 6 * 6


@pytest.mark.parametrize("most", [10_000, 0])
def test_an_ingestion_s_rows_are_counted_by_many_tasks(spark, monkeypatch, most):
    monkeypatch.setattr(completion, "MOST_BROADCAST", most)
    log = spark.range(0, 20_000, 1, 8).select(
        F.lit("i1").alias("ingestion_id"),
        F.col("id").alias("row_number"),
        F.concat(F.lit("t"), "id").alias("trip_id"),
        F.lit("trip").alias("route"),
    )
    ids = spark.createDataFrame([("i1",), ("i2",)], "ingestion_id string")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        sent = completion.sent_rows(completion.rows_of_ingestions(log, ids))
        per_task = sent.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name in small:
            spark.conf.unset(name)
    assert sum(row[1] for row in per_task) == 20_000
    assert max(row[1] for row in per_task) < 10_000


def test_a_merge_into_nothing_asks_for_nothing(spark, lake, plan_of):
    lake.create(spark)
    trips = spark.range(10).select(
        F.sha2(F.col("id").cast("string"), 256).alias("trip_id"),
        F.lit("2024-01-01").alias("trip_day"),
        F.current_timestamp().alias("kafka_timestamp"),
        F.col("id").alias("row_number"),
        F.lit("i1").alias("ingestion_id"),
    )
    fresh = routing.insert_by_day(trips, lambda days: lake.read_days(spark, "silver", days or []))
    assert "Join" not in plan_of(fresh)
    assert fresh.count() == 10


def test_a_large_log_file_has_many_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    digits = F.concat(*(F.sha2(F.concat("id", F.lit(f"-{n}")), 512) for n in range(8)))
    events = spark.range(0, 60_000, 1, 1).select(
        F.lit("i1").alias("key"), digits.alias("value"), F.current_timestamp().alias("timestamp")
    )
    event_log.append_events(events, str(tmp_path / "log"))
    (file,) = (tmp_path / "log").glob("*.parquet")
    metadata = pq.ParquetFile(file).metadata
    assert metadata.num_row_groups > 1
    assert metadata.row_group(0).column(1).compression == "ZSTD"


def test_landing_counts_apart_from_its_writing_pass(spark, lake, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refused(*_):
        raise AssertionError("counted row by row, without generated code")

    monkeypatch.setattr(DataFrame, "observe", refused)
    lake.create(spark)
    records = [trip(1), trip(2, origin_lon=999.0), marker("i1", -1), {"record_type": "other"}]
    flat = routing.decode(log_rows(spark, records))
    for batch_id, rows in enumerate((flat, flat.where("false"))):
        land_batch(spark, rows, batch_id, lake)
    counts = {r.name: r.rows for r in lake.read(spark, "landed_counts").collect()}
    assert {name: counts[name] for name in routing.ROUTES} == {
        "trip": 1, "rejected": 1, "marker": 1, "unknown": 1
    }
    assert counts["marker_total_rows_from_0"] == counts["known_record_type"] == 1


def test_bronze_is_written_without_a_sort_by_route(spark, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", {}
    overwrite = tables.overwrite_partitions

    def watched(df, path, columns, options=None):
        if columns == ("route",):
            seen[path] = df.sparkSession.conf.get(name)
        overwrite(df, path, columns, options)

    monkeypatch.setattr(tables, "overwrite_partitions", watched)
    lake = Lake(fresh_dir(spark, "routes")).create(spark)
    records = [trip(n) if n % 2 else trip(n, origin_lat=95.0) for n in range(20)]
    records += [marker("i1", 20), {"record_type": "other"}]
    before = spark.conf.get(name)
    land_batch(spark, routing.decode(log_rows(spark, records)).coalesce(1), 0, lake)
    assert seen == {lake.path("bronze") + "/batch_id=0": str(len(routing.ROUTES))}
    assert spark.conf.get(name) == before
    routes = lake.read(spark, "bronze").groupBy("route").count().collect()
    assert {r.route: r["count"] for r in routes} == {"trip": 10, "rejected": 10, "marker": 1, "unknown": 1}
    assert lake.read(spark, "rejected").count() == 10
