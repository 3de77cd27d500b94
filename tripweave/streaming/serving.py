"""Silver -> serving store: insert-if-absent trips, name lookups, completion statuses."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave import schemas
from tripweave.operators import routing
from tripweave.operators.clusters import instant_of
from tripweave.operators.completion import completion_report, rows_of_ingestions
from tripweave.operators.dedup import insert_new
from tripweave.operators.dimensions import extend_dimension, serving_rows
from tripweave.sources.lake import COMPACTED, Lake
from tripweave.sources.tables import partition_values, write_batch, write_by_day
from tripweave.streaming.answers import CELL_COUNTS
from tripweave.streaming.gold import landed_batches
from tripweave.streaming.runner import start, with_retry
from tripweave.streaming.status import watch_failures

#: Foreign ids of one batch that a database is asked for by name, and ids in one question.
MOST_IDS = 50_000
IDS_PER_QUERY = 400

LOOKUPS = {"regions": ("region", "region_id"), "datasources": ("datasource", "datasource_id")}


@dataclass(frozen=True)
class LakeStore:
    """The serving trips as a lake table, each day's files in geohash order: near trips are
    near in the file, and a box skips the row groups it does not touch."""

    lake: Lake

    def rows_of(
        self, spark: SparkSession, days: list[str] | None, before: int | None = None
    ) -> DataFrame:
        if days is None:
            return self.lake.read(spark, "serving", before)
        return self.lake.read_days(spark, "serving", days, before)

    def fresh(self, spark: SparkSession, trips: DataFrame, batch_id: int) -> DataFrame:
        """The trips that no earlier batch has stored."""
        return routing.insert_by_day(trips, lambda days: self.rows_of(spark, days, batch_id))

    def holding(self, spark: SparkSession, trips: DataFrame) -> DataFrame:
        """The stored rows of these trips' ids: in the days that can have them, and for ids made
        by another rule everywhere, which they alone are looked up in."""
        return routing.stored_of(trips, lambda days: self.rows_of(spark, days))

    def insert(self, rows: DataFrame, batch_id: int) -> None:
        write_by_day(
            rows.hint("rebalance", "trip_day"),
            self.lake.path("serving"),
            batch_id,
            ordered_by=COMPACTED["serving"],
        )

    def count(self, spark: SparkSession, batch_id: int) -> None:
        """Keep the counts that box and region answers are made of."""
        CELL_COUNTS.add(spark, self.lake, [batch_id])


@dataclass(frozen=True)
class JdbcStore:
    """The serving trips in a database. Executors write their own partitions.

    Rows of an interrupted attempt are in the table when the batch runs again, so the insert adds
    only what is missing. An id made from the trip's own fields is looked for in the hours that
    the batch's trips touch; any other id by itself, wherever its row may be.
    """

    url: str
    table: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)
    connect_timeout: int = 15
    socket_timeout: int = 30

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "driver": self.driver,
            "connectTimeout": str(self.connect_timeout),
            "socketTimeout": str(self.socket_timeout),
            **self.properties,
        }

    def hours(self, trips: DataFrame) -> list[str]:
        """Conditions that split the trips' time span into parts to read in parallel. A copy
        of a trip has the trip's instant, so no other row of the table can be one."""
        parts = trips.select(F.date_trunc("hour", instant_of(trips)).alias("hour")).distinct()
        column = "datetime"
        return [
            f"{column} >= '{row.hour}' and {column} < '{row.hour + timedelta(hours=1)}'"
            for row in parts.where("hour is not null").orderBy("hour").collect()
        ]

    def foreign_ids(self, trips: DataFrame) -> list[str]:
        """Conditions that find the trips whose ids say nothing of their instant: by id, a few
        hundred at a time; or all ids, by their first character, where these are very many."""
        foreign = trips.where(F.col("trip_day").startswith(routing.FOREIGN))
        ids = [r.trip_id for r in foreign.select("trip_id").distinct().limit(MOST_IDS + 1).collect()]
        if len(ids) > MOST_IDS:
            edges = [None, *"123456789abcdefghijklmnopqrstuvwxyz", None]
            return [
                " and ".join(
                    filter(None, [a and f"trip_id >= '{a}'", b and f"trip_id < '{b}'"])
                )
                for a, b in zip(edges, edges[1:])
            ]
        quoted = ["'" + i.replace("'", "''") + "'" for i in sorted(ids)]
        groups = [quoted[i : i + IDS_PER_QUERY] for i in range(0, len(quoted), IDS_PER_QUERY)]
        return [f"trip_id in ({', '.join(group)})" for group in groups]

    def holding(self, spark: SparkSession, trips: DataFrame) -> DataFrame:
        """The part of the table that can hold these trips: one task for each hour of trips with
        ids of their own, and for each group of other ids."""
        url, properties = self.url, {k: str(v) for k, v in self.options().items()}
        own = trips.where(~F.col("trip_day").startswith(routing.FOREIGN))
        hours = self.hours(own) or ["1 = 0"]
        found = spark.read.jdbc(url, self.table, predicates=hours, properties=properties)
        ids = self.foreign_ids(trips)
        if not ids:
            return found
        others = spark.read.jdbc(url, self.table, predicates=ids, properties=properties)
        return found.unionByName(others).dropDuplicates(["trip_id"])

    def count(self, spark: SparkSession, batch_id: int) -> None:
        """A database counts for itself."""

    def fresh(self, spark: SparkSession, trips: DataFrame, batch_id: int) -> DataFrame:
        return insert_new(trips, self.holding(spark, trips))

    def insert(self, rows: DataFrame, batch_id: int) -> None:
        rows.drop("trip_day").write.format("jdbc").options(**self.options()).mode("append").save()


def jdbc_appender(store: JdbcStore):
    """A sink for cluster snapshots: the changed groups of each batch appended with its
    number, as a history of which the newest batch's row per cluster counts.

    A plain append may leave rows of a half-written attempt, so it is not tried again here;
    the query fails and its next run writes the batch again. Rows of one batch that stand
    twice are equal and change no newest row.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        store.insert(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id)

    return append


def serve_batch(
    spark: SparkSession, touched: DataFrame, batch_id: int, lake: Lake, store
) -> None:
    landed = partition_values(touched, "batch_id")
    trips = lake.read_batches(spark, "silver", landed).drop("batch_id")
    rows = serving_rows(store.fresh(spark, trips, batch_id)).withColumn(
        "ingested_at", F.current_timestamp()
    )
    with_retry(lambda: store.insert(rows, batch_id))
    store.count(spark, batch_id)
    for table, (column, id_name) in LOOKUPS.items():
        known = lake.read(spark, table, before=batch_id)
        write_batch(
            extend_dimension(trips, column, id_name, known), lake.path(table), batch_id
        )
    report_completion(spark, lake, store, batch_id)


def report_completion(spark: SparkSession, lake: Lake, store, batch_id: int) -> None:
    """Check every open marker and write the statuses of those now complete.

    A running count of arrivals says which ingestions can be complete at all. Only their
    log rows are read, from the directories of the batches they arrived in, and of the store
    only the ids that these rows have.
    """
    done = lake.read(spark, "status", before=batch_id).where(
        F.col("status") == schemas.TRIPS_PG_COMPLETED
    )
    open_markers = lake.read(spark, "markers").join(
        done.select("ingestion_id"), "ingestion_id", "left_anti"
    )
    arrivals = lake.read(spark, "arrivals").join(
        open_markers.select("ingestion_id"), "ingestion_id", "left_semi"
    )
    arrived = arrivals.groupBy("ingestion_id").agg(F.sum("received").alias("received"))
    # A marker is a log row as well, so what arrived exceeds what it announces.
    ready = open_markers.join(arrived, "ingestion_id").where("received > total_rows")
    if ready.isEmpty():
        return
    ids = ready.select("ingestion_id").distinct()
    batches = partition_values(arrivals.join(ids, "ingestion_id", "left_semi"), "batch_id")
    log = lake.read_batches(spark, "bronze", batches).where("route in ('trip', 'rejected')")
    sent = rows_of_ingestions(log, ids)
    stored = store.holding(spark, sent.where("route = 'trip'"))
    report = completion_report(ready, sent, stored).where("complete")
    lake.write_status(report, schemas.TRIPS_PG_COMPLETED, "serving", batch_id)


def start_serving(
    spark: SparkSession,
    lake: Lake,
    store=None,
    max_files: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    target = store or LakeStore(lake)
    watch_failures(spark, lake)
    return start(
        landed_batches(spark, lake, max_files),
        lambda batch, batch_id: serve_batch(spark, batch, batch_id, lake, target),
        "serving",
        lake.checkpoint("serving"),
        available_now=available_now,
    )
