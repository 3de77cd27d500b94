"""Headline timings as one JSON line.

Tables: $BENCH_SF_DIR (default /root/testdata/sf0.1), cores: $BENCH_CPUS (default 8).
Each query runs once to warm up, then the better of two runs counts; results are written
to the no-op sink, so whole results are computed. The stream runs once, from an empty lake.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from tripweave.operators import clusters as cl
from tripweave.operators import dedup, regions, routing, weekly
from tripweave.plans import event_trips as source
from tripweave.plans import pipeline
from tripweave.plans.catalog import BOX, QUERIES, REGION
from tripweave.session import configure, fresh_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# Files of the tables that the bench writes for itself, so that scans use every core.
FILES = 16

REGISTERED = [
    "geohash_cells",
    "trip_ids",
    "silver_trips",
    "dedup_first_wins",
    "merge_insert",
    "clusters",
    "top_clusters",
    "weekly_metrics_by_year",
    "weekly_average_region",
    "weekly_average_bbox",
    "weekly_average_all",
    "latest_source_top_regions",
    "ingestion_completion",
    "completion_unnumbered",
    "csv_uploads",
    "csv_mixed_headers",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tripweave-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def seconds(build) -> float:
    begin = time.perf_counter()
    df = build()
    if isinstance(df, DataFrame):
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def best(build) -> float:
    seconds(build)
    return min(seconds(build), seconds(build))


def stored_tables(spark: SparkSession) -> str:
    """A silver table on disk, as the questions meet it in use."""
    path = fresh_dir(spark, "bench-stored")
    source.valid_trips(spark, SF_DIR).repartition(FILES).write.parquet(path)
    return path


def redeliver_a_tenth(spark: SparkSession, path: str) -> DataFrame:
    """The trips of three of the thirty days, a tenth, against the whole stored table."""
    stored = spark.read.parquet(path)
    again = stored.where("datetime < '2024-01-04'").withColumnRenamed("datetime", "kafka_timestamp")
    return dedup.insert_new(again, stored)


def main() -> None:
    spark = session()
    rows = source.table(spark, SF_DIR, "events").count()
    timed = {name: best(lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in REGISTERED}
    path = stored_tables(spark)

    def stored() -> DataFrame:
        return spark.read.parquet(path)

    timed["stored_clusters"] = best(lambda: cl.cluster_counts(stored()))
    timed["stored_weekly_metrics"] = best(lambda: weekly.weekly_metrics(stored()))
    timed["stored_average_region"] = best(lambda: weekly.weekly_average(stored(), region=REGION))
    timed["stored_average_bbox"] = best(lambda: weekly.weekly_average(stored(), box=BOX))
    timed["stored_latest_source"] = best(lambda: regions.latest_source(stored()))
    timed["stored_redelivery"] = best(lambda: redeliver_a_tenth(spark, path))

    log = fresh_dir(spark, "bench-log")
    source.first_delivery(spark, SF_DIR).repartition(FILES).write.parquet(log)
    timed["silver_build"] = best(
        lambda: dedup.first_wins(
            routing.trips(routing.with_trip_day(routing.route(routing.decode(spark.read.parquet(log)))))
        )
    )
    timed["stream_ingest_and_clusters"] = seconds(lambda: pipeline.run(spark, SF_DIR, "clusters"))

    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in timed.items()},
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "rows_per_second": {
                    "silver_build": round(rows / timed["silver_build"]),
                    "redelivery": round(rows / 10 / timed["stored_redelivery"]),
                    "geohash": round(2 * rows / timed["geohash_cells"]),
                    "stream_ingest_and_clusters": round(
                        2 * rows / timed["stream_ingest_and_clusters"]
                    ),
                },
                "conf": {
                    "master": f"local[{CPUS}]",
                    "spark.sql.shuffle.partitions": CPUS,
                    "spark.driver.memory": "12g",
                },
            }
        )
    )


if __name__ == "__main__":
    main()
