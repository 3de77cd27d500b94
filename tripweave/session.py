"""Session settings and the shared folder that written intermediate tables live in."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


#: What a task reads at most of files, and of shuffled rows where adaptive execution may choose:
#: about 150,000 log rows and 700,000 narrow ones.
MOST_OF_FILES = "spark.sql.files.maxPartitionBytes", 16 << 20
MOST_SHUFFLED = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 32 << 20
#: Parts that a shuffle is dealt into before adaptive execution merges small ones.
FIRST_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 1024


def configure(spark: SparkSession) -> SparkSession:
    """Pin the zone that weeks and buckets depend on, keep big state off the heap, and bound a
    task by bytes, so that with more rows there are more tasks and not larger ones."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    for name, most in (MOST_OF_FILES, MOST_SHUFFLED):
        spark.conf.set(name, min(most, size_in_bytes(spark.conf.get(name))))
    name, parts = FIRST_PARTS
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(name, max(parts, least, int(spark.conf.get(name, "1"))))
    return spark


def size_in_bytes(text: str) -> int:
    """A size setting such as ``64MB``, ``16m`` or ``67108864b``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)(?:i?b)?", text.strip().lower()).groups()
    return int(number) << (" kmgtp".index(unit or " ") * 10)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new base directory for one run: tables and checkpoints start together there.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one machine, may go without it: its runs then
    live under the warehouse directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tripweave/{label}-{uuid.uuid4().hex}"
