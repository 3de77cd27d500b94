"""What a task reads is bounded by bytes, whatever the number of shuffle partitions."""

import pytest
from pyspark.sql import functions as F

from tripweave.operators.dedup import first_wins
from tripweave.session import FIRST_PARTS, MOST_OF_FILES, MOST_SHUFFLED, configure, size_in_bytes


@pytest.fixture
def own(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "2")
    return session


def test_more_rows_have_more_tasks(own):
    configure(own).conf.set(MOST_SHUFFLED[0], "64k")
    rows = own.range(300_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("trip_id"), F.col("id").alias("row_number")
    )
    first = first_wins(rows, order=["row_number"])
    assert first.rdd.getNumPartitions() > 2
    assert first_wins(rows.limit(10), order=["row_number"]).rdd.getNumPartitions() <= 2


def test_smaller_settings_stay(own):
    own.conf.set(MOST_OF_FILES[0], "1m")
    own.conf.set(FIRST_PARTS[0], "3000")
    configure(configure(own))
    found = [own.conf.get(name) for name, _ in (MOST_OF_FILES, MOST_SHUFFLED, FIRST_PARTS)]
    assert found == [str(1 << 20), str(32 << 20), "3000"]


def test_sizes():
    sizes = ["134217728b", "64MB", "64m", "1KiB", "7", "2g"]
    assert list(map(size_in_bytes, sizes)) == [1 << 27, 1 << 26, 1 << 26, 1024, 7, 1 << 31]
