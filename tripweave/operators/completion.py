"""Is everything an end marker announced accounted for?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Ingestions whose rows are picked by a broadcast of their ids.
MOST_BROADCAST = 10_000


def rows_of_ingestions(log: DataFrame, ids: DataFrame) -> DataFrame:
    """The log rows of these ingestions, dealt over tasks as the log is.

    Joined by a shuffle, all rows of an ingestion would meet in one task, and the aggregates that
    follow, whose keys have the ingestion in them, would be content with that and stay there. So
    the ids are broadcast; where they are very many, the joined rows are dealt anew.
    """
    if ids.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        return log.join(F.broadcast(ids), "ingestion_id", "left_semi")
    return log.join(ids, "ingestion_id", "left_semi").hint("rebalance")


def sent_rows(routed: DataFrame) -> DataFrame:
    """The distinct rows each ingestion sent, however often the log delivered them.

    A row is known by its number; one without a number by a digest of its whole payload,
    which a routed log carries.
    """
    payload = F.col("raw_payload") if "raw_payload" in routed.columns else F.lit(None)
    unnumbered = F.when(F.col("row_number").isNull(), F.sha2(payload.cast("string"), 256))
    return (
        routed.where("route in ('trip', 'rejected')")
        .select("ingestion_id", "row_number", "trip_id", "route", unnumbered.alias("payload"))
        .distinct()
    )


def accounted_rows(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``ingestion_id, held, rejected``: counts, in parts, of valid rows whose trip is stored, by
    this ingestion or an earlier one, and of rejected rows.

    Rows are counted per ingestion and trip before the join, so the many rows of an often
    repeated trip meet the stored ids as one row per ingestion. Rejected rows, which may
    have no id at all, are only counted.
    """
    trip = F.when(F.col("route") == "trip", F.col("trip_id"))
    per_trip = rows.groupBy("ingestion_id", trip.alias("trip_id")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    held = per_trip.where("trip_id is not null").join(
        stored.select("trip_id"), "trip_id", "left_semi"
    )
    rejected = per_trip.where("trip_id is null")
    none = F.lit(0).cast("long")
    return held.select("ingestion_id", F.col("rows").alias("held"), none.alias("rejected")).unionByName(
        rejected.select("ingestion_id", none.alias("held"), F.col("rows").alias("rejected"))
    )


def completion_report(markers: DataFrame, routed: DataFrame, stored: DataFrame) -> DataFrame:
    """Per marker: announced, stored, duplicate and rejected rows, and whether complete.

    Complete means stored + duplicate + rejected >= announced, so a file delivered twice
    completes as well. Everything known of an ingestion meets in one aggregate, to which each
    task sends a row for each ingestion it has seen.
    """
    nothing = {name: F.lit(0).cast("long") for name in ("stored", "held", "rejected")}
    nothing |= {"total_rows": F.lit(None).cast("long"), "announced": F.lit(False)}

    def part(df: DataFrame, **known: Column) -> DataFrame:
        return df.select("ingestion_id", *(c.alias(name) for name, c in (nothing | known).items()))

    parts = (
        part(markers, total_rows=F.col("total_rows").cast("long"), announced=F.lit(True))
        .unionByName(part(stored, stored=F.lit(1).cast("long")))
        .unionByName(
            part(
                accounted_rows(sent_rows(routed), stored),
                held=F.col("held"),
                rejected=F.col("rejected"),
            )
        )
    )
    sums = parts.groupBy("ingestion_id").agg(
        F.max("total_rows").alias("total_rows"),
        F.max("announced").alias("announced"),
        *(F.sum(name).alias(f"{name}_rows") for name in ("stored", "held", "rejected")),
    )
    return sums.where("announced").select(
        "ingestion_id",
        "total_rows",
        "stored_rows",
        (F.col("held_rows") - F.col("stored_rows")).alias("duplicate_rows"),
        "rejected_rows",
        (F.col("held_rows") + F.col("rejected_rows") >= F.col("total_rows")).alias("complete"),
    )
