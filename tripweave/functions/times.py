"""Instants: parsing, the canonical UTC text, buckets and ISO weeks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar form of ISO 8601. The first pattern is what a cast reads as it stands; the second
# also takes a time cut short and offsets written +HH or +HHMM.
COMPLETE_INSTANT = (
    r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2}([T ][0-9]{2}:[0-9]{2}"
    r"(:[0-9]{2}([.,][0-9]{1,9})?(Z|[+-][0-9]{2}:[0-9]{2})?)?)?)?)?$"
)
SHORT_INSTANT = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2})(:[0-9]{2})?(:[0-9]{2}(?:[.,][0-9]{1,9})?)?"
    r"(?:(Z)|([+-][0-9]{2}):?([0-9]{2})?)?$"
)

MICROS_PER_MINUTE = 60_000_000


def _cast(text: Column) -> Column:
    return F.translate(text, ",", ".").try_cast("timestamp")


def _completed(text: Column) -> Column:
    def part(group: int, absent: str = "") -> Column:
        found = F.regexp_extract(text, SHORT_INSTANT, group)
        return F.when(found == "", absent).otherwise(found)

    offset = F.when(part(5) == "", part(4)).otherwise(
        F.concat(part(5), F.lit(":"), part(6, "00"))
    )
    return F.concat(part(1), part(2, ":00"), part(3, ":00"), offset)


def parse_instant(text: Column) -> Column:
    """Text to timestamp; a text without offset is UTC. NULL for anything else."""
    return F.when(text.rlike(COMPLETE_INSTANT), _cast(text)).when(
        text.rlike(SHORT_INSTANT), _cast(_completed(text))
    )


def instant_text(ts: Column) -> Column:
    """``2018-05-28T09:03:40Z``; six fraction digits only when they are not all zero."""
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )


def bucket_number(ts: Column, minutes: int = 30) -> Column:
    """Index of the bucket since the epoch: an integer grouping key."""
    width = F.lit(minutes * MICROS_PER_MINUTE)
    micros = F.unix_micros(ts)
    return F.call_function("div", micros - F.pmod(micros, width), width)


def bucket_start(number: Column, minutes: int = 30) -> Column:
    return F.timestamp_micros(number * F.lit(minutes * MICROS_PER_MINUTE))


def time_bucket(ts: Column, minutes: int = 30) -> Column:
    """Start of the fixed-width bucket an instant falls in (floor, also before 1970)."""
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(minutes * MICROS_PER_MINUTE)))


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def iso_year(ts: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), ts)


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week."""
    return F.date_trunc("week", ts)
