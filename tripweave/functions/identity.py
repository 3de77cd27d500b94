"""Content identity of a trip: the canonical texts and their digest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.functions.times import instant_text

# Fixed value: six decimals, no grouping.
SIX_DECIMALS = "0.000000"


def six_decimals(x: Column) -> Column:
    """``%.6f`` of a double, rounded on its exact binary value with ties to even.

    ``format_number`` rounds that way; ``format_string`` would round the shortest decimal
    text half up, which differs on the seventh decimal.
    """
    return F.call_function("format_number", x, F.lit(SIX_DECIMALS))


# The characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def folded(text: Column) -> Column:
    """Outer white space of any kind removed, lower case."""
    return F.lower(F.trim(text, F.lit(WHITE_SPACE)))


def trip_id(
    region: Column,
    origin_lon: Column,
    origin_lat: Column,
    destination_lon: Column,
    destination_lat: Column,
    instant: Column,
    datasource: Column,
) -> Column:
    """sha-256 over the seven canonical fields; NULL as soon as one of them is."""
    # Field order and separator of the hashed text.
    parts = [
        folded(region),
        six_decimals(origin_lon),
        six_decimals(origin_lat),
        six_decimals(destination_lon),
        six_decimals(destination_lat),
        instant_text(instant),
        folded(datasource),
    ]
    text = parts[0]
    for part in parts[1:]:
        text = F.concat(text, F.lit("|"), part)
    return F.sha2(text, 256)


def control_id(ingestion_id: Column) -> Column:
    return F.concat(ingestion_id, F.lit(":end"))
