"""WKT points and coordinate predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The legal coordinate ranges, both ends included.
LON_RANGE = (-180.0, 180.0)
LAT_RANGE = (-90.0, 90.0)

# "POINT (lon lat)" in any letter case, the two tokens being plain decimal numbers.
NUMBER = r"([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
POINT = rf"^\s*[Pp][Oo][Ii][Nn][Tt][^()]*\(\s*{NUMBER}\s+{NUMBER}\s*\)"


def in_lon_range(lon: Column) -> Column:
    return lon.between(*LON_RANGE)


def in_lat_range(lat: Column) -> Column:
    return lat.between(*LAT_RANGE)


def point_lon(text: Column) -> Column:
    """Longitude of a WKT point; NULL where the text is not a two-number point."""
    return F.regexp_extract(text, POINT, 1).try_cast("double")


def point_lat(text: Column) -> Column:
    return F.regexp_extract(text, POINT, 2).try_cast("double")


def point_text(lon: Column, lat: Column) -> Column:
    """WKT of a point; NULL when either coordinate is."""
    return F.concat(
        F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")")
    )


def within_box(
    lon: Column, lat: Column, west: float, south: float, east: float, north: float
) -> Column:
    """Inside the box, its sides excluded. Corner order does not matter.

    Plain comparisons on plain double columns, so they reach the Parquet scan.
    """
    west, east = sorted((float(west), float(east)))
    south, north = sorted((float(south), float(north)))
    return (lon > west) & (lon < east) & (lat > south) & (lat < north)
