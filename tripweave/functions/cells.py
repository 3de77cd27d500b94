"""Geohash cells as plain column arithmetic.

A cell is first held as one long: the longitude index in the high bits, the latitude
index in the low bits. That number identifies the cell, so jobs group by it and turn it
into base-32 text only after the aggregation. The text needs no bit interleaving: one
base-32 symbol takes three bits of one axis and two of the other, so it is a lookup in a
32-symbol string permuted for that split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

MAX_PRECISION = 12


def _symbol_table() -> str:
    """Symbol at index ``major * 4 + minor`` for a 3-bit and a 2-bit axis chunk."""
    table = []
    for major in range(8):
        for minor in range(4):
            a, b, c = (major >> 2) & 1, (major >> 1) & 1, major & 1
            d, e = (minor >> 1) & 1, minor & 1
            table.append(ALPHABET[a << 4 | d << 3 | b << 2 | e << 1 | c])
    return "".join(table)


SYMBOLS = _symbol_table()


def _axis_bits(precision: int) -> tuple[int, int]:
    if not 1 <= precision <= MAX_PRECISION:
        raise ValueError(f"precision must be 1..{MAX_PRECISION}, got {precision}")
    bits = precision * 5
    return bits - bits // 2, bits // 2


def _axis_index(value: Column, low: float, span: float, bits: int) -> Column:
    """Index of the slice of the axis; values past an end fall into the end slice."""
    steps = (value - F.lit(low)) / F.lit(span) * F.lit(float(2**bits))
    clamped = F.least(F.greatest(steps, F.lit(0.0)), F.lit(float(2**bits - 1)))
    return F.floor(F.when(value.isNotNull() & ~F.isnan(value), clamped))


def cell_number(lon: Column, lat: Column, precision: int = 7) -> Column:
    """The cell as a long; NULL when a coordinate is NULL or NaN."""
    lon_bits, lat_bits = _axis_bits(precision)
    return F.shiftleft(_axis_index(lon, -180.0, 360.0, lon_bits), lat_bits).bitwiseOR(
        _axis_index(lat, -90.0, 180.0, lat_bits)
    )


def cell_text(number: Column, precision: int = 7) -> Column:
    """Base-32 geohash text of a cell number of the same precision."""
    lon_bits, lat_bits = _axis_bits(precision)
    symbols = []
    for i in range(precision):
        lon_taken = (5 * (i + 1) + 1) // 2
        lat_taken = 5 * (i + 1) // 2
        lon_chunk = F.shiftright(number, lat_bits + lon_bits - lon_taken)
        lat_chunk = F.shiftright(number, lat_bits - lat_taken)
        major, minor = (lon_chunk, lat_chunk) if i % 2 == 0 else (lat_chunk, lon_chunk)
        index = F.shiftleft(major.bitwiseAND(F.lit(7)), 2).bitwiseOR(
            minor.bitwiseAND(F.lit(3))
        )
        symbols.append(F.substring(F.lit(SYMBOLS), (index + 1).cast("int"), F.lit(1)))
    return F.concat(*symbols)


def geohash(lon: Column, lat: Column, precision: int = 7) -> Column:
    return cell_text(cell_number(lon, lat, precision), precision)
