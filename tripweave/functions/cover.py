"""A box as few ranges of geohash cells.

Geohash texts of one length sort like the numbers they spell, and a quadtree node is a range of
them. So a box is covered by ranges: nodes wholly inside it, whose rows need no look at their
coordinates, and nodes on its border, whose rows do. Ranges are plain comparisons on a text
column: where a table is in geohash order, scans skip the row groups outside them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.functions.cells import ALPHABET, MAX_PRECISION
from tripweave.functions.points import within_box

#: Nodes are refined while there are at most so many ranges.
MOST_RANGES = 48
#: A cell's sides as computed for a row may be off by rounding: a node counts as inside, or as
#: outside, only with this much room (degrees; far below the side of the smallest cell).
ROOM = 1e-9

Box = tuple[float, float, float, float]


def range_text(number: int, precision: int) -> str:
    """The geohash text that a number of ``5 * precision`` interleaved bits spells."""
    return "".join(ALPHABET[(number >> 5 * (precision - 1 - i)) & 31] for i in range(precision))


@dataclass(frozen=True)
class Range:
    """Cells from ``first`` to ``last``, both included; ``inside`` if all of them are."""

    first: str
    last: str
    inside: bool

    def holds(self, cell: Column) -> Column:
        return cell.between(self.first, self.last)


def _side(index: int, bits: int, low: float, span: float) -> tuple[float, float]:
    """A slice of an axis. Coordinates past an end are in the end's slice."""
    start = low + span * index / 2**bits if index else -math.inf
    end = low + span * (index + 1) / 2**bits if index + 1 < 2**bits else math.inf
    return start, end


def _place(depth: int, lon: int, lat: int, box: Box) -> str:
    """Whether a node is ``out`` of the open box, ``in`` it, or on its ``border``."""
    west, south, east, north = box
    left, right = _side(lon, (depth + 1) // 2, -180.0, 360.0)
    bottom, top = _side(lat, depth // 2, -90.0, 180.0)
    if right < west - ROOM or left > east + ROOM or top < south - ROOM or bottom > north + ROOM:
        return "out"
    if (
        left > west + ROOM and right < east - ROOM and bottom > south + ROOM and top < north - ROOM
    ):
        return "in"
    return "border"


def _merged(nodes: list[tuple[int, int, bool]]) -> list[tuple[int, int, bool]]:
    """Ranges [start, end) in order, neighbours of one kind joined."""
    out: list[tuple[int, int, bool]] = []
    for start, end, inside in sorted(nodes):
        if out and out[-1][1] == start and out[-1][2] == inside:
            out[-1] = (out[-1][0], end, inside)
        else:
            out.append((start, end, inside))
    return out


def cover(box: Box, precision: int, most: int = MOST_RANGES) -> list[Range]:
    """Ranges of geohash cells that hold every point inside the box, its sides excluded.

    Corners may come in any order. All border nodes are split, one bit at a time, as long as
    the ranges stay few; the depth of a whole cell is the last.
    """
    if not 1 <= precision <= MAX_PRECISION:
        raise ValueError(f"precision must be 1..{MAX_PRECISION}, got {precision}")
    west, east = sorted((float(box[0]), float(box[2])))
    south, north = sorted((float(box[1]), float(box[3])))
    sides = (west, south, east, north)
    total = 5 * precision
    done: list[tuple[int, int, bool]] = []
    open_nodes = [(0, 0, 0)]  # number of the node's bits so far, lon index, lat index
    ranges = [(0, 2**total, False)]
    for depth in range(1, total + 1):
        inner, border, room = list(done), [], total - depth
        for number, lon, lat in open_nodes:
            for bit in (0, 1):
                child = (
                    (number << 1 | bit, lon << 1 | bit, lat)
                    if depth % 2
                    else (number << 1 | bit, lon, lat << 1 | bit)
                )
                place = _place(depth, child[1], child[2], sides)
                if place == "in":
                    inner.append((child[0] << room, (child[0] + 1) << room, True))
                elif place == "border":
                    border.append(child)
        edges = [(n << room, (n + 1) << room, False) for n, _, _ in border]
        refined = _merged(inner + edges)
        if len(refined) > most:
            break
        done, open_nodes, ranges = inner, border, refined
    return [
        Range(range_text(a, precision), range_text(b - 1, precision), inside)
        for a, b, inside in ranges
    ]


def any_range(ranges: list[Range], cell: Column) -> Column:
    return reduce(lambda a, b: a | b, (r.holds(cell) for r in ranges), F.lit(False))


def within_box_by_cells(
    cell: Column, lon: Column, lat: Column, box: Box, precision: int, most: int = MOST_RANGES
) -> Column:
    """Inside the box, its sides excluded, for rows that know their cell: coordinates are
    compared in border cells alone."""
    ranges = cover(box, precision, most)
    inside = [r for r in ranges if r.inside]
    border = [r for r in ranges if not r.inside]
    return any_range(inside, cell) | (any_range(border, cell) & within_box(lon, lat, *box))
