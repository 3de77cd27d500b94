"""Best-fit packing of token sequences after dominance reduction.

Encoding is a narrow pass over the documents. Packing needs only how many pieces there are of
each length, a histogram of at most ``capacity`` numbers that Spark counts: on it the plan is
made on the driver, whatever the data's size. The plan's rows say "the pieces of this length
from rank x on go to the sequences from number y on, at this offset"; there are a few for each
length, so they are broadcast, and every piece finds its row by its length and its rank among
the pieces of that length. Ranks come from counts per length and slice, not from one sorted
group per length.

The reduction fixes, from the longest piece down, sets that dominate all others with that
piece: the piece alone when nothing fits beside it, the pair that fills the sequence exactly,
the longest partner when only one more piece fits, and the longest partner when no sum of
several pieces exceeds it. Lengths without such a set are passed over and looked at again
after others were fixed, until nothing changes. What is left is packed best-fit by falling
length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.bpe import broadcast_file, codec
from tripweave.llm.common import arrow_rows, gives_back, written

#: Words a Python worker remembers before it drops those not met of late (about 80 MB).
MEMO_WORDS = 400_000
#: Characters of text that are cut into words at a time.
FLUSH_CHARS = 400_000
#: Rows of an Arrow batch: with Spark's 10,000 a worker holds about 130 MB more of texts.
BATCH_ROWS = 1_000
#: Slices that the pieces of one length are counted in, to rank them without sorting them all.
SLICES = 4096


class _Left:
    """Pieces still to be placed: counts by length, and the lengths in ascending order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {length: n for length, n in counts.items() if n > 0}
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.lengths.remove(length)

    def put_back(self, length: int) -> None:
        if length not in self.counts:
            self.counts[length] = 0
            bisect.insort(self.lengths, length)
        self.counts[length] += 1

    def longest_up_to(self, most: int) -> int | None:
        at = bisect.bisect_right(self.lengths, most)
        return self.lengths[at - 1] if at else None

    def least_sum(self, pieces: int) -> float:
        """The length of the shortest pieces together; infinite if there are not so many."""
        total = 0
        for length in self.lengths:
            n = min(pieces, self.counts[length])
            total, pieces = total + n * length, pieces - n
            if not pieces:
                return total
        return float("inf")

    def pair_between(self, low: int, high: int) -> bool:
        """Whether two pieces together have a length in (low, high]."""
        for length in self.lengths:
            other = self.longest_up_to(high - length)
            if other is None:
                return False
            if length + other > low and (other != length or self.counts[length] > 1):
                return True
            if other == length and self.counts[length] == 1:
                at = bisect.bisect_left(self.lengths, other)
                if at and length + self.lengths[at - 1] > low:
                    return True
        return False


def _dominating(left: _Left, length: int, capacity: int) -> tuple[int, ...] | None:
    """The set with a piece of this length that dominates all others with it, if one does."""
    room = capacity - length
    left.take(length, 1)  # one is set aside, so that partners are other pieces
    partner = left.longest_up_to(room)
    dominates = (
        partner is None
        or partner == room
        or left.least_sum(2) > room
        or (left.least_sum(3) > room and not left.pair_between(partner, room))
    )
    left.put_back(length)
    if not dominates:
        return None
    return (length,) if partner is None else (length, partner)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list, dict[int, int]]:
    """Sets that some best packing contains, as ``(lengths, times)``, and what is left."""
    left, fixed = _Left(counts), []
    changed = True
    while changed:
        changed = False
        for length in reversed(tuple(left.lengths)):
            while length in left.counts and (group := _dominating(left, length, capacity)):
                # What holds for one such set holds for the next: fewer pieces fit beside it.
                n = left.counts[length]
                if group == (length, length):
                    times = n // 2
                else:
                    times = min(left.counts[part] for part in group)
                for part in group:
                    left.take(part, times)
                fixed.append((group, times))
                changed = True
    return fixed, left.counts


def best_fit(counts: dict[int, int], capacity: int) -> list:
    """Best fit by falling length, whole runs of equal pieces and equal sequences at a time."""
    open_by_room: dict[int, list] = {}  # room left -> [(lengths so far, how many sequences)]
    rooms: list[int] = []

    def put(room: int, group: tuple, times: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            bisect.insort(rooms, room)
        open_by_room[room].append((group, times))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                group, times = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(at)
                used = min(n, times)
                if times > used:
                    put(room, group, times - used)
                put(room - length, (*group, length), used)
                n -= used
            else:
                each = capacity // length
                whole, rest = divmod(n, each)
                for size, times in ((each, whole), (rest, 1)):
                    if size and times:
                        put(capacity - size * length, (length,) * size, times)
                n = 0
    return [run for runs in open_by_room.values() for run in runs]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows ``(length, first rank, pieces, first sequence, offset)`` that place every piece.

    Pieces of ranks ``first .. first + pieces - 1`` of a length go to as many sequences in
    turn, all at the same offset.
    """
    fixed, rest = reduce_by_dominance(counts, capacity)
    rank = dict.fromkeys(counts, 0)
    sequence, rows = 0, []
    for group, times in fixed + best_fit(rest, capacity):
        offset = 0
        for length in group:
            rows.append((length, rank[length], times, sequence, offset))
            rank[length] += times
            offset += length
        sequence += times
    return rows


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)


@gives_back
def _piece_batches(
    batches: Iterator[pa.RecordBatch], file, capacity: int, end_id: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    coder = codec(file.value)
    end = np.array([end_id], "<u4").tobytes()

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
        names, texts, chars = [], [], 0
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            names.append(doc_id.as_py())
            texts.append(text.as_py() or "")
            chars += len(texts[-1])
            if chars > FLUSH_CHARS:
                yield names, texts
                names, texts, chars = [], [], 0
        yield names, texts

    for batch in batches:
        for names, texts in groups(batch):
            rows = []
            for name, ids in zip(names, coder.encode_many(texts, MEMO_WORDS)):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    own = part if with_ids else None
                    rows.append((name, piece, start // 4, len(part) // 4, zlib.crc32(part), own))
            if rows:
                yield _piece_batch(rows)


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), _PIECES)]
    return pa.RecordBatch.from_arrays(columns, schema=_PIECES)


def token_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_column: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, each document closed by
    ``end_id``. NULL and empty text are the end id alone."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string")).mapInArrow(
        partial(
            _piece_batches,
            file=broadcast_file(docs, path),
            capacity=capacity,
            end_id=end_id,
            with_ids=with_ids,
        ),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary",
    )


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_column: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there, gapless from 0.

    Only documents longer than ``capacity`` are cut. Rows that repeat, or have no id, are
    documents of their own; of equal pieces of equal ids any takes any place. An empty table
    gives an empty result. Other columns of the input are not read.
    """
    spark = docs.sparkSession
    pieces = token_pieces(docs, path, capacity, end_id, id_column, text, with_ids)
    # A row number gives each piece its slice and its place there. It may be another one when
    # a task runs again, so the pieces are written with it before anything is ranked.
    numbered = pieces.withColumn("number", F.monotonically_increasing_id())
    sliced = numbered.withColumn("slice", F.pmod(F.xxhash64("number"), F.lit(SLICES)).cast("int"))
    with arrow_rows(spark, BATCH_ROWS):
        pieces = written(sliced.drop(*([] if with_ids else ["ids"])), "packing-pieces")
    counts = pieces.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("pieces"))
    histogram = {r.length: r.pieces for r in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    rows = plan(histogram, capacity)
    by_length = T.StructType(
        [T.StructField(name, T.LongType()) for name in ("length", "first", "pieces", "sequence", "offset")]
    )
    # Ranks: slices of a length follow each other; inside a slice by id.
    before = F.sum("pieces").over(Window.partitionBy("length").orderBy("slice")) - F.col("pieces")
    slices = counts.select("length", "slice", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "slice").orderBy("number"))
    ranked = (
        pieces.withColumn("inside", inside - 1)
        .join(slices, ["length", "slice"])
        .withColumn("rank", F.col("before") + F.col("inside"))
    )
    # Plan rows of a length, in order of rank; the last that begins at or before a rank holds.
    planned = (
        spark.createDataFrame(rows, by_length)
        .groupBy("length")
        .agg(F.sort_array(F.collect_list(F.struct("first", "sequence", "offset"))).alias("plan"))
    )
    place = F.element_at(
        F.filter("plan", lambda row: row["first"] <= F.col("rank")), -1
    )
    return (
        ranked.join(F.broadcast(planned), "length")
        .withColumn("place", place)
        .select(
            F.col("doc_id").alias(id_column),
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("place.sequence") + F.col("rank") - F.col("place.first")).alias("sequence_id"),
            F.col("place.offset").alias("offset"),
            *(["ids"] if with_ids else []),
        )
    )
