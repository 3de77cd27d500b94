"""Jaccard join of documents on word n-grams by parity sketches.

A document is the set of its distinct shingles (64-bit hashes). Toggling one bit per shingle
gives a parity sketch, and two sketches differ in at most as many bits as the sets differ in
elements. A pair of sizes a and b that reaches the threshold differs in at most
``(a + b) * (100 - percent) / (100 + percent)`` elements. Sizes fall into bands so narrow that
such a pair lies in one band or in two neighbours; every pair of neighbouring bands has its own
sketch of more segments than that bound, so at least one segment of two similar documents is
equal (pigeonhole), and enough more that it is not an empty one. Equal segments are the join
key; nothing similar is lost.

The rest is about what is not similar: identical sets are one node; each key links its members
to one leader of the key first; only keys whose members are then not all under one label are
compared block by block, inside tasks, on whole sketches. A block in which few pairs are near
returns these pairs, at most a few for each member, to be verified on the sets themselves; a
dense block gets its members' sets, verifies inside and returns a forest of true links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import among, gives_back, written
from tripweave.llm.components import components

#: Word hashes that a Python worker remembers before it starts afresh (about 60 MB).
MEMO_WORDS = 400_000
#: Rows of one side of a block of members that are compared inside one task.
BLOCK = 2048
#: Near pairs for each member that a block returns as rows; with more it is a dense one.
PAIRS_A_MEMBER = 4
#: Sketch bits per shingle (rounded up to a power of two).
BITS = 4


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of a UTF-8 text.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer words than ``width`` are
    one shingle; no word is the empty set.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width_here = min(width, len(words))
    count = len(words) - width_here + 1
    total = np.full(count, width_here, np.uint64)
    for at in range(width_here):
        total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[at : at + count])
    return np.unique(total)


def size_bands(percent: int, largest: int = 1 << 40) -> list[int]:
    """Lower limits of the bands: a pair of sizes that can reach the threshold lies in one
    band or in two neighbours."""
    limits = [1]
    while limits[-1] <= largest:
        limits.append(max(limits[-1] + 1, (limits[-1] - 1) * 100 // percent + 1))
    return [*limits, limits[-1] * 2]


def segment_count(smallest: int, bound: int) -> int:
    """Segments for sets of at least ``smallest`` shingles that differ in up to ``bound``.

    Bound + 1 leave one segment untouched, but it may be an empty one, which says nothing. So
    there are more, by what a set's empty segments are expected to be and five deviations: a
    set with fewer empty segments than it has segments to spare shares a filled one with
    every similar set.
    """
    count = bound + 1
    while bound:
        empty = count * math.exp(-smallest / count)
        if count - bound > empty + 5 * math.sqrt(empty) + 1:
            break
        count += 1
        if count > 4 * (bound + 1):
            break
    return count


def _segments(sets: np.ndarray, count: int) -> np.ndarray:
    """For each segment the parity of its shingles: 32 one-bit toggles beside the XOR of 32
    hash bits. The set is sorted, so a segment, a range of hashes, is one slice."""
    place = ((sets >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    toggles = np.uint64(1) << ((sets & np.uint64(31)) + np.uint64(32))
    values = toggles | ((sets >> np.uint64(5)) & np.uint64(0xFFFFFFFF))
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    out = np.zeros(count, np.uint64)
    out[place[starts]] = np.bitwise_xor.reduceat(values, starts)
    return out


def _sketch(sets: np.ndarray) -> np.ndarray:
    """A parity sketch of a power of two of bits, at least ``BITS`` per shingle."""
    bits = 1 << max(6, (BITS * len(sets) - 1).bit_length())
    at = sets & np.uint64(bits - 1)
    odd = np.bincount(at.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch that fewer bits would have given: halves XORed, so the bound still holds."""
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _bound(a, b, percent: int):
    return (a + b) * (100 - percent) // (100 + percent)


_SKETCHED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("size", pa.int64()),
        ("print_a", pa.int64()),
        ("print_b", pa.int64()),
        ("low_band", pa.int64()),
        ("low", pa.list_(pa.int64())),
        ("high", pa.list_(pa.int64())),
        ("sketch", pa.binary()),
        ("low_all", pa.bool_()),
        ("high_all", pa.bool_()),
    ]
)
_SKETCHED_DDL = (
    "doc_id long, size long, print_a long, print_b long, low_band long,"
    " low array<long>, high array<long>, sketch binary, low_all boolean, high_all boolean"
)


@gives_back
def _sketch_batches(
    batches: Iterator[pa.RecordBatch], width: int, percent: int
) -> Iterator[pa.RecordBatch]:
    limits = np.array(size_bands(percent), dtype=np.int64)
    counts = lru_cache(maxsize=None)(segment_count)
    seen: set[int] = set()  # sets whose parts this task has given already: copies need none
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            found = shingles(text.as_py(), width)
            size = len(found)
            row = [doc_id.as_py(), size, 0, 0, None, None, None, None, None, None]
            if size:
                row[2] = int(_mixed(found).sum().view(np.int64))
                row[3] = int(np.bitwise_xor.reduce(_mixed(found + np.uint64(1))).view(np.int64))
            if size and doc_id.is_valid and row[2] not in seen:
                if len(seen) >= MEMO_WORDS:
                    seen.clear()
                seen.add(row[2])
                band = int(np.searchsorted(limits, size, "right")) - 1
                row[4] = band - 1
                for place, joint in ((5, band - 1), (6, band)):
                    if joint >= 0:
                        # Pairs of two larger sizes are left to the bands they begin.
                        low = int(limits[joint + 1]) - 1
                        high = min(int(limits[joint + 2]) - 1, low * 100 // percent)
                        bound = _bound(low, high, percent)
                        parts = _segments(found, counts(int(limits[joint]), bound))
                        row[place] = parts.view(np.int64)
                        # With more empty segments than it can spare a set gives them too.
                        row[place + 3] = np.count_nonzero(parts == 0) >= len(parts) - bound
                row[7] = _sketch(found).tobytes()
                row[8], row[9] = bool(row[8]), bool(row[9])
            rows.append(row)
        for start in range(0, len(rows), 2000):
            part = rows[start : start + 2000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(zip(*part), _SKETCHED)],
                schema=_SKETCHED,
            )
    _words.clear()  # a worker lives on: leave its memory to what it does next


@gives_back
def _shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and print those whose key has another print too.

    Such a row has a neighbour of its key and of another print, so one row is held at a time,
    however many rows a key has; repeated rows shrink to two at most.
    """
    last: tuple[np.ndarray, np.ndarray] | None = None
    given = False
    for batch in batches:
        if not len(batch):
            continue
        keys, prints = (column.to_numpy() for column in batch.columns)
        if last is not None:
            keys, prints = np.concatenate([last[0], keys]), np.concatenate([last[1], prints])
        link = (keys[1:] == keys[:-1]) & (prints[1:] != prints[:-1])
        shared = np.zeros(len(keys), bool)
        shared[1:] |= link
        shared[:-1] |= link
        if given:
            shared[0] = False
        given = bool(shared[-1]) if len(keys) > 1 else given
        last = keys[-1:], prints[-1:]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[shared]), pa.array(prints[shared])], names=["key", "print_a"]
        )


@gives_back
def _set_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for at, text in enumerate(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, 1), pa.array([shingles(text.as_py(), width).tobytes()], pa.binary())],
                names=["node", "shingles"],
            )
    _words.clear()


@gives_back
def _verify_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets reach the threshold, by exact counts."""
    for batch in batches:
        keep = []
        for left, right in zip(batch.column(2), batch.column(3)):
            a = np.frombuffer(left.as_py(), np.uint64)
            b = np.frombuffer(right.as_py(), np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= percent * (len(a) + len(b) - common))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


@gives_back
def _near_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches allow the threshold: columns a, b, sizes and sketches of both."""
    for batch in batches:
        keep = []
        for m, n, left, right in zip(*(batch.column(i) for i in (2, 3, 4, 5))):
            a = np.frombuffer(left.as_py(), np.uint64)
            b = np.frombuffer(right.as_py(), np.uint64)
            words = min(len(a), len(b))
            apart = int(np.bitwise_count(_folded(a, words) ^ _folded(b, words)).sum())
            keep.append(apart <= _bound(m.as_py(), n.as_py(), percent))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _near_in_block(rows: list[tuple], sketches: list[np.ndarray], percent: int):
    """For each row of a block the later rows of other groups that are near by sketch. The caller
    may join groups meanwhile: ``group`` is read anew for every row."""
    words = min(map(len, sketches))
    sketches = np.stack([_folded(one, words) for one in sketches])
    side = np.array([row[0] for row in rows], np.int64)
    size = np.array([row[3] for row in rows], np.int64)
    group = np.unique([row[2] for row in rows], return_inverse=True)[1]
    two_sides = side.min() != side.max()
    for at in range(len(rows) - 1):
        # Rows are sorted by side, so with two sides the others start behind this side.
        start = int(np.searchsorted(side, side[at], "right")) if two_sides else at + 1
        others = start + np.flatnonzero(group[start:] != group[at])
        if len(others):
            apart = np.bitwise_count(sketches[others] ^ sketches[at]).sum(axis=1, dtype=np.int64)
            near = others[apart <= _bound(size[others], size[at], percent)]
            if len(near):
                yield at, near, group


def _tried_block(block: tuple, rows: list[tuple], percent: int, most: int) -> list[tuple]:
    """A block's near pairs, ``(None, None, None, a, b)``, or, if it is a dense one, its members
    that are in any, ``(key, i, j, node, None)``. A row is (side, node, label, size, sketch)."""
    pairs, members = [], np.zeros(len(rows), bool)
    few = most * len(rows)
    sketches = [np.frombuffer(row[4], np.uint64) for row in rows]
    for at, near, _ in _near_in_block(rows, sketches, percent):
        members[at] = True
        members[near] = True
        if len(pairs) <= few:
            pairs += [(at, x) for x in near.tolist()]
    if len(pairs) <= few:
        ends = ((rows[x][1], rows[y][1]) for x, y in pairs)
        return [(None, None, None, min(two), max(two)) for two in ends]
    return [(*block, rows[x][1], None) for x in np.flatnonzero(members).tolist()]


def _dense_links(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """True links between members of a block that have different labels, one for each two groups
    that they join. A row is (side, node, label, size, set). Groups that a link has joined are
    one, so copies cost one comparison each."""
    sets = [np.frombuffer(row[4], np.uint64) for row in rows]
    size = np.array([len(one) for one in sets], np.int64)
    # Shingles by number, so that a set is a few marks and an intersection a look at them.
    found, number = np.unique(np.concatenate(sets), return_inverse=True)
    end = np.cumsum(size)
    marks = np.zeros(len(found), bool)
    links = []
    for at, near, group in _near_in_block(rows, [_sketch(one) for one in sets], percent):
        own = number[end[at] - size[at] : end[at]]
        marks[own] = True
        held = marks[np.concatenate([number[end[x] - size[x] : end[x]] for x in near])]
        common = np.add.reduceat(held.astype(np.int64), np.cumsum(size[near]) - size[near])
        marks[own] = False
        for x in near[100 * common >= percent * (size[near] + size[at] - common)]:
            if group[x] != group[at]:
                links.append((min(rows[at][1], rows[x][1]), max(rows[at][1], rows[x][1])))
                group[group == group[x]] = group[at]
    return links


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows come sorted by block (key, i, j) and side; a block is at most two chunks."""
    block, rows = None, []
    for batch in batches:
        for key, i, j, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if (key, i, j) != block:
                if len(rows) > 1:
                    yield block, rows
                block, rows = (key, i, j), []
            rows.append(tuple(row))
    if len(rows) > 1:
        yield block, rows


_TRIED = pa.schema([(name, pa.int64()) for name in ("key", "i", "j", "a", "b")])


@gives_back
def _tried_batches(
    batches: Iterator[pa.RecordBatch], percent: int, most: int
) -> Iterator[pa.RecordBatch]:
    for block, rows in _by_block(batches):
        found = _tried_block(block, rows, percent, most)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=_TRIED)


@gives_back
def _dense_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for _, rows in _by_block(batches):
        links = _dense_links(rows, percent)
        a, b = zip(*links) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``node, shingles`` of the documents of some ids, made anew from their texts."""
    texts = among(docs.where("doc_id is not null"), ids, "doc_id")
    return texts.mapInArrow(
        partial(_set_batches, width=width), "node long, shingles binary"
    ).dropDuplicates(["node"])


def _verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets, made anew from the texts, reach the threshold."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    ids = written(ends.select(F.col("node").alias("doc_id")), "ngram-ids")
    sets = _sets_of(docs, ids, width)
    rows = (
        pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
        .select("a", "b", "left", "right")
    )
    return written(
        rows.mapInArrow(partial(_verify_batches, percent=percent), "a long, b long"), "ngram-links"
    )


def _leader_pairs(members: DataFrame, active: DataFrame, percent: int) -> DataFrame:
    """Each member of a key beside the key's smallest node and beside its best shared node,
    as far as sizes and sketches allow the pair."""
    weights = members.groupBy("node").agg(F.count(F.lit(1)).alias("weight"))
    weighted = members.join(weights, "node")
    leaders = weighted.groupBy("key").agg(
        F.min("node").alias("least"), F.max_by("node", "weight").alias("best")
    )
    pairs = members.join(
        leaders.select("key", F.explode(F.array("least", "best")).alias("leader")), "key"
    ).where("leader != node")
    pairs = pairs.select(
        F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")
    ).distinct()
    return _near(pairs, active, percent)


def _one_key_per_set(members: DataFrame) -> DataFrame:
    """Of the keys that the very same nodes share, one: the others bring no other pair."""
    sets = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("node").alias("low"),
        F.max("node").alias("high"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    first = sets.groupBy("n", "low", "high", "x", "y").agg(F.min("key").alias("key"))
    return members.join(first.select("key"), "key", "left_semi")


def _near(pairs: DataFrame, active: DataFrame, percent: int) -> DataFrame:
    own = active.select("node", "size", "sketch")
    rows = (
        pairs.join(own.toDF("a", "a_size", "a_sketch"), "a")
        .join(own.toDF("b", "b_size", "b_sketch"), "b")
        .where(F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * percent)
        .select("a", "b", "a_size", "b_size", "a_sketch", "b_sketch")
    )
    return rows.mapInArrow(partial(_near_batches, percent=percent), "a long, b long")


def _labels(links: DataFrame) -> DataFrame:
    """``node, label`` of linked nodes: the smallest node at most two links away. Nodes of one
    label are in one component; that the reverse need not hold costs comparisons only."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nearest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label"))
    further = both.join(nearest.toDF("b", "beyond"), "b").groupBy("a").agg(F.min("beyond").alias("beyond"))
    return nearest.join(further, "a").select(
        F.col("a").alias("node"), F.least("label", "beyond").alias("label")
    )


def _blocks_of(rows: DataFrame, payload: str) -> DataFrame:
    return (
        rows.select("key", "i", "j", "side", "node", "label", "size", payload)
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "side")
    )


def _open_links(
    docs: DataFrame, members: DataFrame, active: DataFrame, labels: DataFrame,
    led: DataFrame, width: int, percent: int, block: int, most: int,
) -> DataFrame:
    """Links between members of one key that have different labels.

    A key with more members than a block is cut into chunks by a hash of the node, and every
    two chunks meet in one block of their own: tasks stay bounded and no pair is left out.
    """
    placed = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    keys = (
        placed.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.min("label").alias("first"),
            F.max("label").alias("last"),
        )
        .where("first != last")
        .select("key", F.ceil(F.col("members") / block).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    rows = (
        placed.join(keys, "key")
        .withColumn("side", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("i", F.least("side", "other"))
        .withColumn("j", F.greatest("side", "other"))
    )
    tried = written(
        _blocks_of(rows.join(active, "node"), "sketch").mapInArrow(
            partial(_tried_batches, percent=percent, most=most), "key long, i long, j long, a long, b long"
        ),
        "ngram-tried",
    )
    pairs = tried.where("b is not null").select("a", "b").distinct().join(led, ["a", "b"], "left_anti")
    dense = tried.where("b is null").select("key", "i", "j", F.col("a").alias("node"))
    links = _verified(docs, written(pairs, "ngram-pairs"), width, percent)
    if dense.isEmpty():
        return links
    ids = written(dense.select(F.col("node").alias("doc_id")).distinct(), "ngram-ids")
    sets = _sets_of(docs, ids, width).withColumn("size", F.length("shingles") / 8)
    own = rows.select("key", "i", "j", "side", "node", "label").join(dense, ["key", "i", "j", "node"])
    more = _blocks_of(own.join(sets, "node"), "shingles").mapInArrow(
        partial(_dense_batches, percent=percent), "a long, b long"
    )
    return links.unionByName(more)


def ngram_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    block: int = BLOCK,
    pairs_a_member: int = PAIRS_A_MEMBER,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of their shingle
    sets; ``component_id`` is the smallest id reachable by links, itself included. NULL, empty
    and blank texts have no shingle and link with nothing. A row without id is returned with a
    NULL component and links with nothing; rows that share an id are one document. Shingles are
    compared by 64-bit hashes. Other columns of the input are not read.
    """
    docs = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")
    )
    sketched = written(
        docs.mapInArrow(
            partial(_sketch_batches, width=width, percent=percent), _SKETCHED_DDL
        ),
        "ngram-sketches",
    )
    own = sketched.where("size > 0 and doc_id is not null")
    nodes = written(
        own.groupBy("size", "print_a", "print_b").agg(F.min("doc_id").alias("node")), "ngram-nodes"
    )
    sides = own.select(
        "print_a",
        F.explode(
            F.array(
                F.struct(F.col("low_band").alias("band"), F.col("low").alias("parts"), F.col("low_all").alias("all")),
                F.struct((F.col("low_band") + 1).alias("band"), F.col("high").alias("parts"), F.col("high_all").alias("all")),
            )
        ).alias("side"),
    )
    parts = sides.select(
        "print_a", "side.band", "side.all", F.posexplode("side.parts").alias("at", "part")
    )
    keys = parts.where("part != 0 or all").select(F.xxhash64("band", "at", "part").alias("key"), "print_a")
    # Keys meet by one shuffle; a set goes by its print there, so that its copies are one.
    shared = (
        keys.repartition("key")
        .sortWithinPartitions("key", "print_a")
        .mapInArrow(_shared_batches, "key long, print_a long")
    )
    members = written(
        shared.join(nodes.select("print_a", "node"), "print_a").select("key", "node").distinct(),
        "ngram-members",
    )
    members = written(_one_key_per_set(members), "ngram-members")
    chosen = nodes.join(members.select("node").distinct(), "node", "left_semi")
    prints = ["size", "print_a", "print_b"]
    active = written(
        own.where("sketch is not null")
        .select(*prints, "sketch")
        .join(chosen, prints)
        .select("node", "size", "sketch")
        .dropDuplicates(["node"]),
        "ngram-active",
    )
    led = written(_leader_pairs(members, active, percent), "ngram-pairs")
    links = _verified(docs, led, width, percent)
    more = _open_links(
        docs, members, active, _labels(links), led, width, percent, block, pairs_a_member
    )
    merged = components(links.unionByName(more), "a", "b").toDF("node", "component")
    labels = nodes.join(merged, "node", "left").select(
        "size", "print_a", "print_b", F.coalesce("component", "node").alias("component")
    )
    return sketched.join(labels, ["size", "print_a", "print_b"], "left").select(
        F.col("doc_id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, classes: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The documents that are the smallest of their class, and all without a class."""
    dropped = classes.where(f"{id_column} != component_id").select(id_column).distinct()
    return among(docs, written(dropped, "ngram-dropped"), id_column, "left_anti")
