"""Scores of texts by a smoothed n-gram model, walked as a weighted backoff automaton.

A state is an n-gram that training holds, as the words before the next one. It has an arc for
every word that training has seen after it, weighted with the word's smoothed probability, and a
failure arc, weighted with the share left to shorter histories, to the state of the n-gram
without its first word. A text is read once from left to right: in each state the word's arc is
taken, or failure arcs are until there is one; the empty state has an arc for every word, known
or not. Log weights add up.

With t the count of history h, c that of h followed by w, and h' the history without its first
word: P(w | h) = (1 - b) c / t + b P(w | h'), b = share / t ** power being the failure arc's weight.
So an n-gram's weight needs no more than its own count and its history's.

How it is distributed. The model grows with the corpus, so no task holds it. Documents form
blocks of bounded size. A block lists its own n-grams, each once, with the count of those it may
learn from; ranges of the n-grams' hashes, one a task, add the counts of all blocks up and answer
each block with the totals in its own order. A block then has all states and arcs that its texts
can meet, whatever the size of the model, and walks them. Counts and totals travel as packed
numbers, texts compressed, each once. A very common n-gram is one entry for each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import written

#: Bytes of text of one block (fixes a task's memory).
BLOCK_BYTES = 8 << 20
#: Bytes of text that are walked as one piece; longer texts are cut behind a white space.
PIECE_BYTES = 1 << 20
#: Bytes of text for each range of hashes (about four bytes of text make an n-gram to count).
RANGE_BYTES = 6 << 20
#: Words that one lane of the walk reads.
LANE = 512
#: An n-gram of two words or more is known by so many bits more than their number needs: one that
#: training does not hold is taken for another with a chance of about 1 in 2 ** 20.
SPARE_BITS = 20

_WHITE = b" \t\n\v\f\r"


@dataclass(frozen=True)
class Smoothing:
    """For histories of one word, two, ...: the weight share / t ** power that shorter histories
    have against a history seen t times. Their number is the model's order less 1."""

    shares: tuple[float, ...] = (0.9, 0.85)
    powers: tuple[float, ...] = (0.1, 0.1)

    def __post_init__(self):
        if len(self.shares) != len(self.powers) or not all(0 < s < 1 for s in self.shares):
            raise ValueError("one share between 0 and 1 and one power for each length of a history")
        if any(p < 0 for p in self.powers):
            raise ValueError("powers are 0 or more")

    @property
    def order(self) -> int:
        return len(self.shares) + 1

    def failure(self, length: int, seen: np.ndarray) -> np.ndarray:
        return self.shares[length - 1] / np.power(seen, self.powers[length - 1])


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


# ---- numbers as bytes -----------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers by byte planes, as many as the largest needs."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8).T[:width]
    return len(values).to_bytes(8, "little") + bytes([width]) + planes.tobytes()


def _unpacked(raw: memoryview) -> tuple[np.ndarray, memoryview]:
    count, width = int.from_bytes(raw[:8], "little"), raw[8]
    planes = np.zeros((count, 8), np.uint8)
    planes[:, :width] = np.frombuffer(raw, np.uint8, count * width, 9).reshape(width, count).T
    return planes.view("<u8").ravel(), raw[9 + count * width :]


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unsqueezed(raw: bytes) -> memoryview:
    size = int.from_bytes(raw[:8], "little")
    return memoryview(pa.decompress(raw[8:], size, codec="zstd", asbytes=True))


# ---- texts, pieces, blocks ------------------------------------------------------------------


@dataclass
class Piece:
    """A text or a part of one: the words before it that its first words may follow on."""

    row: int
    doc_id: int | None
    learn: bool
    first: bool
    last: bool
    before: bytes
    text: bytes


def _pieces(row: int, doc_id, learn: bool, text: bytes, order: int) -> Iterator[Piece]:
    start, before, words = 0, b"", order - 1
    while True:
        end = len(text)
        if end - start > PIECE_BYTES:
            end = start + PIECE_BYTES
            while end < len(text) and text[end] not in _WHITE:
                end += 1
        part = text[start:end]
        yield Piece(row, doc_id, learn, start == 0, end == len(text), before, part)
        if end == len(text):
            return
        before = b" ".join((before + b" " + part).rsplit(None, words)[-words:]) if words else b""
        start = end


def _blocks(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple[int, list[Piece]]]:
    """Numbered blocks of pieces. Rows that come in the same order form the same blocks."""
    block, size, row, held = None, 0, 0, []
    for batch in batches:
        if block is None and len(batch):
            block = batch.column(3)[0].as_py() << 32
        for doc_id, learn, text in zip(*(batch.column(i) for i in range(3))):
            for piece in _pieces(row, doc_id.as_py(), learn.as_py(), text.as_py() or b"", order):
                held.append(piece)
                size += len(piece.text) + 16
                if size >= BLOCK_BYTES:
                    yield block, held
                    block, size, held = block + 1, 0, []
            row += 1
    if held:
        yield block, held


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of texts, one text after the other, by number; words of each; the distinct words."""
    ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    # ASCII functions need no valid UTF-8, so the bytes are taken for text as they are.
    joined = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(ends), pa.py_buffer(b"".join(texts))
    )
    lists = pc.ascii_split_whitespace(pc.ascii_lower(joined))
    words = lists.flatten()
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    coded = words.filter(pa.array(filled)).dictionary_encode()
    sizes = np.bincount(owner[filled], minlength=len(texts))
    return coded.indices.to_numpy().astype(np.int64), sizes, coded.dictionary


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words: bytes times pseudo-random factors of their places."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words):
        return np.empty(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    sizes = np.diff(ends)
    place = np.arange(len(raw)) - np.repeat(ends[:-1] - ends[0], sizes)
    factors = _mixed(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    sums = np.add.reduceat((raw + np.uint64(1)) * factors, ends[:-1] - ends[0])
    return _mixed(sums + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


#: Hashes of what stands before a text's first word and behind its last.
START, END = _mixed(np.array([2**64 - 1, 2**64 - 2], np.uint64))


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct codes, a place of each, and each place's number among them."""
    order = np.argsort(codes)
    ordered = codes[order]
    fresh = np.r_[True, ordered[1:] != ordered[:-1]] if len(codes) else np.empty(0, bool)
    number = np.empty(len(codes), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return ordered[fresh], order[fresh], number


@dataclass
class Grams:
    """The n-grams of one length of a block, each once, and where they end."""

    at: np.ndarray  # place -> n-gram, -1 where none ends
    history: np.ndarray  # n-gram -> its n-gram without the last word
    place: np.ndarray  # n-gram -> a place where it ends
    hashes: np.ndarray


@dataclass
class Block:
    """A block's words in a row, pieces one after the other with the words before each."""

    pieces: list[Piece]
    order: int
    start: np.ndarray = field(init=False)  # of each piece its first word to score
    size: np.ndarray = field(init=False)
    levels: list[Grams] = field(init=False)

    def __post_init__(self):
        lead = self.order - 1
        found, sizes, distinct = _words([p.before + b" " + p.text for p in self.pieces])
        had = np.array([len(p.before.split()) for p in self.pieces], np.int64)
        last = np.array([p.last for p in self.pieces], bool)
        lengths = lead - had + sizes + last
        begin = np.cumsum(lengths) - lengths
        self.start, self.size = begin + lead, lengths - lead
        ids = np.full(lengths.sum(), len(distinct), np.int64)
        inside = np.arange(len(ids)) - np.repeat(begin, lengths)
        pads = np.repeat(lead - had, sizes)
        ids[np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + pads + np.arange(len(found))] = found
        ids[(begin + lengths - 1)[last]] = len(distinct) + 1
        words = np.concatenate([_word_hashes(distinct), [START, END]])
        # Every word is a unigram, and so are the two marks, which may stand nowhere.
        places = np.zeros(len(words), np.int64)
        places[ids] = np.arange(len(ids))
        self.levels = [Grams(ids.astype(np.int32), np.zeros(len(words), np.int32), places, words)]
        for length in range(2, self.order + 1):
            shorter = self.levels[-1]
            ends = np.flatnonzero(inside >= length - 1)
            codes = (shorter.at[ends - 1].astype(np.int64) << 32) | ids[ends]
            found, place, number = _distinct(codes)
            at = np.full(len(ids), -1, np.int32)
            at[ends] = number
            history = (found >> 32).astype(np.int32)
            hashes = _mixed(
                shorter.hashes[history] * np.uint64(0x9E3779B97F4A7C15)
                + words[found & 0xFFFFFFFF]
                + np.uint64(length)
            )
            self.levels.append(Grams(at, history, ends[place], hashes))

    def counts(self) -> list[np.ndarray]:
        """Of each n-gram how often the pieces to learn from hold it. What stands before a text
        counts once for each text, as a history."""
        weight = np.zeros(len(self.levels[0].at), bool)
        before = np.zeros(len(weight), bool)
        for piece, start, size in zip(self.pieces, self.start.tolist(), self.size.tolist()):
            if piece.learn:
                weight[start : start + size] = True
                if piece.first and self.order > 1:
                    before[start - 1] = True
        before |= weight
        out = []
        for length, grams in enumerate(self.levels, 1):
            held = grams.at[(weight if length == self.order else before) & (grams.at >= 0)]
            out.append(np.bincount(held, minlength=len(grams.place)))
        return out


def _keyed(block: Block, ranges: int, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For words, then for all longer n-grams: kind, hashes in order, the order, range borders.

    Words have whole 64-bit hashes, which are what known words and base scores rest on."""
    for kind, hashes in (
        (1, block.levels[0].hashes),
        (2, np.concatenate([np.empty(0, np.uint64), *(g.hashes for g in block.levels[1:])])),
    ):
        order = np.argsort(hashes)
        hashes = hashes[order]
        owner = ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        borders = np.searchsorted(owner, np.arange(ranges + 1, dtype=np.uint64))
        yield kind, hashes if kind == 1 else hashes >> np.uint64(64 - bits), order, borders


# ---- counts in, totals out ------------------------------------------------------------------

_COUNTS = pa.schema(
    [("to", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())]
)
_COUNTS_DDL = "to long, kind int, block long, payload binary"
_ANSWERS = pa.schema(
    [
        ("block", pa.int64()),
        ("kind", pa.int32()),
        ("part", pa.int64()),
        ("mark", pa.int64()),
        ("payload", pa.binary()),
        ("tokens", pa.int64()),
        ("distinct", pa.int64()),
    ]
)
_ANSWERS_DDL = (
    "block long, kind int, part long, mark long, payload binary, tokens long, distinct long"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _count_batches(
    batches: Iterator[pa.RecordBatch], order: int, ranges: int, bits: int
) -> Iterator[pa.RecordBatch]:
    for number, pieces in _blocks(batches, order):
        block = Block(pieces, order)
        words, *longer = block.counts()
        counts = {1: words, 2: np.concatenate([np.empty(0, np.int64), *longer])}
        rows = []
        for kind, keys, at, borders in _keyed(block, ranges, bits):
            for to in np.flatnonzero(borders[1:] > borders[:-1]).tolist():
                own = slice(borders[to], borders[to + 1])
                steps = np.diff(keys[own], prepend=keys[own][:1])
                raw = int(keys[own][0]).to_bytes(8, "little") + _packed(steps)
                rows.append((to, kind, number, _squeezed(raw + _packed(counts[kind][at[own]]))))
        for start in range(0, len(rows), 200):
            yield _batch(rows[start : start + 200], _COUNTS)


def _read_counts(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = _unsqueezed(payload)
    steps, rest = _unpacked(raw[8:])
    return np.cumsum(steps, dtype=np.uint64) + np.uint64(int.from_bytes(raw[:8], "little")), _unpacked(rest)[0]


def _mark(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(keys).view(np.int64))


def _totals(to: int, kind: int, rows: list[tuple[int, bytes]]) -> Iterator[tuple]:
    """The answers to all blocks that have keys of one range."""
    keys, counts = zip(*(_read_counts(payload) for _, payload in rows))
    ends = np.cumsum([len(k) for k in keys])
    joined = np.concatenate(keys)
    order = np.argsort(joined)
    sorted_keys = joined[order]
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    sums = np.add.reduceat(np.concatenate(counts)[order], starts)
    total = np.empty(len(joined), np.uint64)
    total[order] = np.repeat(sums, np.diff(np.r_[starts, len(joined)]))
    tokens = distinct = 0
    if kind == 1:
        word = sorted_keys[starts] != START
        tokens, distinct = int(sums[word].sum()), int(np.count_nonzero(sums[word]))
    for (block, _), own, end in zip(rows, keys, ends.tolist()):
        answer = _squeezed(_packed(total[end - len(own) : end]))
        yield block, kind, to, _mark(own), answer, tokens, distinct
        tokens = distinct = 0  # a range is told once


def _total_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by range and kind; a range is held at a time."""
    group, rows = None, []
    for batch in batches:
        for to, kind, block, payload in zip(*(c.to_pylist() for c in batch.columns)):
            if (to, kind) != group:
                if rows:
                    yield _batch(list(_totals(*group, rows)), _ANSWERS)
                group, rows = (to, kind), []
            rows.append((block, payload))
    if rows:
        yield _batch(list(_totals(*group, rows)), _ANSWERS)


# ---- the walk -------------------------------------------------------------------------------

_TEXTS = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("learn", pa.bool_()),
        ("first", pa.bool_()),
        ("last", pa.bool_()),
        ("before", pa.binary()),
        ("text", pa.binary()),
    ]
)


def _text_batches(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    """The blocks themselves, in rows beside the answers to them."""
    for block, pieces in _blocks(batches, order):
        rows, size, part = [], 0, 0
        for at, piece in enumerate(pieces):
            rows.append(tuple(vars(piece).values()))
            size += len(piece.text)
            if size > PIECE_BYTES or at == len(pieces) - 1:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, _TEXTS) as out:
                    out.write_batch(_batch(rows, _TEXTS))
                payload = _squeezed(sink.getvalue().to_pybytes())
                yield _batch([(block, 0, part, 0, payload, 0, 0)], _ANSWERS)
                rows, size, part = [], 0, part + 1


@dataclass
class Automaton:
    """What a block's texts can meet: for each n-gram of ``counts`` above 0 the log10 weight of
    its last word's arc, and as a state the log10 weight of its failure arc."""

    block: Block
    counts: list[np.ndarray]
    arcs: list[np.ndarray]
    failures: list[np.ndarray]

    @classmethod
    def of(cls, block: Block, counts: list[np.ndarray], tokens: int, distinct: int, smoothing: Smoothing):
        weights = [(counts[0] + 0.5) / (tokens + 0.5 * (distinct + 1))]
        failures = []
        for length in range(2, block.order + 1):
            grams = block.levels[length - 1]
            seen = np.maximum(counts[length - 2], 1).astype(float)
            failure = smoothing.failure(length - 1, seen)
            failures.append(np.log10(failure))
            shorter = weights[-1][block.levels[length - 2].at[grams.place]]
            b, t = failure[grams.history], seen[grams.history]
            weights.append((1 - b) * counts[length - 1] / t + b * shorter)
        return cls(block, counts, [np.log10(w) for w in weights], failures)

    def walk(self) -> np.ndarray:
        """log10 probabilities of the pieces: lanes of words side by side, each read once from
        left to right, with the length of its state carried from word to word."""
        block, longest = self.block, self.block.order - 1
        many = -(-block.size // LANE)
        piece = np.repeat(np.arange(len(many)), many)
        place = np.arange(len(piece)) - np.repeat(np.cumsum(many) - many, many)
        begin = block.start[piece] + place * LANE
        length = np.minimum(block.size[piece] - place * LANE, LANE)
        lanes = np.argsort(-length, kind="stable")
        begin, length, piece = begin[lanes], length[lanes], piece[lanes]
        state = np.zeros(len(begin), np.int8)  # a state is an n-gram: its length says which
        for n in range(1, longest + 1):
            grams = block.levels[n - 1].at[begin - 1]
            state[(state == n - 1) & (self.counts[n - 1][grams] > 0)] = n
        total = np.zeros(len(begin))
        for step in range(LANE if len(begin) else 0):
            active = int(np.searchsorted(-length, -step, "left"))  # lanes with more words
            if not active:
                break
            at = begin[:active] + step
            now = state[:active]  # an arc leads to a longer state, so each lane takes one
            for n in range(longest, 0, -1):
                here = np.flatnonzero(now == n)
                gram = block.levels[n].at[at[here]]
                arc = self.counts[n][gram] > 0
                taken, failed = here[arc], here[~arc]
                total[taken] += self.arcs[n][gram[arc]]
                now[taken] = min(n + 1, longest)
                total[failed] += self.failures[n - 1][block.levels[n - 1].at[at[failed] - 1]]
                now[failed] = n - 1
            here = np.flatnonzero(now == 0)
            word = block.levels[0].at[at[here]]
            total[here] += self.arcs[0][word]
            now[here] = np.where(self.counts[0][word] > 0, min(1, longest), 0)
        return np.bincount(piece, total, len(block.pieces))


_SCORES = pa.schema(
    [
        ("part", pa.int64()),
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("learn", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)
_SCORES_DDL = (
    "part long, row long, doc_id long, learn boolean, n_tokens long, n_known long,"
    " base_score double, score double"
)


def _scored(
    number: int, rows: list[tuple], ranges: int, bits: int, tokens: int, distinct: int, smoothing: Smoothing
) -> pa.RecordBatch:
    pieces = []
    for kind, payload, _ in rows:
        if kind == 0:
            with pa.ipc.open_stream(pa.py_buffer(_unsqueezed(payload))) as read:
                pieces += [Piece(*x) for x in zip(*(c.to_pylist() for c in read.read_all().columns))]
    block = Block(pieces, smoothing.order)
    counts = []
    for kind, keys, order, _ in _keyed(block, ranges, bits):
        own = [(payload, mark) for k, payload, mark in rows if k == kind]
        totals = np.concatenate(
            [np.empty(0, np.uint64), *(_unpacked(_unsqueezed(p))[0] for p, _ in own)]
        )
        mark = 0
        for _, one in own:
            mark ^= one
        if len(totals) != len(keys) or mark != _mark(keys):
            raise RuntimeError(f"the rows of block {number} changed while they were scored")
        placed = np.empty(len(totals), np.int64)
        placed[order] = totals
        counts.append(placed)
    ends = np.cumsum([len(g.place) for g in block.levels[1:]])[:-1]
    counts = [counts[0], *(np.split(counts[1], ends) if smoothing.order > 1 else [])]
    automaton = Automaton.of(block, counts, tokens, distinct, smoothing)
    owner = np.repeat(np.arange(len(pieces)), block.size)
    scored = np.repeat(block.start - np.cumsum(block.size) + block.size, block.size) + np.arange(len(owner))
    word = block.levels[0].at[scored]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(pieces), number >> 32)),
            pa.array([p.row for p in pieces], pa.int64()),
            pa.array([p.doc_id for p in pieces], pa.int64()),
            pa.array([p.learn for p in pieces], pa.bool_()),
            pa.array(block.size),
            pa.array(np.bincount(owner[counts[0][word] > 0], minlength=len(pieces))),
            pa.array(np.bincount(owner, automaton.arcs[0][word], len(pieces))),
            pa.array(automaton.walk()),
        ],
        schema=_SCORES,
    )


def _score_batches(batches: Iterator[pa.RecordBatch], **model) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, kind and part; a block is held at a time."""
    number, rows = None, []
    for batch in batches:
        for block, kind, payload, mark in zip(*(c.to_pylist() for c in batch.columns)):
            if block != number:
                if rows:
                    yield _scored(number, rows, **model)
                number, rows = block, []
            rows.append((kind, payload, mark))
    if rows:
        yield _scored(number, rows, **model)


def score_texts(
    docs: DataFrame,
    learn: Column,
    smoothing: Smoothing = Smoothing(),
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row's text scored by a model of the rows where ``learn`` holds (NULL: it does not).

    Words are runs without ASCII white space, A-Z lower-cased; one end follows the last and is a
    token too. Columns: the id, ``learned``, ``n_tokens``, ``n_known`` (tokens that training
    holds), ``train_tokens``, ``base_score`` (log10 by single tokens, half a count added to each
    and to one unknown word) and ``score`` (log10 by the automaton); all unknown words are one.

    NULL and empty texts are their end alone. Rows without an id and repeated rows count and are
    scored like others; an empty table gives no row, and without rows to learn from both scores
    are those of an empty model. Texts of any length are read whole, long ones in pieces, whose
    states go on from piece to piece. Columns other than id, text and what ``learn`` reads are not
    read. The rows are read twice and must come in the same order both times, as those of a table
    do; otherwise the job fails.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.col(text).cast("binary").alias("text"),
        F.spark_partition_id().alias("source"),
    )
    size = rows.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 16)).first()[0] or 0
    order, ranges = smoothing.order, 1 + size // RANGE_BYTES
    bits = min(64, SPARE_BITS + math.ceil(math.log2(size / 4 + 2)))
    answers = written(
        rows.mapInArrow(
            partial(_count_batches, order=order, ranges=ranges, bits=bits), _COUNTS_DDL
        )
        .repartition("to")
        .sortWithinPartitions("to", "kind", "block")
        .mapInArrow(_total_batches, _ANSWERS_DDL),
        "lm-counts",
    )
    tokens, distinct = answers.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))
    ).first()
    scored = (
        answers.unionByName(rows.mapInArrow(partial(_text_batches, order=order), _ANSWERS_DDL))
        .select("block", "kind", "part", "payload", "mark")
        .repartition("block")
        .sortWithinPartitions("block", "kind", "part")
        .select("block", "kind", "payload", "mark")
        .mapInArrow(
            partial(
                _score_batches,
                ranges=ranges,
                bits=bits,
                tokens=tokens,
                distinct=distinct,
                smoothing=smoothing,
            ),
            _SCORES_DDL,
        )
    )
    return (
        scored.groupBy("part", "row")
        .agg(
            F.first("doc_id").alias(id_column),
            F.first("learn").alias("learned"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            F.sum("base_score").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .drop("part", "row")
    )
