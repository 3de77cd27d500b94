"""Ranked lexical search by bag deduplication.

For a set of items (queries) a document is no more than how often it holds each of their terms,
and its length norm m. One pass over the texts reduces every document to that vector; documents
of the same vector and m, found by a 128-bit hash and told apart by the vector itself, are one
class. Each class is scored once against all items, a task keeps the best classes of each item,
and only the classes that win are expanded into their members, smallest id first.

Items come in blocks of bounded size, each a pass of its own, so that what tasks hold of them is
bounded. Of a class as many members are kept as a ranking can show, since others of the same
score come after them; a text that a third of all rows repeat sends that many rows a task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import written

#: Bytes of item texts that one pass over the documents serves (fixes what tasks hold of them).
ITEM_BYTES = 4 << 20
#: Bytes of a text that are cut into terms at a time.
SLICE = 4 << 20
#: Scores that a task computes at a time, classes times items.
CELLS = 2_000_000

#: Letters A-Z become small, digits, small letters and all beyond ASCII stay, the rest separates.
_LETTERS = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower()
)


def _term_lists(text: bytes) -> Iterator[list[bytes]]:
    """A UTF-8 text's terms in order, whole terms of about ``SLICE`` bytes at a time."""
    start = 0
    while start < len(text):
        part = text[start : start + SLICE].translate(_LETTERS)
        if start + SLICE < len(text):
            end = part.rfind(b" ") + 1
            if not end:  # one term longer than a slice
                rest = text[start + SLICE :].translate(_LETTERS)
                end = SLICE + (rest + b" ").index(b" ")
                part = text[start : start + end].translate(_LETTERS)
            part = part[:end]
        yield part.split()
        start += len(part)


class Items:
    """A block of items as tasks use it: terms by number, and each term's items."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        self.ids = [item_id for item_id, _ in rows]
        self.terms: dict[bytes, int] = {}
        held = []
        for item, (_, text) in enumerate(rows):
            counts = Counter(term for terms in _term_lists(text) for term in terms)
            for term, times in counts.items():
                held.append((self.terms.setdefault(term, len(self.terms)), item, times))
        held.sort()
        term, self.item, self.times = np.array(held, np.int64).reshape(-1, 3).T.copy()
        self.start = np.searchsorted(term, np.arange(len(self.terms) + 1))


_VECTORS = "doc_id long, n long, vector binary"


def _vector_batches(batches: Iterator[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    """Of each document its number of terms, and (term, occurrences) of the items' terms as
    sorted pairs of little-endian 32-bit numbers."""
    number_of = items.value.terms.get
    for batch in batches:
        sizes, vectors = [], []
        for text in batch.column(1):
            n, found = 0, Counter()
            for terms in _term_lists(text.as_py() or b""):
                n += len(terms)
                found.update(map(number_of, terms))
            found.pop(None, None)
            sizes.append(n)
            vectors.append(np.array(sorted(found.items()), "<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(vectors, pa.binary())],
            names=["doc_id", "n", "vector"],
        )


def _term_count_batches(batches: Iterator[pa.RecordBatch], terms: int) -> Iterator[pa.RecordBatch]:
    """Of each term the number of this task's documents that hold it."""
    counts = np.zeros(terms, np.int64)
    for batch in batches:
        raw = b"".join(v for v in batch.column(0).to_pylist() if v)
        counts += np.bincount(np.frombuffer(raw, "<u4")[::2], minlength=terms)
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["term", "df"])


_BEST = pa.schema(
    [
        ("item", pa.int64()),
        ("score", pa.int64()),
        ("first_id", pa.int64()),
        ("m", pa.int64()),
        ("vector", pa.binary()),
    ]
)
_BEST_DDL = "item long, score long, first_id long, m long, vector binary"


def _scores(vectors: list[bytes], m: np.ndarray, items: Items, weights: np.ndarray) -> np.ndarray:
    """Scores of classes (rows) for items (columns), in whole numbers."""
    pairs = np.frombuffer(b"".join(vectors), "<u4").astype(np.int64)
    term, tf = pairs[::2], pairs[1::2]
    row = np.repeat(np.arange(len(vectors)), [len(v) // 8 for v in vectors])
    value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
    many = items.start[term + 1] - items.start[term]
    at = np.repeat(items.start[term] - np.cumsum(many) + many, many) + np.arange(many.sum())
    out = np.zeros(len(vectors) * len(items.ids), np.int64)
    np.add.at(
        out,
        np.repeat(row * len(items.ids), many) + items.item[at],
        np.repeat(value, many) * items.times[at],
    )
    return out.reshape(len(vectors), len(items.ids))


def _best_batches(
    batches: Iterator[pa.RecordBatch], items, weights, most: int
) -> Iterator[pa.RecordBatch]:
    """Of each item this task's best classes, ``most`` at most: by score, then smallest id."""
    block = items.value
    best: list[list[tuple]] = [[] for _ in block.ids]
    least = np.ones(len(block.ids), np.int64)  # a class below it cannot be among the best
    order = lambda row: (-row[0], row[1] is None, row[1] or 0, row[2], row[3])
    for batch in batches:
        step = max(1, CELLS // len(block.ids))
        for start in range(0, len(batch), step):
            part = batch.slice(start, step)
            first, vectors = part.column(0).to_pylist(), part.column(2).to_pylist()
            m = part.column(1).to_numpy()
            scores = _scores(vectors, m, block, weights.value)
            for item in np.flatnonzero((scores >= least).any(axis=0)).tolist():
                column = scores[:, item]
                near = np.flatnonzero(column >= least[item])
                if len(near) > most:
                    edge = np.partition(column[near], -most)[-most]
                    near = near[column[near] >= edge]
                rows = [(int(column[i]), first[i], int(m[i]), vectors[i]) for i in near.tolist()]
                best[item] = sorted(best[item] + rows, key=order)[:most]
                if len(best[item]) == most:
                    least[item] = best[item][-1][0]
    rows = [(item, *row) for item, own in enumerate(best) for row in own]
    columns = list(zip(*rows)) or [()] * len(_BEST)
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, field.type) for c, field in zip(columns, _BEST)], schema=_BEST
    )


def _ranked_block(docs: DataFrame, rows: list[tuple[int | None, bytes]], most: int) -> DataFrame:
    """Rankings of one block of items: ``item_id, rank, doc_id, score``."""
    spark = docs.sparkSession
    block = Items(rows)
    items = spark.sparkContext.broadcast(block)
    vectors = written(
        docs.mapInArrow(partial(_vector_batches, items=items), _VECTORS), "search-vectors"
    )
    total = vectors.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    documents, terms = int(total[0]), int(total[1])
    df = np.zeros(len(block.terms), np.int64)
    counts = vectors.select("vector").mapInArrow(
        partial(_term_count_batches, terms=len(block.terms)), "term long, df long"
    )
    for term, count in counts.groupBy("term").agg(F.sum("df")).collect():  # the items' terms
        df[term] = count
    weights = np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64
    )
    # 75 n N may leave 64 bits long before its quotient does.
    norm = F.expr(f"cast(25 + (75 * cast(n as decimal(19,0)) * {documents}BD) div {max(terms, 1)}BD as long)")
    named = vectors.where("length(vector) > 0").select(
        "doc_id", norm.alias("m"), F.unhex(F.md5("vector")).alias("digest"), "vector"
    )
    by_class = Window.partitionBy("digest", "m", "vector").orderBy(F.asc_nulls_last("doc_id"))
    members = written(
        named.withColumn("place", F.row_number().over(by_class)).where(F.col("place") <= most),
        "search-members",
    )
    classes = members.where("place = 1").select(F.col("doc_id").alias("first_id"), "m", "vector")
    best = classes.mapInArrow(
        partial(
            _best_batches, items=items, weights=spark.sparkContext.broadcast(weights), most=most
        ),
        _BEST_DDL,
    )
    by_item = Window.partitionBy("item").orderBy(
        F.desc("score"), F.asc_nulls_last("first_id"), "m", "vector"
    )
    won = best.withColumn("place", F.row_number().over(by_item)).where(F.col("place") <= most)
    expanded = won.select("item", "score", "m", "vector").join(
        members.select("doc_id", "m", "vector"), ["m", "vector"]
    )
    by_rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    names = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
    return (
        expanded.withColumn("rank", F.row_number().over(by_rank))
        .where(F.col("rank") <= most)
        .join(F.broadcast(names), "item")  # as many rows as the block has items
        .select("item_id", "rank", "doc_id", "score")
    )


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    most: int = 10,
    id_column: str = "doc_id",
    item_column: str = "item_id",
    text: str = "text",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """Of each item its ``most`` best documents: ``item_id, rank, doc_id, score``.

    A term is a run of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased.
    ``score`` sums, over an item's terms with repeats, w * ((10^9 tf) div (1000 tf + 8 m)), with
    w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 25 + (75 n N) div L, for N documents that
    hold a term, L terms, df documents of the term, n terms and tf occurrences in the document.
    Only scores above 0 are ranked, equal ones by ascending id.

    NULL, empty and term-less texts, of documents and of items, match nothing. Every row is a
    document of its own: rows that share an id are ranked one after the other, rows without an
    id after all others of their score. Items that agree in id and text are one; items that
    share an id alone are ranked each by itself. Other columns are not read. Without documents
    or items the result is empty.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")
    )
    wanted = items.select(
        F.col(item_column).cast("long").alias("item_id"), F.col(text).cast("binary").alias("text")
    ).where("length(text) > 0").distinct()
    size = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // item_bytes)
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    ranked = []
    for block in range(blocks):
        rows = [(r.item_id, bytes(r.text)) for r in wanted.where(place == block).collect()]
        if rows:
            ranked.append(_ranked_block(texts, rows, most))
    if not ranked:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = ranked[0]
    for more in ranked[1:]:
        out = out.unionByName(more)
    return out
