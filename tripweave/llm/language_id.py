"""Language identification by cross-parsing entropy.

Each language has a bounded sample of labelled text and its suffix automaton. A text is cut
into phrases, each the longest match from where it begins in the language's sample; fewer
phrases mean that the sample resembles the text. A phrase costs the bits that name a place in
the sample, so ``phrases * log2(sample length) / text length`` estimates the cross entropy in
bits per symbol, and the language with the fewest wins.

Only the samples are broadcast; each Python worker builds the automata once. Texts are parsed
whole, in blocks of a fixed number of symbols, many blocks side by side.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.llm.common import gives_back, worker_model

#: Labelled documents per language, those of smallest id hash, and symbols of them at most.
SAMPLE_DOCS = 60
SAMPLE_SYMBOLS = 24_000
#: Places of a longer document that its share of the symbols comes from.
PLACES = 4
#: Symbols of a block; a phrase ends at a block's end.
BLOCK = 256
#: Symbols that are parsed side by side.
BATCH_SYMBOLS = 2_000_000
UNKNOWN_LANGUAGE = "und"


def normal(text: str) -> str:
    """Lower-case letters; what lies between them is one space."""
    return " ".join("".join([c if c.isalpha() else " " for c in text.lower()]).split())


def automaton(sample: str, symbols: dict[str, int], width: int) -> np.ndarray:
    """Transitions of the sample's suffix automaton, ``[state, symbol]``; 0 is the start state
    and, since nothing leads back there, also stands for no transition."""
    links, lengths, steps = [-1], [0], [{}]
    last = 0
    for char in sample:
        symbol = symbols[char]
        state = len(steps)
        lengths.append(lengths[last] + 1)
        links.append(0)
        steps.append({})
        at = last
        while at >= 0 and symbol not in steps[at]:
            steps[at][symbol] = state
            at = links[at]
        if at >= 0:
            target = steps[at][symbol]
            if lengths[at] + 1 == lengths[target]:
                links[state] = target
            else:
                copy = len(steps)
                lengths.append(lengths[at] + 1)
                links.append(links[target])
                steps.append(dict(steps[target]))
                while at >= 0 and steps[at].get(symbol) == target:
                    steps[at][symbol] = copy
                    at = links[at]
                links[target] = links[state] = copy
        last = state
    table = np.zeros((len(steps), width), np.int32)
    for state, found in enumerate(steps):
        if found:
            table[state, list(found)] = list(found.values())
    return table


class Languages:
    """The automata of all languages over one alphabet."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(name for name, sample in samples.items() if sample)
        alphabet = sorted(set("".join(samples[name] for name in self.names)) | {" "})
        # Symbol 0 is a letter of no sample; the last symbol fills blocks up.
        self.symbols = {char: at for at, char in enumerate(alphabet, 1)}
        self.filler = len(alphabet) + 1
        self.width = self.filler + 1
        self.tables = [automaton(samples[n], self.symbols, self.width).ravel() for n in self.names]
        self.bits = np.array([np.log2(max(len(samples[n]), 2)) for n in self.names])
        self.space = self.symbols[" "]
        self.codes = np.zeros(0x10000, np.int16)
        for point in range(0x10000):
            char = chr(point)
            self.codes[point] = self.symbols.get(char, 0) if char.isalpha() else self.space

    def encoded(self, text: str) -> np.ndarray:
        """Symbols of a text: letters, and one space for all between them, none at the ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        found = self.codes[np.minimum(points, 0xFFFF)]
        if (far := points > 0xFFFF).any():
            found[far] = [
                self.symbols.get(c, 0) if c.isalpha() else self.space for c in map(chr, points[far].tolist())
            ]
        blank = found == self.space
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        found = found[keep]
        start = int(len(found) > 0 and found[0] == self.space)
        stop = len(found) - int(len(found) > start and found[-1] == self.space)
        return found[start:stop]

    def phrases(self, blocks: np.ndarray) -> np.ndarray:
        """Phrases of each block in each language: ``[block, language]``."""
        counts = np.zeros((len(blocks), len(self.names)), np.int64)
        columns = np.ascontiguousarray(blocks.T).astype(np.int32)
        for at, table in enumerate(self.tables):
            state = np.zeros(len(blocks), np.int32)
            count = counts[:, at]
            for symbol in columns:
                going = table[state * self.width + symbol]
                ended = np.flatnonzero((going == 0) & (symbol != self.filler))
                count[ended] += state[ended] != 0
                again = table[symbol[ended]]
                count[ended] += again == 0  # a symbol of no sample is a phrase of its own
                going[ended] = again
                state = np.where(symbol == self.filler, state, going)
            count += state != 0
        return counts

    def costs(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits per symbol of each text in each language; infinite for a text of no symbols."""
        sizes = np.array([len(t) for t in texts], np.int64)
        blocks_of = -(-sizes // BLOCK)
        filled = np.full(int(blocks_of.sum()) * BLOCK, self.filler, np.int16)
        start = 0
        for text, blocks in zip(texts, blocks_of.tolist()):
            filled[start : start + len(text)] = text
            start += blocks * BLOCK
        counts = self.phrases(filled.reshape(-1, BLOCK))
        totals = np.zeros((len(texts), len(self.names)), np.int64)
        np.add.at(totals, np.repeat(np.arange(len(texts)), blocks_of), counts)
        with np.errstate(divide="ignore", invalid="ignore"):
            bits = totals * self.bits / sizes[:, None]
        return np.where(sizes[:, None] > 0, bits, np.inf)

    def predict(self, texts: list[np.ndarray]) -> list[tuple[str, float, float]]:
        """The language of fewest bits, of equal ones the first by name; a score: the share of
        the second best language's bits in those of both, 0.5 for a tie, 1 if it is alone; and
        the bits per symbol that the language takes."""
        answers = []
        costs = self.costs(texts) if self.names else np.empty((len(texts), 0))
        for text, row in zip(texts, costs):
            if not len(text) or not len(row):
                answers.append((UNKNOWN_LANGUAGE, 0.0, math.inf))
                continue
            best = int(np.argmin(row))
            others = np.delete(row, best)
            score = float(others.min() / (others.min() + row[best])) if len(others) else 1.0
            answers.append((self.names[best], score, float(row[best])))
        return answers


@gives_back
def _predict_batches(
    batches: Iterator[pa.RecordBatch], samples, text_at: int, names: list[str]
) -> Iterator[pa.RecordBatch]:
    key = "languages", hashlib.md5(samples.value).digest()
    languages = worker_model(key, lambda: Languages(json.loads(samples.value)))
    for batch in batches:
        start, texts, size = 0, [], 0
        for at, text in enumerate(batch.column(text_at)):
            texts.append(languages.encoded(text.as_py() or ""))
            size += len(texts[-1])
            if size > BATCH_SYMBOLS or at == len(batch) - 1:
                found, scores, bits = zip(*languages.predict(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(start, at + 1 - start).columns,
                        pa.array(found, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(bits, pa.float64()),
                    ],
                    names=names,
                )
                start, texts, size = at + 1, [], 0


def spread(text: str, size: int) -> str:
    """At most ``size`` letters of a text, those of a longer one from ``PLACES`` places of it."""
    each = (size - PLACES + 1) // PLACES
    if len(text) <= size or each < 1:
        return text[: max(size, 0)]
    starts = ((len(text) - each) * place // (PLACES - 1) for place in range(PLACES))
    return " ".join(text[start : start + each] for start in starts)


def sample_of(texts: list[str], size: int) -> str:
    """A sample of ``size`` letters that the texts have equal shares of; what shorter ones do
    not need is shared by the others."""
    shares, left = [0] * len(texts), size
    order = sorted(range(len(texts)), key=lambda at: len(texts[at]))
    for done, at in enumerate(order):
        # One letter of each share is the space between documents.
        shares[at] = min(len(texts[at]), left // (len(texts) - done) - 1)
        left -= shares[at] + 1
    parts = (spread(text, share) for text, share in zip(texts, shares))
    return " ".join(" ".join(parts).split())[:size]


def train(
    docs: DataFrame,
    learn_from: Column,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_symbols: int = SAMPLE_SYMBOLS,
) -> dict[str, str]:
    """A sample text per language: at most ``sample_docs`` labelled documents, those of smallest
    id hash, and of those at most ``sample_symbols`` symbols, to equal shares. Rows without id, text or lang teach
    nothing."""
    known = docs.where(learn_from).select(
        F.col(id_column).alias("row_id"), F.col(text).alias("row_text"), F.col(lang).cast("string").alias("row_lang")
    ).where("row_id is not null and row_text is not null and row_lang is not null")
    order = Window.partitionBy("row_lang").orderBy(F.xxhash64("row_id"), "row_id")
    chosen = (
        known.select("row_id", "row_lang")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= sample_docs)
    )
    # As many rows as languages times documents: small enough to broadcast and to collect.
    # Of a text longer than twice the whole sample, as much as that comes from several places.
    size, each = F.length("row_text"), max(2 * sample_symbols // PLACES, 1)
    starts = [F.floor((size - each) * place / (PLACES - 1)).cast("int") + 1 for place in range(PLACES)]
    parts = [F.col("row_text").substr(start, F.lit(each)) for start in starts]
    taken = F.when(size <= PLACES * each, F.col("row_text")).otherwise(F.concat_ws(" ", *parts))
    rows = known.join(F.broadcast(chosen), ["row_id", "row_lang"]).orderBy("row_lang", "place").select(
        "row_lang", taken.alias("row_text")
    )
    samples: dict[str, str] = {}
    for name, of_language in groupby(rows.toLocalIterator(), key=lambda row: row.row_lang):
        samples[name] = sample_of([normal(row.row_text) for row in of_language], sample_symbols)
    return samples


#: Columns that predictions add; named so that they meet no column of the input.
FOUND, SURE, BITS = "__language", "__language_score", "__language_bits"
#: A text that takes more bits a symbol in every learned language is in none of them. Texts of
#: the given documents take 2 to 4.9, all but some of one word; other languages in the same
#: letters took 5.6 to 8.6, other scripts 14.
MOST_BITS = 5.0


def _with_language(rows: DataFrame, samples: dict[str, str], text: str) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(json.dumps(samples).encode())
    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField(FOUND, T.StringType()),
            T.StructField(SURE, T.DoubleType()),
            T.StructField(BITS, T.DoubleType()),
        ]
    )
    work = partial(
        _predict_batches, samples=sent, text_at=rows.columns.index(text), names=schema.names
    )
    return rows.mapInArrow(work, schema)


def predict(
    docs: DataFrame, samples: dict[str, str], id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row as ``id_column, lang_pred, score``.

    A text that is NULL or has no letter, or any text when there are no samples, is ``und``
    with score 0. Rows may repeat, ids may be NULL; other columns are not read.
    """
    rows = _with_language(docs.select(id_column, text), samples, text)
    return rows.select(id_column, F.col(FOUND).alias("lang_pred"), F.col(SURE).alias("score"))


def keep_known(
    docs: DataFrame, samples: dict[str, str], text: str = "text", most_bits: float = MOST_BITS
) -> DataFrame:
    """The rows whose text is in a learned language, with all their columns: not those that are
    ``und``, nor those that need more than ``most_bits`` bits a symbol in every language."""
    found = _with_language(docs, samples, text)
    return found.where((F.col(FOUND) != UNKNOWN_LANGUAGE) & (F.col(BITS) <= most_bits)).select(
        *docs.columns
    )
