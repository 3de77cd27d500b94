"""Token counts of sections: a document is encoded once, its tokens' character spans are
joined to the spans of its sections, and a token across a boundary goes where a rule says.

Sections are spans of code points, ``[start, end)``; they may overlap, leave gaps, or come in
any order. Both sides of the interval join belong to one document and stay in its row: the
join is two binary searches per section over the spans of the document's words, whose tokens
are counted together, and a look at single tokens in the words that a border runs through.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.bpe import (
    _BEYOND_LATIN,
    _LATIN_WORDS,
    FLUSH_CHARS,
    broadcast_file,
    codec,
    lower_case,
)
from tripweave.llm.common import gives_back

#: Words a Python worker remembers before it starts afresh (about 80 MB).
MEMO_WORDS = 400_000
#: Who gets a token that more than one section, or a section and a gap, touches.
RULES = ("start", "end", "largest")

_SECTION = "struct<section:int,start:long,end:long>"


_CUT = re.compile(f"({_LATIN_WORDS.pattern})")


class Spans:
    """Where a document's tokens are, in code points: words with their spans and numbers of
    tokens, and the tokens of single words when a border runs through them."""

    def __init__(self, coder, text: str):
        self.coder = coder
        starts, ends, counts, self.words = [], [], [], []
        at = 0
        for special, part in coder.vocab.parts(text):
            if special:
                starts.append([at])
                ends.append([at + len(part)])
                counts.append([1])
                self.words.append(None)
            else:
                for found, parts in zip(self._words(part), (starts, ends, counts)):
                    parts.append(found)
                starts[-1] = starts[-1] + at
                ends[-1] = ends[-1] + at
            at += len(part)
        join = lambda parts: np.concatenate([np.empty(0, np.int64), *parts]).astype(np.int64)
        self.starts, self.ends = join(starts), join(ends)
        self.before = np.concatenate([[0], np.cumsum(join(counts))])
        self.tokens = int(self.before[-1])

    def _words(self, part: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lowered = lower_case(part)
        if (
            len(lowered) == len(part)
            and not _BEYOND_LATIN.search(lowered)
            and unicodedata.is_normalized("NFC", part)
        ):
            pieces = _CUT.split(lowered)  # a gap, a word, a gap, ...
            places = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            words = pieces[1::2]
            ids = map(self.coder.met(words, MEMO_WORDS).__getitem__, words)
            self.words += words
            return places[:-1:2], places[1::2], np.fromiter(map(len, ids), np.int64, len(words)) // 4
        # Where normalising moves characters the library's own offsets hold, token by token.
        offsets = self.coder.library().encode(part, add_special_tokens=False).offsets
        offsets = np.array(offsets, np.int64).reshape(-1, 2)
        self.words += [None] * len(offsets)
        return offsets[:, 0], offsets[:, 1], np.ones(len(offsets), np.int64)

    def of_word(self, at: int) -> list[tuple[int, int]]:
        """Spans of one word's tokens. A token that is part of a character spans all of it."""
        word, start = self.words[at], int(self.starts[at])
        if word is None:
            return [(start, int(self.ends[at]))]
        vocab = self.coder.vocab
        ids = np.frombuffer(self.coder.met([word], MEMO_WORDS)[word], "<u4").tolist()
        last = np.cumsum([len(vocab.strings[i].removesuffix(vocab.suffix)) for i in ids])
        owner = np.repeat(np.arange(len(word)), [len(c.encode()) for c in word])
        firsts = owner[np.concatenate([[0], last[:-1]])]
        return [(start + a, start + b) for a, b in zip(firsts.tolist(), (owner[last - 1] + 1).tolist())]


def attribute(spans: Spans, sections: list[tuple[int, int]], rule: str) -> list[tuple[int, int]]:
    """For each section its tokens by the rule, and how many of them reach outside it.

    ``start``: the section that holds a token's first character. ``end``: its last one.
    ``largest``: the one that holds more than half of its characters, or its first half.
    """
    low = np.array([s[0] for s in sections], np.int64)
    high = np.array([s[1] for s in sections], np.int64)
    first = np.searchsorted(spans.starts, low)
    stop = np.maximum(np.searchsorted(spans.ends, high, "right"), first)
    whole = (spans.before[stop] - spans.before[first]).tolist()
    answers = []
    for a, b, i, j, tokens in zip(low.tolist(), high.tolist(), first.tolist(), stop.tolist(), whole):
        crossing = 0
        if a < b:
            # Words that a border runs through; all others are inside or outside as a whole.
            cut = {
                word
                for word in (i - 1, j)
                if 0 <= word < len(spans.starts) and spans.starts[word] < b and spans.ends[word] > a
            }
            for word in cut:
                for start, end in spans.of_word(word):
                    anchor = {"start": start, "end": end - 1}.get(rule, (start + end - 1) // 2)
                    if a <= anchor < b:
                        tokens += 1
                        crossing += start < a or end > b
        else:
            tokens = 0
        answers.append((tokens, crossing))
    return answers


@gives_back
def _count_batches(
    batches: Iterator[pa.RecordBatch], file, rule: str, cut: Callable | None
) -> Iterator[pa.RecordBatch]:
    coder = codec(file.value)
    for batch in batches:
        rows, chars = [], 0
        for at, text in enumerate(batch.column(1)):
            value = text.as_py() or ""
            if cut is None:
                given = [s for s in (batch.column(2)[at].as_py() or []) if s]
                sections = [(s["section"], s["start"], s["end"]) for s in given]
            else:
                sections = [(n, *span) for n, span in enumerate(cut(value))]
            spans = Spans(coder, value)
            counts = attribute(spans, [s[1:] for s in sections], rule)
            name = batch.column(0)[at].as_py()
            for section, counted in zip(sections, counts):
                rows.append((name, *section, *counted, spans.tokens))
            chars += len(value)
            if rows and (chars > FLUSH_CHARS or at == len(batch) - 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, field.type) for v, field in zip(zip(*rows), _COUNTED)],
                    schema=_COUNTED,
                )
                rows, chars = [], 0


_COUNTED = pa.schema(
    [
        ("id", pa.int64()),
        ("section", pa.int32()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("n_tokens", pa.int64()),
        ("n_crossing", pa.int64()),
        ("document_tokens", pa.int64()),
    ]
)


def count_tokens(
    docs: DataFrame,
    path: str,
    sections: Column | Callable[[str], list[tuple[int, int]]],
    rule: str = "largest",
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per section: id, ``section, start, end, n_tokens, n_crossing, document_tokens``.

    ``sections`` is an expression over the row, an array of (section number, start, end), or
    a function that gives a text's spans, which are then numbered from 0. A document without sections has no row; NULL text counts as empty, its sections have no
    tokens. ``n_crossing`` counts those of a section's tokens that also reach outside it. A
    section whose end is not after its start holds nothing. Rows that repeat are repeated.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    cut = None if isinstance(sections, Column) else sections
    given = F.lit(None) if cut else sections
    return docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(text).cast("string").alias("text"),
        given.cast(f"array<{_SECTION}>").alias("sections"),
    ).mapInArrow(
        partial(_count_batches, file=broadcast_file(docs, path), rule=rule, cut=cut),
        "id long, section int, start long, end long, n_tokens long, n_crossing long,"
        " document_tokens long",
    ).withColumnRenamed("id", id_column)


def lead_and_lines(lead: int) -> Callable[[str], list[tuple[int, int]]]:
    """Sections of a text: 0 is its first ``lead`` code points, then each line of the rest,
    its line end included."""
    return partial(_lead_and_lines, lead=lead)


def _lead_and_lines(text: str, lead: int) -> list[tuple[int, int]]:
    ends = [min(lead, len(text))]
    while 0 < (end := text.find("\n", ends[-1]) + 1) < len(text):
        ends.append(end)
    if ends[-1] < len(text):
        ends.append(len(text))
    return list(zip([0, *ends], ends))
