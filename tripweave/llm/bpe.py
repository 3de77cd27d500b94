"""Byte-pair encoding and decoding with a given public vocabulary file.

A word is encoded by merging: a priority queue of merge ranks over a doubly linked list of
symbols; entries whose symbols have changed meanwhile are skipped when they come up. Decoding
joins vocabulary strings. Words repeat, so each Python worker remembers what words became,
up to a fixed number of words. The vocabulary file is read once on the driver and broadcast:
its size does not depend on the data.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import gives_back, worker_model

#: Words a Python worker remembers before it starts afresh (about 80 MB).
MEMO_WORDS = 400_000
#: Characters of text after which a result batch is handed on.
FLUSH_CHARS = 2_000_000

#: White space as Unicode's White_Space property has it (fixed values).
SPACE = "\t-\r \x85\xa0  -     　"
#: Contractions that are words of their own (fixed values).
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Code points below this are matched with plain classes, the others by Unicode properties.
LATIN_END = 0x250


def _latin(category: str) -> str:
    return "".join(
        chr(c) for c in range(LATIN_END) if unicodedata.category(chr(c)).startswith(category)
    )


def _word_pattern(letter: str, number: str):
    return f"[{letter}]+|{CONTRACTIONS}|[{number}]|[^{SPACE}{letter}{number}]+"


_LATIN_WORDS = re.compile(_word_pattern(_latin("L"), _latin("N")))
_WORDS = regex.compile(_word_pattern(r"\p{L}", r"\p{N}"))
_BEYOND_LATIN = re.compile(f"[^\x00-{chr(LATIN_END - 1)}]")


def lower_case(text: str) -> str:
    """Lower case letter by letter: the final sigma gets no form of its own."""
    return text.replace("Σ", "σ").lower()


def words_of(text: str) -> list[str]:
    """The words of a text without special tokens, normalised."""
    text = lower_case(unicodedata.normalize("NFC", text))
    return (_WORDS if _BEYOND_LATIN.search(text) else _LATIN_WORDS).findall(text)


@lru_cache
def byte_symbols() -> list[str]:
    """A printable character for each byte: itself where it is printable, else the next
    unused one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(byte if byte in shown else next(hidden)) for byte in range(256)]


class Vocabulary:
    """A vocabulary file's words, merges and special tokens, and what words became."""

    def __init__(self, file: bytes):
        self.file = file
        content = json.loads(file)
        model = content["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # Pairs and entries of the queue are whole numbers: cheap to hash and to compare.
        self.ranks, self.merged = {}, []
        for rank, (left, right) in enumerate(pairs):
            self.ranks[self.ids[left] << 32 | self.ids[right]] = rank
            self.merged.append(self.ids[left + right])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        table = byte_symbols()
        self.byte_ids = [self.ids[c] for c in table], [self.ids[c + self.suffix] for c in table]
        self.strings = {i: s for s, i in (self.ids | self.special).items()}
        self.word_end = np.zeros(max(self.strings) + 1, bool)
        if self.suffix:
            self.word_end[[i for i, s in self.strings.items() if s.endswith(self.suffix)]] = True
        alternatives = "|".join(re.escape(s) for s in self.special)
        self.special_split = re.compile(f"({alternatives})" if alternatives else r"(?!)()")

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours by ascending rank, of equal rank from the left."""
        rank_of, merged, end = self.ranks.get, self.merged, len(symbols)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        # The rank of the pair that begins at a place; an entry of another rank is stale.
        current = [rank_of(a << 32 | b) for a, b in zip(symbols, symbols[1:])]
        current.append(None)
        queue = [rank << 32 | at for at, rank in enumerate(current) if rank is not None]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            rank, at = entry >> 32, entry & 0xFFFFFFFF
            if current[at] != rank:
                continue
            right = after[at]
            symbol = symbols[at] = merged[rank]
            symbols[right] = current[right] = None
            beyond = after[at] = after[right]
            if beyond < end:
                before[beyond] = at
                rank = current[at] = rank_of(symbol << 32 | symbols[beyond])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | at)
            else:
                current[at] = None
            left = before[at]
            if left >= 0:
                rank = current[left] = rank_of(symbols[left] << 32 | symbol)
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | left)
        return [symbol for symbol in symbols if symbol is not None]

    def word_ids(self, word: str) -> list[int]:
        inner, final = self.byte_ids
        codes = word.encode()
        return self.merge([*map(inner.__getitem__, codes[:-1]), final[codes[-1]]])

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text cut at special tokens: (is special, string)."""
        for at, part in enumerate(self.special_split.split(text)):
            if part:
                yield at % 2 == 1, part


class _Ids(dict):
    """word -> its ids as little-endian 32-bit integers."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
        ids = self.vocab.word_ids(word)
        value = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return value


class Codec:
    """Encodes whole texts with what a worker remembers of words, and decodes ids."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._library = None
        # Words met of late and those met before; plain: sets are compared at native speed.
        self._met: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        self.word_ids = _Ids(vocab)
        self.special = {s: struct.pack("<I", i) for s, i in vocab.special.items()}

    def encode(self, text: str) -> bytes:
        """A text's ids as little-endian 32-bit integers."""
        return b"".join(
            self.special[part] if special else b"".join(map(self.word_ids.__getitem__, words_of(part)))
            for special, part in self.vocab.parts(text)
        )

    def library(self):
        """The tokenizers library with the same file, for what only it can tell."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.vocab.file.decode())
            self._library.no_truncation()
            self._library.no_padding()
        return self._library

    def met(self, words: Iterable[str], most: int) -> dict[str, bytes]:
        """word -> ids, for at least these words, by the library; of up to ``most`` words, where
        these are not more. When memory fills, words not met since it last did are dropped."""
        wanted = words if isinstance(words, set) else set(words)
        missing = wanted.difference(self._met)
        if missing:
            if len(self._met) + len(missing) > most // 2:
                self._before, self._met, missing = self._met, {}, wanted
            before = self._before  # an intersection would go through all of it
            self._met.update((word, before[word]) for word in missing if word in before)
            self._encode_new(list(missing.difference(self._met)))
        return self._met

    def encode_many(self, texts: list[str], most: int) -> list[bytes]:
        """Whole texts as little-endian 32-bit ids; words not met before by one library call."""
        parts = [
            [self.special[part] if special else words_of(part) for special, part in self.vocab.parts(text)]
            for text in texts
        ]
        known, missing, found = self._met.get, set(), []
        for own in parts:
            for part in own:
                if isinstance(part, list):
                    ids = list(map(known, part))
                    if None in ids:
                        missing.update(word for word, one in zip(part, ids) if one is None)
                    found.append(ids)
        now = self.met(missing, most).__getitem__
        each = iter(found)
        out = []
        for own in parts:
            blobs = []
            for part in own:
                if isinstance(part, list):
                    ids = next(each)
                    if None in ids:
                        ids = [now(word) if one is None else one for word, one in zip(part, ids)]
                    blobs += ids
                else:
                    blobs.append(part)
            out.append(b"".join(blobs))
        return out

    def _encode_new(self, words: list[str]) -> None:
        """Many words in one call: the last id of each is known from its end-of-word mark."""
        if not words:
            return
        encode = self.library().encode_batch_fast  # ids alone, no offsets
        ids = np.array(encode([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.vocab.word_end[ids]) + 1
        if len(ends) != len(words):
            for word in words:
                one = encode([word], add_special_tokens=False)[0].ids
                self._met[word] = np.array(one, "<u4").tobytes()
            return
        raw, start = ids.tobytes(), 0
        for word, end in zip(words, ends.tolist()):
            self._met[word] = raw[4 * start : 4 * end]
            start = end

    def decode(self, ids: np.ndarray) -> str:
        """Vocabulary strings, special tokens too, joined by one space: the file names no
        decoder, so nothing else is done to them."""
        return " ".join(map(self.vocab.strings.__getitem__, ids.tolist()))


def codec(file: bytes) -> Codec:
    """One codec per Python worker and file content."""
    return worker_model(("codec", hashlib.md5(file).digest()), lambda: Codec(Vocabulary(file)))


def id_lists(blobs: list[bytes]) -> pa.Array:
    """Lists of ids from their bytes, without a Python object per id."""
    ends = np.cumsum([0, *(len(b) // 4 for b in blobs)], dtype=np.int64)
    values = np.frombuffer(b"".join(blobs), "<i4")
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(values)).cast(
        pa.list_(pa.int32())
    )


@gives_back
def _encode_batches(batches: Iterator[pa.RecordBatch], file) -> Iterator[pa.RecordBatch]:
    coder = codec(file.value)
    for batch in batches:
        start, chars, blobs = 0, 0, []
        for at, text in enumerate(batch.column(1)):
            value = text.as_py() or ""
            blobs.append(coder.encode(value))
            chars += len(value)
            if chars > FLUSH_CHARS or at == len(batch) - 1:
                ids = batch.column(0).slice(start, at + 1 - start)
                yield pa.RecordBatch.from_arrays([ids, id_lists(blobs)], names=["id", "ids"])
                start, chars, blobs = at + 1, 0, []


@gives_back
def _decode_batches(batches: Iterator[pa.RecordBatch], file) -> Iterator[pa.RecordBatch]:
    coder = codec(file.value)
    for batch in batches:
        texts = [coder.decode(ids.values.to_numpy()) if ids.is_valid else None for ids in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], names=["id", "ids", "decoded"]
        )


def broadcast_file(docs: DataFrame, path: str):
    """A vocabulary file for all executors; a few MB, whatever the data."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row as ``id_column, ids array<int>``, in one narrow pass.

    NULL and empty text give no ids. Rows may repeat, ids may be NULL; other columns of the
    input are not read. Special tokens of the file that stand in a text become their ids; text
    is otherwise normalised (NFC, lower case, white space dropped).
    """
    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string")).mapInArrow(
        partial(_encode_batches, file=broadcast_file(docs, path)), "id long, ids array<int>"
    ).withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """Rows of ``encode`` with ``decoded string``; NULL ids stay NULL, no ids give ``""``."""
    return encoded.select(F.col(id_column).alias("id"), "ids").mapInArrow(
        partial(_decode_batches, file=broadcast_file(encoded, path)),
        "id long, ids array<int>, decoded string",
    ).withColumnRenamed("id", id_column)
