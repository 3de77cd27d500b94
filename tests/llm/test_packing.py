"""Packing: every token in its place, no gaps, and few sequences."""

import bisect
import itertools
import random
import sys
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripweave.llm import bpe, common, language_id, ngram_join, packing
from tripweave.llm.common import table
from tripweave.llm.queries import word_bpe

SF_DIR = "/root/testdata/sf0.001"


def fewest(lengths: tuple[int, ...], capacity: int) -> int:
    """The least number of sequences, by trying every assignment."""
    best = len(lengths)

    def place(at: int, rooms: list[int]) -> None:
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= lengths[at] and rooms[i] not in rooms[:i]:
                rooms[i] -= lengths[at]
                place(at + 1, rooms)
                rooms[i] += lengths[at]
        place(at + 1, [*rooms, capacity - lengths[at]])

    place(0, [])
    return best


def piece_by_piece(counts: dict[int, int], capacity: int) -> int:
    """Sequences of best fit by falling length, one piece at a time."""
    rooms: list[int] = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect.bisect_left(rooms, length)
            room = rooms.pop(at) if at < len(rooms) else capacity
            bisect.insort(rooms, room - length)
    return len(rooms)


def counted(lengths) -> dict[int, int]:
    return {n: list(lengths).count(n) for n in set(lengths)}


def test_fixed_sets_belong_to_a_best_packing():
    draw = random.Random(5)
    reduced = 0
    for _ in range(400):
        lengths = tuple(sorted((draw.randint(2, 12) for _ in range(draw.randint(1, 9))), reverse=True))
        fixed, left = packing.reduce_by_dominance(counted(lengths), 12)
        rest = tuple(sorted(itertools.chain(*([n] * k for n, k in left.items())), reverse=True))
        done = [n for group, times in fixed for n in group * times]
        assert sorted([*done, *rest]) == sorted(lengths)
        assert all(sum(group) <= 12 for group, _ in fixed)
        reduced += bool(fixed)
        times = sum(n for _, n in fixed)
        assert times + fewest(rest, 12) == fewest(lengths, 12)
    assert reduced > 100


def test_reduction_goes_on_behind_a_piece_without_a_set():
    # Nothing dominates for 70: 25, 17 and 13 fit beside it in several ways. 60 and 40 fill a sequence.
    fixed, left = packing.reduce_by_dominance({70: 1, 60: 3, 40: 2, 25: 1, 17: 1, 13: 1, 3: 4}, 100)
    assert ((60, 40), 2) in fixed and left[70] == 1 and 40 not in left


def test_plans_place_every_piece_once_without_gaps():
    draw = random.Random(8)
    for capacity, most in ((12, 40), (2048, 60)):
        for _ in range(20):
            counts = {draw.randint(1, capacity): draw.randint(1, most) for _ in range(draw.randint(0, 60))}
            seen, spans = {n: [] for n in counts}, {}
            for length, first, pieces, sequence, offset in packing.plan(counts, capacity):
                seen[length].append((first, first + pieces))
                for k in range(pieces):
                    spans.setdefault(sequence + k, []).append((offset, offset + length))
            for length, ranges in seen.items():
                ranges.sort()
                assert [a for a, _ in ranges] == [0, *(b for _, b in ranges[:-1])]
                assert ranges[-1][1] == counts[length]
            for parts in spans.values():
                parts.sort()
                assert [a for a, _ in parts] == [0, *(b for _, b in parts[:-1])]
                assert parts[-1][1] <= capacity
            assert len(spans) <= piece_by_piece(counts, capacity)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_documents(spark, capacity):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text", F.lit(1).alias("length"), F.lit(2).alias("number"))
    extra = spark.createDataFrame(
        [(-1, None), (-2, ""), (None, "no name"), (-3, "long text " * 5000), (-4, "again"), (-4, "again")],
        "doc_id long, text string",
    ).selectExpr("*", "1 as length", "2 as number")
    docs = docs.unionByName(extra)
    rows = packing.pack(docs, word_bpe(), capacity=capacity, with_ids=True).collect()
    library = Tokenizer.from_file(word_bpe())
    expected = []
    for row in docs.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            raw = np.array(ids[start : start + capacity], "<u4").tobytes()
            expected.append((row.doc_id, piece, start, len(raw) // 4, zlib.crc32(raw), raw))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == [0, *(b for _, b in parts[:-1])]
        assert parts[-1][1] <= capacity
    total = sum(r.length for r in rows)
    assert len(sequences) <= 1.05 * total / capacity + 1


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(empty, word_bpe()).collect() == []


def test_a_worker_holds_few_texts_at_a_time(spark, monkeypatch):
    from tripweave.llm import packing
    from tripweave.llm.queries import word_bpe

    name, seen, real = "spark.sql.execution.arrow.maxRecordsPerBatch", [], packing.written

    def noted(df, label):
        seen.append(int(spark.conf.get(name)))
        return real(df, label)

    monkeypatch.setattr(packing, "written", noted)
    before = spark.conf.get(name)
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    assert packing.pack(docs, word_bpe()).count() == 3_000
    assert seen == [packing.BATCH_ROWS] and packing.BATCH_ROWS < int(before)
    assert spark.conf.get(name) == before


def test_remembered_words_take_little_memory():
    with open(word_bpe(), "rb") as file:
        coder = bpe.Codec(bpe.Vocabulary(file.read()))
    own = packing.MEMO_WORDS // 2
    for batch in range(3):
        coder.met({f"w{batch}x{word:x}" for word in range(own)}, packing.MEMO_WORDS)
    kept = [coder._met, coder._before]
    assert [len(words) for words in kept] == [own, own]
    held = sum(sys.getsizeof(x) for words in kept for pair in words.items() for x in pair)
    assert held + sum(map(sys.getsizeof, kept)) < 80_000_000


def test_a_new_model_finds_the_memory_of_the_last_given_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "_model", [("last",), "a model"])
    monkeypatch.setattr(common, "release_memory", lambda: calls.append(list(common._model)))
    for _ in range(2):
        assert common.worker_model(("next",), lambda: "the next") == "the next"
    assert calls == [[None, None]]
    monkeypatch.undo()
    common.release_memory()


def test_a_worker_without_a_task_gives_its_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "_model", [("own",), "a model"])
    monkeypatch.setattr(common, "release_memory", lambda: calls.append(list(common._model)))
    monkeypatch.setattr(common, "IDLE_SECONDS", 0.05)
    monkeypatch.setattr(common, "_tasks", [0, 10**6])  # timers of other tests find another number
    work = common.gives_back(lambda batches: iter(batches))
    first, second = work([1, 2]), work([3])
    assert next(first) == 1 and list(second) == [3]
    time.sleep(0.5)
    assert not calls and common._model[1] == "a model"  # the first still runs
    assert list(first) == [2]
    until = time.time() + 20
    while not calls and time.time() < until:
        time.sleep(0.05)
    assert calls == [[None, None]]
    monkeypatch.undo()


def test_the_work_of_packing_gives_its_memory_back():
    for work in (packing._piece_batches, language_id._predict_batches, ngram_join._sketch_batches):
        assert work.__wrapped__.__name__ == work.__name__
