"""LM scoring: a model of plain dictionaries, pieces and lanes of any size, held-out texts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import lm_scoring, queries
from tripweave.llm.lm_scoring import Smoothing

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = {i: i + 32 for i in range(65, 91)}


def brute_force(docs, learned, smoothing):
    """(n_tokens, n_known, train_tokens, base, score) of each text, by dictionaries."""
    order = smoothing.order
    texts = [[("s",)] * (order - 1) + WORD.findall((t or "").translate(SMALL)) + [("e",)] for t in docs]
    single = Counter(w for t, use in zip(texts, learned) if use for w in t[order - 1 :])
    held, history = Counter(), Counter()
    for t, use in zip(texts, learned):
        for i in range(order - 1, len(t)) if use else ():
            for n in range(1, order):
                held[tuple(t[i - n : i + 1])] += 1
                history[tuple(t[i - n : i])] += 1
    total, distinct = sum(single.values()), len(single)

    def chance(words):
        if len(words) == 1:
            return (single[words[0]] + 0.5) / (total + 0.5 * (distinct + 1))
        seen, shorter = history[words[:-1]], chance(words[1:])
        if not seen:
            return shorter
        b = smoothing.shares[len(words) - 2] / seen ** smoothing.powers[len(words) - 2]
        return (1 - b) * held[words] / seen + b * shorter

    for t in texts:
        own = t[order - 1 :]
        yield (
            len(own),
            sum(single[w] > 0 for w in own),
            total,
            sum(math.log10(chance((w,))) for w in own),
            sum(math.log10(chance(tuple(t[i - order + 1 : i + 1]))) for i in range(order - 1, len(t))),
        )


def made(seed=3):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "ÉÉ", "x\u0085y", "𝒳", "a-b", "</s>", "<s>", "w" * 50]
    docs = [
        rng.choice([" ", "\n", " \t "]).join(rng.choices(words[: rng.choice([3, 11])], k=rng.choice([0, 1, 2, 9, 60])))
        for _ in range(120)
    ]
    docs += ["the of é the of"] * 60 + [None, "", " \n ", "never seen words", "the " * 3000]
    docs += ["".join(rng.choices("abc  \n", k=9000))]
    rows = [(i if i % 7 else None, t, i % 3 > 0) for i, t in enumerate(docs)]
    return rows + rows[:2]


def check(spark, rows, smoothing):
    frame = spark.createDataFrame(rows, "doc_id long, text string, use boolean").selectExpr(
        "*", "1 as learned", "2 as row", "3 as part", "4 as block", "5 as n_tokens"
    )
    got = lm_scoring.score_texts(frame, F.col("use"), smoothing).collect()
    want = brute_force([t for _, t, _ in rows], [u for *_, u in rows], smoothing)
    order = lambda r: (repr(r[0]), r[1], *r[2:5], round(r[5], 6), round(r[6], 6))
    found = sorted((tuple(r) for r in got), key=order)
    expected = sorted(((i, bool(u), *w) for (i, _, u), w in zip(rows, want)), key=order)
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    return got


@pytest.mark.parametrize(
    "smoothing", [Smoothing(), Smoothing((), ()), Smoothing((0.5,), (0.5,)), Smoothing((0.8, 0.9, 0.5), (0.2, 0.1, 0.0))]
)
def test_as_dictionaries(spark, smoothing):
    check(spark, made(), smoothing)


@pytest.fixture
def small_parts(spark, monkeypatch):
    """Sizes that cut the made texts into many pieces, blocks, ranges and lanes; they are read
    where tasks run, so the operators are given to tasks with them."""

    def run(rows, smoothing):
        names = ("BLOCK_BYTES", "PIECE_BYTES", "RANGE_BYTES", "LANE")
        for name, size in zip(names, (700, 90, 400, 5)):
            monkeypatch.setattr(lm_scoring, name, size)
        frame = [(*row[:2], row[2]) for row in rows]
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in frame], pa.int64()),
                pa.array([r[2] for r in frame]),
                pa.array([(r[1] or "").encode() for r in frame], pa.binary()),
                pa.array([3] * len(frame)),
            ],
            names=["doc_id", "learn", "text", "source"],
        )
        ranges, bits = 17, 60
        counts = [
            row
            for b in lm_scoring._count_batches(iter([batch]), smoothing.order, ranges, bits)
            for row in zip(*(c.to_pylist() for c in b.columns))
        ]
        counts.sort()
        answers = [
            row
            for b in lm_scoring._total_batches(iter([lm_scoring._batch(counts, lm_scoring._COUNTS)]))
            for row in zip(*(c.to_pylist() for c in b.columns))
        ]
        tokens, distinct = sum(a[5] for a in answers), sum(a[6] for a in answers)
        for b in lm_scoring._text_batches(iter([batch]), smoothing.order):
            answers += zip(*(c.to_pylist() for c in b.columns))
        answers.sort(key=lambda a: a[:3])
        sent = pa.RecordBatch.from_arrays(
            [pa.array([a[i] for a in answers]) for i in (0, 1, 4, 3)], names=["block", "kind", "payload", "mark"]
        )
        out = {}
        model = dict(ranges=ranges, bits=bits, tokens=tokens, distinct=distinct, smoothing=smoothing)
        blocks = 0
        for b in lm_scoring._score_batches(iter([sent]), **model):
            blocks += 1
            for _, row, _, _, *numbers in zip(*(c.to_pylist() for c in b.columns)):
                out[row] = tuple(np.add(out.get(row, (0, 0, 0, 0)), numbers))
        assert blocks > 20
        return [out[i] for i in range(len(rows))], tokens

    return run


def test_pieces_blocks_ranges_and_lanes(small_parts):
    rows, smoothing = made(8), Smoothing()
    got, tokens = small_parts(rows, smoothing)
    want = list(brute_force([t for _, t, _ in rows], [u for *_, u in rows], smoothing))
    for (n, known, base, score), expected in zip(got, want):
        assert (n, known, tokens) == expected[:3]
        assert (base, score) == pytest.approx(expected[3:], rel=1e-9)


def test_every_word_after_every_history():
    """The chances of all next words, the end and one unknown word add up to 1."""
    texts, words = ["a b a", "b a c", "a a", ""], ["a", "b", "c", "zz"]
    for before in ("", "a", "b", "a b", "q a", "a zz", "c b a"):
        block = lm_scoring.Block(
            [
                *(lm_scoring.Piece(i, i, True, True, True, b"", t.encode()) for i, t in enumerate(texts)),
                *(lm_scoring.Piece(9, 9, False, True, True, b"", f"{before} {w}".encode()) for w in [*words, ""]),
            ],
            3,
        )
        counts, total = block.counts(), Counter(w for t in texts for w in [*t.split(), "end"])
        automaton = lm_scoring.Automaton.of(block, counts, total.total(), len(total), Smoothing())
        # The walk over the history alone is the same for all: its lanes are cut before w.
        block.size[len(texts) :] = len(before.split()) + 1
        whole = automaton.walk()[len(texts) :]
        block.size[len(texts) :] -= 1
        history = automaton.walk()[len(texts) :]
        assert sum(10 ** (whole - history)) == pytest.approx(1)


def test_no_rows_and_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm_scoring.score_texts(empty, F.lit(True)).collect() == []
    check(spark, [(1, "a b", False), (2, None, False), (3, "a", None)], Smoothing())


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    learned = [zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for r in docs]
    want = {
        r.doc_id: w
        for r, w in zip(docs, brute_force([r.text for r in docs], learned, Smoothing()))
    }
    got = queries.op11_lm_scoring(spark, SF_DIR).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        n, known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert (r.base_score, r.score) == pytest.approx((base, score), rel=1e-9)


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    got = queries.op11_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out").collect()
    tokens = sum(r.n_tokens for r in got)
    assert sum(r.score - r.base_score for r in got) / tokens > 0.3
    assert np.mean([r.score > r.base_score for r in got]) > 0.75
