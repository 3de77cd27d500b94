"""Ranked search: brute force over every pair, and SQL on the given tables."""

import math
import random
import re
from collections import Counter

from oracle_check import compare, duckdb_on

from tripweave.llm import queries, ranked_search

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def brute_force(docs, items, most):
    bags = [(doc_id, terms(text)) for doc_id, text in docs]
    bags = [(doc_id, len(bag), Counter(bag)) for doc_id, bag in bags if bag]
    total, df = sum(n for _, n, _ in bags), Counter(t for *_, bag in bags for t in bag)
    out = []
    for item_id, text in {row for row in items if row[1]}:
        asked = terms(text)
        found = []
        for doc_id, n, bag in bags:
            m = 25 + 75 * n * len(bags) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1)))
                * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in asked
                if t in bag
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(found)[:most], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


def frames(spark, docs, items):
    more = ("1 as m", "2 as n", "'x' as vector", "3 as rank", "4 as term")
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", *more),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "9 as doc_id"),
    )


def made(seed=5):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "ÜBER", "x1", "𝒳", "rare", "a-b", "z_z", "long" * 30]
    docs = [
        (i, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=rng.choice([1, 3, 9, 40]))))
        for i in range(300)
    ]
    docs += [(1000 + i, "the rare é of x1") for i in range(200)]  # one large class
    docs += [(None, "the rare"), (None, "the rare é of x1"), (7, "rare"), (7, "rare"), (-3, "rare é")]
    docs += [(5000, None), (5001, ""), (5002, " -- "), (5003, "the " * 20_000 + "rare")]
    items = [
        (0, "the rare of"), (1, "rare rare é"), (2, "unknown words"), (3, None), (4, ""), (5, "!"),
        (None, "über x1"), (0, "the rare of"), (0, "z b"), (6, "the " * 50), (-1, "The"),
    ]
    return docs, items


def test_as_brute_force(spark, monkeypatch):
    docs, items = made()
    for most, cells in ((10, ranked_search.CELLS), (3, 40)):
        monkeypatch.setattr(ranked_search, "CELLS", cells)
        got = rows_of(ranked_search.rank_documents(*frames(spark, docs, items), most=most))
        assert got == brute_force(docs, items, most)


def test_items_in_blocks(spark):
    docs, items = made(6)
    got = rows_of(ranked_search.rank_documents(*frames(spark, docs, items), item_bytes=60))
    assert got == brute_force(docs, items, 10)


def test_slices_cut_between_terms(monkeypatch):
    text = ("ab Cd é" * 30 + "x" * 40 + ", y" + "q" * 25).encode()
    whole = [t for part in ranked_search._term_lists(text) for t in part]
    assert [t.decode() for t in whole] == terms(text.decode())
    for size in (1, 7, 16, 33):
        monkeypatch.setattr(ranked_search, "SLICE", size)
        assert [t for part in ranked_search._term_lists(text) for t in part] == whole


def test_no_rows(spark):
    docs, items = made()
    for d, i in (([], items), (docs, []), ([], []), ([(1, None)], items)):
        assert ranked_search.rank_documents(*frames(spark, d, i)).collect() == []


def test_given_documents(spark):
    name = "op12_ranked_lexical_search"
    assert compare(spark, duckdb_on(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) == []
