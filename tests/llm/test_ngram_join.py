"""The n-gram Jaccard join against all pairs of the sets themselves."""

import random

import pytest
from oracle_check import compare, duckdb_on
from pyspark.sql import functions as F

from tripweave.llm import ngram_join, queries
from tripweave.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def brute(texts: dict[int, str | None], width: int, percent: int) -> dict[int, tuple[int, int]]:
    sets = {}
    for name, text in texts.items():
        words = (text or "").encode().lower().split()
        if len(words) < width:
            sets[name] = {tuple(words)} if words else set()
        else:
            sets[name] = set(zip(*(words[i:] for i in range(width))))
    least = {name: name for name in sets}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                least[max(x, y)] = min(x, y)
    return {name: (len(sets[name]), root(name)) for name in sets}


def found(df) -> dict[int, tuple[int, int]]:
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def variants(seed: int) -> dict[int, str]:
    """Texts at every distance from their originals, in groups large and small."""
    draw = random.Random(seed)
    texts = {}
    for size, copies in ((1, 3), (3, 4), (12, 6), (40, 20), (200, 25), (900, 6)):
        base = [f"w{draw.randrange(400)}" for _ in range(size)]
        for copy in range(copies):
            words = list(base)
            for _ in range(draw.randrange(1 + size // 10)):
                words[draw.randrange(size)] = f"x{draw.randrange(10**6)}"
            texts[len(texts)] = " ".join(words).upper() if copy == 1 else "\t".join(words)
    return texts


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_all_links_between_variants(spark, width, percent):
    texts = variants(width)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    # Blocks of three rows: groups are cut and every two chunks still meet, as pairs or inside.
    for most in (0, 4):
        got = ngram_join.ngram_classes(docs, width=width, percent=percent, block=3, pairs_a_member=most)
        assert found(got) == brute(texts, width, percent)


def family(size, words=120, changed=5, seed=3):
    """Texts of one origin, each with a few words changed: most pairs are just below 0.9."""
    import random

    rng = random.Random(seed)
    origin = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for at in range(size):
        text = origin[:]
        for place in rng.sample(range(words), rng.randrange(changed)):
            text[place] = f"x{rng.randrange(10**6)}"
        yield at, " ".join(text)


def test_a_dense_family_gives_no_row_for_a_pair(spark):
    texts = dict(family(150))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = [ngram_join.shingles(t.encode(), 3) for t in texts.values()]
    rows = [(0, at, at, len(s), ngram_join._sketch(s).tobytes()) for at, s in enumerate(sets)]
    tried = ngram_join._tried_block((1, 0, 0), rows, 90, 4)
    assert len(tried) <= len(rows) and all(row[4] is None for row in tried)
    assert found(ngram_join.ngram_classes(docs, width=3, percent=90)) == brute(texts, 3, 90)


def test_given_documents(spark):
    name = "op1_ngram_jaccard_join"
    assert compare(spark, duckdb_on(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) == []
    docs = table(spark, SF_DIR, "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert found(ngram_join.ngram_classes(docs, width=5, percent=80)) == brute(texts, 5, 80)


def test_nulls_blanks_repeats_and_clashing_columns(spark):
    rows = [
        (4, "a b c d"), (2, "A  b\nc d"), (7, None), (8, ""), (9, " \t"), (None, "a b c d"),
        (4, "a b c d"), (11, "only two"), (5, "only two"), (12, " "),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as size", "2 as node", "3 as component_id", "4 as n_shingles"
    )
    got = sorted(map(tuple, ngram_join.ngram_classes(docs, width=3, percent=90).collect()), key=str)
    assert got == sorted(
        [(4, 2, 2), (4, 2, 2), (2, 2, 2), (None, 2, None), (7, 0, 7), (8, 0, 8), (9, 0, 9),
         (11, 1, 5), (5, 1, 5), (12, 1, 12)],
        key=str,
    )


def test_a_row_without_id_hides_no_copy(spark):
    text = " ".join(f"w{n}" for n in range(60))
    rows = [(None, text), (7, text), (3, text + " more"), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_classes(docs, width=3, percent=90).collect()}
    assert got == {None: None, 7: 3, 3: 3}


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.ngram_classes(docs).collect() == []


def test_one_of_each_class_stays(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    classes = docs.select("doc_id", F.when(F.col("text") == "a", 1).otherwise(3).alias("component_id"))
    assert sorted(r.doc_id for r in ngram_join.keep_one_of_each(docs, classes).collect()) == [1, 3]


def test_similar_sizes_are_in_neighbouring_bands():
    for percent in (50, 80, 90, 97):
        limits = ngram_join.size_bands(percent, 3000)
        band = {}
        for at, (low, high) in enumerate(zip(limits, limits[1:])):
            band |= dict.fromkeys(range(low, min(high, 3000)), at)
        for a in range(1, 2000):
            b = min(a * 100 // percent, 2999)
            assert band[b] - band[a] <= 1
