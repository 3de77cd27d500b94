"""Quality rules and language ID: held-out accuracy, and what they do to unusual texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import language_id, quality, queries
from tripweave.llm.common import crc_fold, table

SF_DIR = "/root/testdata/sf0.01"

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "12 34 !!"), (5, "Ünïted " * 20_000), (None, "some words"), (1, "again")]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr(
        "*", "'q' as score", "'z' as lang_pred", "1.5 as stat_chars", "2 as row_id"
    )


@pytest.fixture(scope="module")
def model(spark):
    return queries.quality_model(spark, table(spark, SF_DIR, "documents"), SF_DIR)


@pytest.fixture(scope="module")
def samples(spark):
    return queries.language_samples(table(spark, SF_DIR, "documents"))


def test_quality_of_held_out_documents(spark):
    scored = queries.op2_quality_classifier(spark, SF_DIR)
    assert scored.count() == table(spark, SF_DIR, "documents").count()
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0
    held = scored.where("held_out").join(table(spark, SF_DIR, "labels"), "doc_id").toPandas()
    for label in (0, 1):
        part = held[held.quality == label]
        assert len(part) >= 5
        assert (part.predicted == label).mean() >= 0.95


def test_model_as_a_column_equals_the_rules(spark, model):
    docs = table(spark, SF_DIR, "documents")
    measured, names = quality.statistics(docs, "text")
    rows = measured.select(*names, model.score().alias("score")).toPandas()
    x = rows[names].to_numpy()
    total = np.full(len(x), model.base)
    for bounds, weight in model.rules:
        total += weight * np.logical_and.reduce([b.holds(x) for b in bounds])
    assert np.allclose(1 / (1 + np.exp(-total)), rows["score"])
    assert 1 <= len(model.rules) <= 150


def test_quality_of_odd_rows(spark, model):
    scored = quality.score(odd(spark), model).collect()
    assert sorted(str(r.doc_id) for r in scored) == sorted(str(name) for name, _ in ODD)
    assert all(0 <= r.score <= 1 for r in scored)
    kept = quality.keep_good(odd(spark), model)
    assert kept.columns == odd(spark).columns


def test_quality_without_labels_or_with_one(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    nothing = quality.train(docs, labels, F.lit(True))
    assert [r.score for r in quality.score(docs, nothing).collect()] == [0.5, 0.5]
    only = quality.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), F.lit(True))
    assert all(r.score > 0.9 for r in quality.score(docs, only).collect())
    assert quality.score(docs.limit(0), only).collect() == []


def test_held_out_labels_teach_nothing(spark, model):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    fold = crc_fold("doc_id", 4)
    turned = labels.withColumn("quality", F.when(fold == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, turned, fold != 2) == model


def matches(sample: str, text: str) -> int:
    """Phrases of a block, by searching the sample itself."""
    phrases, at = 0, 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        phrases, at = phrases + 1, at + max(size, 1)
    return phrases


def test_phrases_equal_a_search_of_the_sample():
    draw = random.Random(4)
    samples = {k: "".join(draw.choice(a) for _ in range(300)).strip() for k, a in (("x", "abc "), ("y", "abcde"))}
    languages = language_id.Languages(samples)
    texts = ["".join(draw.choice("abcdefé 7") for _ in range(draw.randrange(700))) for _ in range(60)]
    encoded = [languages.encoded(t) for t in texts]
    back = {v: k for k, v in languages.symbols.items()}
    costs = languages.costs(encoded)
    for codes, row in zip(encoded, costs):
        letters = "".join(back.get(int(c), "\0") for c in codes)
        if not letters:
            assert np.isinf(row).all()
            continue
        for at, name in enumerate(languages.names):
            phrases = sum(
                matches(samples[name], letters[i : i + language_id.BLOCK])
                for i in range(0, len(letters), language_id.BLOCK)
            )
            assert row[at] == pytest.approx(phrases * np.log2(len(samples[name])) / len(letters))


def test_encoding_is_the_normal_form():
    languages = language_id.Languages({"x": "abc é ß"})
    back = {v: k for k, v in languages.symbols.items()}
    for text in ("", "  ", "A--b  C!", "1a2", "ßé É", " a", "a "):
        codes = languages.encoded(text)
        assert "".join(back[int(c)] for c in codes) == language_id.normal(text)


def test_letters_of_far_planes_are_learned_ones():
    adlam = "".join(map(chr, range(0x1E922, 0x1E944)))
    languages = language_id.Languages({"a": "abc def", "ff": f"{adlam} {adlam[::-1]}"})
    texts = [languages.encoded(t) for t in (f"{adlam[3:20]} \U0001F600 {adlam[:9]}", adlam[5:].upper(), "\U00010330\U00010331")]
    assert [name for name, *_ in languages.predict(texts)[:2]] == ["ff", "ff"]
    assert 0 not in texts[0] and 0 not in texts[1] and set(texts[2]) == {0}


def test_no_document_fills_a_sample_alone(spark):
    # Each long text is of one letter in its first half and of another in its second.
    long = [chr(97 + k) * 30_000 + " " + chr(107 + k) * 30_000 for k in range(6)]
    rows = [(k, text, "x") for k, text in enumerate(long)] + [(10, "zzz short", "x"), (11, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language_id.train(docs, F.lit(True))["x"]
    assert 23_900 < len(sample) <= language_id.SAMPLE_SYMBOLS and "zzz short" in sample
    for k in range(6):
        assert all(1_900 < sample.count(chr(at + k)) < 2_100 for at in (97, 107))


def test_language_of_held_out_documents(spark):
    found = queries.op6_language_id(spark, SF_DIR)
    held = found.where("held_out").join(
        table(spark, SF_DIR, "documents").select("doc_id", "lang"), "doc_id"
    ).toPandas()
    assert len(held) > 250
    assert (held.lang == held.lang_pred).mean() >= 0.98


def test_languages_of_odd_rows(spark, samples):
    got = sorted(map(tuple, language_id.predict(odd(spark), samples).collect()), key=str)
    assert [r[1:] for r in got if r[0] in (2, 3, 4)] == [("und", 0.0)] * 3
    assert (1, "und", 0.0) in got
    assert all(0.5 <= r[2] <= 1 for r in got if r[1] != "und")
    # Without a limit all texts with letters stay; these few words are in no learned language.
    kept = language_id.keep_known(odd(spark), samples, most_bits=99.0)
    assert kept.columns == odd(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "5", "None"]
    learned = spark.createDataFrame([(1, samples["en"][:80]), (2, "Ünïted " * 9)], "doc_id long, text string")
    assert [r.doc_id for r in language_id.keep_known(learned, samples).collect()] == [1]


def test_no_samples_and_no_rows(spark, samples):
    docs = spark.createDataFrame([(1, "word", None)], "doc_id long, text string, lang string")
    nothing = language_id.train(docs, F.lit(True))
    assert nothing == {}
    assert tuple(language_id.predict(docs, nothing).first()) == (1, "und", 0.0)
    assert language_id.predict(docs.limit(0), samples).collect() == []


def test_samples_are_bounded_and_ignore_held_out_rows(spark, samples):
    docs = table(spark, SF_DIR, "documents")
    assert all(0 < len(s) <= language_id.SAMPLE_SYMBOLS for s in samples.values())
    fold = crc_fold("doc_id", 3)
    turned = docs.withColumn("lang", F.when(fold == 1, "zz").otherwise(F.col("lang")))
    assert language_id.train(turned, fold != 1) == samples
