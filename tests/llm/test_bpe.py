"""Encoding and decoding against the tokenizers library, and the count of section tokens."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripweave.llm import bpe, token_counts
from tripweave.llm.common import table
from tripweave.llm.queries import word_bpe

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_bpe())


@pytest.fixture(scope="module")
def coder():
    with open(word_bpe(), "rb") as file:
        return bpe.codec(file.read())


# Characters that pieces of the rules turn on: case, marks, numbers, white space, controls.
CHARACTERS = st.one_of(
    st.sampled_from(list("ab'sStTrRevEmMlLdD019 .,!#&<|>\\\n\t\r\x0b\x1c\x85\xa0　​")),
    st.sampled_from(list("éÉàßİıſΣσςẞ½²Ⅷ漢ひ한ǅͅ😀👍🏽")),
    st.characters(max_codepoint=0x24FF, exclude_categories=["Cs", "Cn"]),
)
TEXTS = st.lists(st.one_of(CHARACTERS, st.sampled_from(["<|startoftext|>", "<|endoftext|>", "don't"]))).map("".join)


@settings(max_examples=600, deadline=None)
@given(TEXTS)
def test_ids_and_round_trip_equal_the_library(library, coder, text):
    ids = np.frombuffer(coder.encode(text), "<u4")
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == expected
    assert coder.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_documents(spark, library):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text", F.lit("x").alias("ids"))
    extra = spark.createDataFrame(
        [(None, "Hello  WORLD"), (-1, None), (-2, ""), (-3, "long " * 60_000), (-3, "twice")],
        "doc_id long, text string",
    ).withColumn("ids", F.lit("y"))
    docs = docs.unionByName(extra)
    got = sorted(
        ((r.doc_id, list(r.ids), r.decoded) for r in bpe.decode(bpe.encode(docs, word_bpe()), word_bpe()).collect()),
        key=str,
    )
    expected = []
    for row in docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        expected.append((row.doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(expected, key=str)


def test_memory_of_words_starts_afresh(coder, monkeypatch):
    before = coder.encode("some words that come again")
    monkeypatch.setattr(bpe, "MEMO_WORDS", 2)
    coder.word_ids.clear()
    assert coder.encode("some words that come again") == before
    assert len(coder.word_ids) <= 2


@settings(max_examples=200, deadline=None)
@given(TEXTS.filter(lambda t: "﻿" not in t))
def test_token_spans_equal_the_library(library, coder, text):
    spans = token_counts.Spans(coder, text)
    expected = library.encode(text, add_special_tokens=False)
    assert spans.tokens == len(expected.ids)
    found = [span for word in range(len(spans.starts)) for span in spans.of_word(word)]
    assert len(found) == len(expected.ids)
    if "<|" not in text and all(ord(c) < 0x250 for c in text.lower()):
        assert found == expected.offsets


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_by_rule(spark, library, rule):
    texts = {1: "Unbelievable stories, retold\nand again", 2: "", 3: None, 4: "x" * 300, 5: "a b"}
    spans = [(0, 0, 5), (1, 5, 12), (2, 12, 300), (3, 3, 40), (4, 7, 7), (5, 9, 4)]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("section", F.lit(1))
    sections = F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(s, ("section", "start", "end")))) for s in spans))
    got = {
        (r.doc_id, r.section): (r.n_tokens, r.n_crossing, r.document_tokens)
        for r in token_counts.count_tokens(docs, word_bpe(), sections, rule).collect()
    }
    anchor = {"start": lambda a, b: a, "end": lambda a, b: b - 1, "largest": lambda a, b: (a + b - 1) // 2}[rule]
    for name, text in texts.items():
        offsets = library.encode(text or "", add_special_tokens=False).offsets
        for section, low, high in spans:
            own = [(a, b) for a, b in offsets if low <= anchor(a, b) < high]
            crossing = sum(a < low or b > high for a, b in own)
            assert got[name, section] == (len(own), crossing, len(offsets))


def test_documents_lead_and_lines_hold_every_token(spark, library):
    docs = table(spark, SF_DIR, "documents")
    rows = token_counts.count_tokens(docs, word_bpe(), token_counts.lead_and_lines(280))
    got = {
        r.doc_id: (r.n, r.total)
        for r in rows.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("document_tokens").alias("total")).collect()
    }
    for row in docs.collect():
        n = len(library.encode(row.text, add_special_tokens=False).ids)
        assert got[row.doc_id] == (n, n)


def test_lead_and_lines_cover_the_text():
    for text in ("", "a", "abc\n", "ab\ncd", "\n\n\n", "abcdef\ngh\n\ni", "x" * 50 + "\n" * 50_000):
        spans = token_counts.lead_and_lines(3)(text)
        assert spans[0] == (0, min(3, len(text)))
        assert "".join(text[a:b] for a, b in spans) == text
        assert all(a < b for a, b in spans[1:]) and all(text[b - 1] == "\n" for _, b in spans[1:-1])


def test_unknown_rule_and_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    sections = token_counts.lead_and_lines(10)
    with pytest.raises(ValueError):
        token_counts.count_tokens(empty, word_bpe(), sections, "half")
    assert token_counts.count_tokens(empty, word_bpe(), sections).collect() == []
    assert bpe.decode(bpe.encode(empty, word_bpe()), word_bpe()).collect() == []
