"""The pipeline: each stage against what its input says should stay."""

import gc
import json
import weakref
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pytest

import corpus_pipeline
from tripweave.llm import bpe, language_id, queries
from tripweave.llm.common import table, written

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage, as the pipeline hands them on."""
    docs, seen = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF_DIR), "stage")
        seen.append((name, docs, result))
        docs = result
    return seen


def test_order_and_columns(stages):
    assert [name for name, *_ in stages] == [
        "quality classifier", "language ID", "exact dedup", "n-gram Jaccard join", "best-fit packing",
    ]
    for _, before, after in stages[:-1]:
        assert before.columns == after.columns
        assert after.exceptAll(before).count() == 0


def test_quality_stage_drops_bad_and_keeps_good(spark, stages):
    _, before, after = stages[0]
    labels = table(spark, SF_DIR, "labels").where("quality is not null")
    good = before.join(labels.where("quality = 1"), "doc_id", "left_semi")
    bad = before.join(labels.where("quality = 0"), "doc_id", "left_semi")
    assert good.join(after, "doc_id", "left_anti").count() <= 0.01 * good.count()
    assert bad.join(after, "doc_id", "left_semi").count() <= 0.05 * bad.count()


def test_language_stage_keeps_the_languages_that_it_knows(stages):
    """All texts are in the four languages; single words may be too short to tell."""
    _, before, after = stages[1]
    dropped = before.join(after, "doc_id", "left_anti").collect()
    assert all(sum(map(str.isalpha, r.text or "")) < 6 for r in dropped)
    assert before.where("text rlike '\\\\p{L}{6}'").join(after, "doc_id", "left_anti").count() == 0


# The same sentence in languages of none of the given documents.
STRANGE = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
    "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
    "Все люди рождаются свободными и равными в своём достоинстве и правах.",
]


def test_language_stage_drops_other_languages(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(10**9 + i, text, None, "x", 0) for i, text in enumerate([*STRANGE, "", None, "1 ."])]
    some = docs.where("doc_id < 50")
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = corpus_pipeline.language_stage(spark, more, SF_DIR)
    assert kept.where("doc_id >= 1000000000").count() == 0
    assert kept.join(some, "doc_id", "left_semi").count() == some.where("text rlike '\\\\p{L}{6}'").count()


def test_exact_stage_keeps_one_of_each(stages):
    _, before, after = stages[2]
    first: dict[str, tuple] = {}
    for r in before.collect():
        key = "".join((r.text or "").split(" ")).translate({c: None for c in range(9, 14)})
        first[key] = max(first.get(key, (-1, 0)), (len(r.text or ""), -r.doc_id))
    assert {r.doc_id for r in after.collect()} == {-minus for _, minus in first.values()}


def test_near_stage_keeps_one_of_each_class(stages):
    from test_ngram_join import brute

    _, before, after = stages[3]
    texts = {r.doc_id: r.text for r in before.collect()}
    classes = {component for _, component in brute(texts, 5, 80).values()}
    assert {r.doc_id for r in after.collect()} == classes
    assert len(classes) < len(texts)


def test_packing_stage_holds_every_document(stages):
    _, before, after = stages[4]
    assert after.select("doc_id").distinct().count() == before.count()


def test_run_is_registered(spark):
    import __spark_entry__ as contract

    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert set(queries.QUERIES) <= set(contract.queries())
    assert set(queries.ORACLES) <= set(contract.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("tripweave/**/*.py"), root / "bench.py"]:
        if path.parent.name != "llm":
            assert "llm" not in path.read_text()


def test_a_worker_keeps_the_model_of_its_stage_only(monkeypatch):
    made = []

    class Watched(language_id.Languages):
        def __init__(self, samples):
            super().__init__(samples)
            made.append(weakref.ref(self))

    monkeypatch.setattr(language_id, "Languages", Watched)
    samples = SimpleNamespace(value=json.dumps({"xx": "a sample of its own"}).encode())
    for _ in range(2):
        batch = pa.RecordBatch.from_pydict({"text": ["a sample"]})
        list(language_id._predict_batches(iter([batch]), samples, 0, ["text", "a", "b", "c"]))
        assert len(made) == 1 and made[0]() is not None
    with open(queries.word_bpe(), "rb") as file:
        bpe.codec(file.read())
    gc.collect()
    assert made[0]() is None
