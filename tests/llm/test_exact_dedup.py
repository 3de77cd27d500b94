"""Exact dedup: small cases by hand, the given documents against SQL."""

from oracle_check import compare, duckdb_on

from tripweave.llm import exact_dedup, queries

SF_DIR = "/root/testdata/sf0.001"

ROWS = [
    (5, "a b"), (3, "a  b"), (4, "ab"), (9, "a  b"), (6, None), (7, ""), (8, " \n"), (None, "ab"),
    (10, "a b"), (11, "Ab"), (5, "a b"), (None, "alone"),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr(
        "*", "'x' as sha", "1 as content", "2 as group_size"
    )


def test_labels(spark):
    got = {
        (r.doc_id, r.keep_id, r.group_size, r.kept)
        for r in exact_dedup.label_duplicates(frame(spark)).collect()
    }
    assert got == {
        (5, 3, 6, False), (3, 3, 6, True), (4, 3, 6, False), (9, 3, 6, False), (None, 3, 6, False),
        (8, 8, 3, True), (6, 8, 3, False), (7, 8, 3, False), (10, 10, 1, True), (11, 11, 1, True),
        (None, None, 1, True),
    }


def test_one_row_of_each_group_stays_with_its_columns(spark):
    docs = frame(spark).unionByName(frame(spark))
    got = exact_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(3, "a  b"), (8, " \n"), (10, "a b"), (11, "Ab"), (None, "alone")], key=str
    )


def test_large_and_negative_ids_and_long_texts(spark):
    rows = [(2**63 - 1, "q " * 50_000), (-(2**63) + 1, "q" * 50_000), (0, "q " * 50_000)]
    got = exact_dedup.label_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.keep_id) for r in got.collect()} == {(name, 0) for name, _ in rows}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.label_duplicates(empty).collect() == []
    assert exact_dedup.drop_duplicates(empty).collect() == []


def test_given_documents(spark):
    name = "op10_exact_dedup"
    assert compare(spark, duckdb_on(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) == []


def test_plan_has_no_python(spark, plan_of):
    plan = plan_of(queries.op10_exact_dedup(spark, SF_DIR))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
