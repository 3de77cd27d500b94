"""Fill-in-middle: against a plain Python version and SQL, on lines of every kind."""

import hashlib
import re

import pytest
from oracle_check import compare, duckdb_on

from tripweave.llm import fill_in_middle as fim
from tripweave.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def expected(doc_id, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", text, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm_rate:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


TEXTS = [
    "a\nb\nc\n", "a\nb\nc", "", None, "x", "\n", "\n\n\n", "a<P>b\n", "<S", "ends with <\n<S\n",
    "\r\n\r\n", "é𝒳\nü\n z\u0085\n", "$1 \\1 {3}+\n(?:\\Q\n", "l\n" * 30_000, "z" * 500_000,
]
ROWS = [(10 * i + k, text) for i, text in enumerate(TEXTS) for k in range(6)]
ROWS += [(None, "q\nr\ns\n"), (-5, "q\nr\ns\n"), (2**63 - 1, "q\nr\ns\n"), (3, "a\nb"), (3, "a\nb")]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr(
        "*", "1 as n", "'x' as form", "2 as a", "3 as content", "4 as id", "5 as h1", "6 as prefix"
    )


@pytest.mark.parametrize("plan", [fim.Plan(), fim.Plan(seed=3, rate=60, spm_rate=20)])
def test_as_plain_python(spark, plan):
    got = fim.restore(fim.transform(frame(spark), plan), plan).collect()
    want = sorted(
        ((i, t or "", *expected(i, t, plan.seed, plan.rate, plan.spm_rate)) for i, t in ROWS), key=repr
    )
    found = [
        (
            r.doc_id, r.restored, r.n, r.form, r.output,
            None if r.prefix is None else len(r.prefix), None if r.middle is None else len(r.middle),
        )
        for r in got
    ]
    assert sorted(found, key=repr) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_markers_that_could_overlap_are_refused():
    for names in (("<<", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("$1", "<S>", "<M>"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fim.Plan(prefix=names[0], suffix=names[1], middle=names[2])


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore(fim.transform(empty)).collect() == []


def test_given_documents(spark):
    name = "op13_fill_in_middle"
    assert compare(spark, duckdb_on(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) == []


def test_one_narrow_pass_without_python(spark, plan_of):
    plan = plan_of(queries.op13_fill_in_middle(spark, SF_DIR))
    assert not [x for x in ("Exchange", "Python", "Arrow") if x in plan]
    assert plan.count("regexp_replace(") == 1
