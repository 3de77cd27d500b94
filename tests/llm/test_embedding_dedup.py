"""Near vectors against all pairs."""

import numpy as np
from oracle_check import compare, duckdb_on

from tripweave.llm import embedding_dedup, queries

SF_DIR = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 as node", "2 as weight", "3 as bucket"
    )


def test_given_vectors(spark):
    name = "op3_embedding_near_dedup"
    assert compare(spark, duckdb_on(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) == []


def test_recall_and_no_false_link_at_the_threshold(spark):
    random = np.random.default_rng(3)
    base = random.standard_normal((40, 24))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = np.repeat(base, 12, axis=0) + 0.055 * random.standard_normal((480, 24))
    rows = rows.astype(np.float32).astype(np.float64)
    units = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    true = (units @ units.T >= 0.95).sum(axis=1) - 1
    got = embedding_dedup.near_vectors(
        frame(spark, [(i, r.tolist()) for i, r in enumerate(rows)]), block=5
    )
    links = np.array([r.n_links for r in got.orderBy("vec_id").collect()])
    assert true.sum() > 500
    assert (links <= true).all()
    assert links.sum() >= 0.95 * true.sum()


def test_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [1.0, 2.0]), (3, [1.0, 2.0]), (4, [10.0, 20.0]), (6, [-1.0, -2.0]), (7, [0.0, 0.0]),
        (8, None), (9, []), (10, [1.0, None]), (11, [nan, 1.0]), (12, [inf, 1.0]), (13, [0.0, -0.0]),
        (14, [1.0, 2.0, 0.0]), (None, [1.0, 2.0]), (20, [1e-30, 2e-30]), (21, [1e30, 2e30]),
    ]
    got = {r.vec_id: tuple(r)[1:] for r in embedding_dedup.near_vectors(frame(spark, rows)).collect()}
    group = {name: (4, 3, name == 3) for name in (3, 4, 5, 20, 21)}
    alone = {name: (0, name, True) for name in (6, 7, 8, 9, 10, 11, 12, 13, 14)}
    assert got == group | alone | {None: (0, None, True)}


def test_no_rows(spark):
    assert embedding_dedup.near_vectors(frame(spark, [])).collect() == []


def test_tables_grow_with_points_and_keep_recall():
    for points in (10, 10**4, 10**9):
        tables, projections = embedding_dedup.shape(points, 0.95)
        near = embedding_dedup.collision(np.sqrt(0.1)) ** projections
        far = embedding_dedup.collision(np.sqrt(2)) ** projections
        assert 1 - (1 - near) ** tables >= embedding_dedup.RECALL
        assert points * far <= embedding_dedup.STRANGERS * 1.01
