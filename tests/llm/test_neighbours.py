import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import neighbours

SF = "/root/testdata/sf0.01"


def exact(vectors, query, k=10):
    """All candidates in order of distance, then id."""
    own = vectors[query]
    away = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(own, v))), i) for i, v in vectors.items() if i != query)
    return away[:k]


def test_recall_and_scores_on_the_whole_table(spark):
    vectors = {r.vec_id: [float(x) for x in r.embedding] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    got = {}
    for r in neighbours.op2_neighbours(spark, SF).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert sorted(got) == sorted(i for i in vectors if i % 100 == 0)
    hits = total = 0
    for q, rows in got.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 11))
        assert [(s, i) for _, s, i in rows] == sorted((s, i) for _, s, i in rows)
        for _, s, i in rows:
            assert s == pytest.approx(math.dist(vectors[q], vectors[i]), rel=1e-12)
        hits += len({i for _, _, i in rows} & {i for _, i in exact(vectors, q)})
        total += 10
    assert hits / total >= 0.9


def test_large_random_table_reaches_the_recall(spark):
    x = np.random.default_rng(9).normal(size=(3000, 24))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in neighbours.search(table, F.col("vec_id") % 100 == 0, sample=1000).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, found in got.items():
        away = np.linalg.norm(x - x[q], axis=1)
        away[q] = np.inf
        hits += len(found & set(np.argsort(away)[:10].tolist()))
    assert len(got) == 30 and hits / 300 >= 0.9


def test_odd_vectors(spark, made):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (100, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [2.0, 0.0]), (9, [2.0, 0.0]), (10, []), (11, [0.0, -1.0]), (12, [-0.0, 1.0])]
    at = made("embeddings", [(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, node int")
    out = {}
    for r in neighbours.op2_neighbours(spark, at).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    root = math.sqrt(2)
    rest = [(1.0, 9), (root, 2), (root, 11), (root, 12)]
    for q, twins in ((0, [1, 100]), (100, [0, 1])):
        want = [(0.0, t) for t in twins] + rest
        assert [(r, v) for r, v, _ in sorted(out[q])] == [(k, v) for k, (_, v) in enumerate(want, 1)]
        assert [s for _, _, s in sorted(out[q])] == pytest.approx([s for s, _ in want])
    assert set(out) == {0, 100}


def test_a_vector_that_most_rows_share(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(i, [1.0, 2.0, 3.0 + i / 1000]) for i in range(500, 600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = neighbours.search(table, F.col("vec_id") % 100 == 0).collect()
    by = {}
    for r in out:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert [v for _, v in sorted(by[0])] == list(range(1, 11)) and [v for _, v in sorted(by[400])] == list(range(10))
    assert [v for _, v in sorted(by[500])] == [501, 502, 503, 504, 505, 506, 507, 508, 509, 510]


def test_empty_tables(spark, made):
    for rows in ([], [(0, None)], [(0, [1.0])]):
        at = made("embeddings", rows, "vec_id long, embedding array<float>")
        assert neighbours.op2_neighbours(spark, at).collect() == []
