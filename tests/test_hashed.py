"""Hash-bucketed neighbours against brute force: recall, share of compared pairs, hot vectors, never fewer than k."""

import numpy as np
import pytest

from casewright.operators import hashed, vectors

PLAN = hashed.HashPlan(tables=24, probes=3, block_rows=60, chunk_rows=50)


def frame(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    return spark.createDataFrame([(int(i), None if v is None else [float(c) for c in v]) for i, v in zip(ids, matrix)],
                                 "row_index long, embedding array<double>")


def asked(index):
    return index.withColumnRenamed("row_index", "query_id")


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["neighbor_id"], round(r["distance"], 9)))
    return out


def test_recall_and_share(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 48))
    index = frame(spark, centres[rng.integers(0, 40, 900)] + 0.6 * rng.normal(size=(900, 48))).repartition(5)
    report = {}
    plan = hashed.HashPlan(tables=14, probes=2, block_rows=60, chunk_rows=50)
    got = lists(hashed.knn_hashed(asked(index), index, 5, plan=plan, report=report))
    exact = lists(vectors.knn_cosine(asked(index), index, 5))
    hits = sum(len({n for _, n, _ in got[q]} & {n for _, n, _ in exact[q]}) for q in exact)
    assert hits / (5 * len(exact)) >= 0.9 and all(len(got[q]) == 5 for q in exact)
    assert report["visited"] < 0.5 * report["pairs"]
    for q in exact:  # exact distances, in order
        assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
        assert all(a[2] >= b[2] - 1e-9 for a, b in zip(got[q], exact[q]))


def test_two_codes_share_fewer_pairs(spark):
    rng = np.random.default_rng(2)
    near = rng.normal(size=(150, 24))
    index = frame(spark, np.vstack([near, near + 0.05 * rng.normal(size=near.shape)]))
    report = {}
    got = lists(hashed.knn_hashed(asked(index), index, 1, plan=hashed.HashPlan(tables=12, probes=6, codes=2), report=report))
    assert sum(got[q][0][1] == (q + 150) % 300 for q in got) / 300 >= 0.95
    assert report["visited"] < 0.2 * report["pairs"]


def test_copies_and_odd_vectors(spark):
    """A third of all rows is one vector; equal rows come in id order, a query never finds itself, null vectors take no part."""
    rng = np.random.default_rng(3)
    matrix = [list(v) for v in rng.normal(size=(200, 16))] + [[1.0] + [0.0] * 15] * 120 + [[0.0] * 16] * 3 + [None, None]
    index = frame(spark, matrix).repartition(7)
    got = lists(hashed.knn_hashed(asked(index), index, 4, plan=PLAN))
    exact = lists(vectors.knn_cosine(asked(index), index, 4))
    assert set(got) == set(exact) == set(range(323))
    for q in range(200, 320):
        assert got[q] == exact[q] and [n for _, n, _ in got[q]] == [n for n in range(200, 206) if n != q][:4]
    assert all(len(got[q]) == 4 and q not in [n for _, n, _ in got[q]] for q in got)


@pytest.mark.parametrize("rows", [0, 1, 2, 3])
def test_few_rows(spark, rows):
    index = frame(spark, np.eye(4)[:rows])
    extra = frame(spark, [[0.5, 0.5, 0.0, 0.0]], [99])
    got = lists(hashed.knn_hashed(asked(index.unionByName(extra)), index, 5, plan=hashed.HashPlan(tables=1, probes=1)))
    exact = lists(vectors.knn_cosine(asked(index.unionByName(extra)), index, 5))
    assert got == exact


def test_short_answers_are_searched_exactly(spark):
    """One table, one probe: most buckets hold fewer than k rows."""
    rng = np.random.default_rng(4)
    index = frame(spark, rng.normal(size=(60, 32)))
    report = {}
    got = lists(hashed.knn_hashed(asked(index), index, 5, plan=hashed.HashPlan(tables=1, probes=1), report=report))
    assert report["searched_exactly"] > 30 and all(len(v) == 5 for v in got.values()) and len(got) == 60


def test_all_rows_without_self_exclusion(spark):
    rng = np.random.default_rng(5)
    index = frame(spark, rng.normal(size=(80, 8)))
    got = lists(hashed.knn_hashed(asked(index), index, 3, exclude_self=False, plan=PLAN))
    assert all(got[q][0][1] == q and len(got[q]) == 3 for q in range(80))
