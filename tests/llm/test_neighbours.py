import math

import numpy as np
import pytest

from tallyfold.llm import neighbours as n
from tallyfold.llm import queries

DATA = "/root/testdata/sf0.01"


def brute(vectors, k):
    ids = sorted(vectors)
    matrix = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in ids:
        if q % 100 == 0:
            far = np.sqrt(((matrix - np.array(vectors[q], float)) ** 2).sum(1))
            out[q] = [(ids[j], far[j]) for j in np.lexsort((ids, far)) if ids[j] != q][:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    return out


def test_recall_and_scores(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}
    wanted, got = brute(vectors, 10), found(queries.op2(spark, DATA))
    assert set(got) == set(wanted)
    hits = sum(len({v for v, _ in wanted[q]} & {v for v, _, _ in got[q]}) for q in wanted)
    assert hits >= 0.9 * sum(map(len, wanted.values()))
    for q, rows in got.items():
        assert [r for _, _, r in rows] == list(range(1, 11))
        assert [(s, v) for v, s, _ in rows] == sorted((s, v) for v, s, _ in rows)
        for v, s, _ in rows:
            assert s == pytest.approx(math.dist(vectors[q], vectors[v]), rel=1e-14)


def test_recall_on_many_vectors_in_groups():
    rng = np.random.default_rng(3)
    rows = (rng.normal(size=(60, 24))[rng.integers(0, 60, 9000)] + 0.3 * rng.normal(size=(9000, 24)))
    router, probes = n.fitted(rows[:4000], rows[4000:4400], 10, target=0.95)
    part, ranked = router.ranked(rows)[:, 0], router.ranked(rows[4400:4800])[:, :probes]
    near = n.nearest_in(rows, rows[4400:4800], 10, np.arange(4400, 4800))
    hit = (part[near][:, :, None] == ranked[:, None, :]).any(2).mean()
    assert hit > 0.9 and probes <= n.PARTS // 3


def test_parts_are_balanced():
    rows = np.random.default_rng(4).normal(size=(3200, 8))
    graph = n.nearest_in(rows, rows, 10, np.arange(3200))
    part = n.balanced_parts(rows, graph, 16)
    assert np.bincount(part, minlength=16).min() >= 170 and np.bincount(part).max() <= 230
    assert (part[graph] == part[:, None]).mean() > 0.3


def test_a_third_of_equal_vectors(rows, monkeypatch):
    monkeypatch.setattr(n, "ROW_BLOCK", 64)
    monkeypatch.setattr(n, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(5)
    vectors = {i: [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist() for i in range(900)}
    index = n.build_index(rows("vec_id long, embedding array<float>", *vectors.items()), 10)
    exact = n.Index(index.rows, index.router, 10**6)
    got = found(n.search(exact, index.rows.filter("vec_id % 100 = 0"), 10))
    single = {i: np.array(v, np.float32) for i, v in vectors.items()}
    wanted = brute(single, 10)
    assert {q: [v for v, _, _ in r] for q, r in got.items()} == {q: [v for v, _ in r] for q, r in wanted.items()}
    assert [v for v, _, _ in got[300]] == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27]


def test_odd_rows(rows):
    nan, inf = float("nan"), float("inf")
    df = rows(
        "vec_id long, embedding array<float>, part int, rank string, score string",
        (0, [1.0, 0.0], 1, None, None), (1, [0.0, 1.0], None, None, None), (1, [0.0, 1.0], None, None, None),
        (2, None, None, None, None), (3, [0.0, 0.0], None, None, None), (4, [nan, 1.0], None, None, None),
        (5, [inf, 1.0], None, None, None), (6, [None, 1.0], None, None, None), (7, [1.0], None, None, None),
        (None, [1.0, 1.0], None, None, None), (100, [1.0, 0.0], None, None, None), (200, None, None, None, None))
    index = n.build_index(df, 10)
    got = found(n.search(index, index.rows.filter("vec_id % 100 = 0"), 10))
    assert [v for v, _, _ in got[0]] == [100, 1, 1] and [v for v, _, _ in got[100]] == [0, 1, 1] and set(got) == {0, 100}
    empty = n.build_index(df.limit(0), 10)
    assert n.search(empty, empty.rows, 10).count() == 0
