import numpy as np
import pytest
from pyspark.sql import functions as F

from sievekit.llm import topk


def brute(rows, k, is_query):
    found = {}
    for q, v in rows:
        if is_query(q):
            scored = sorted(((-int(np.dot(v, w)), c) for c, w in rows if c != q and len(w) == len(v)))
            found[q] = [(c, -s) for s, c in scored[:k]]
    return found


@pytest.mark.parametrize("scale,dim,n", [(1, 8, 300), (40, 3, 120), (10**7, 4, 60), (2**31, 2, 40)])
def test_matches_brute_force(spark, scale, dim, n, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = np.random.default_rng(scale)
    rows = [(i, [int(x) for x in rng.integers(-scale, scale + 1, dim)]) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = {}
    for r in topk.top_k(df.filter("vec_id % 5 = 0"), df, 6).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute(rows, 6, lambda q: q % 5 == 0)


def test_edges(spark):
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [0.1, 0.2, 0.3]), (None, [1.0, 1.0]), (6, []), (7, [-1.0, 2.0])]
    df = topk.whole(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert {r.vec_id for r in df.collect()} == {0, 1, 5, 6, 7}
    assert df.filter("vec_id = 7").first().v == [-64, 128]
    got = topk.top_k(df.filter("vec_id in (0, 5, 6)"), df, 20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(0, 1, 1, 64 * 64 + 32 * 32), (0, 2, 7, -64 * 64 + 32 * 128)]
    nothing = df.filter(F.lit(False))
    assert topk.top_k(nothing, df, 3).count() == 0
    assert topk.top_k(df, nothing, 3).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    values = rng.integers(-9, 9, (200, 6))
    queries = rng.integers(-9, 9, (11, 6))
    block = topk.Block(np.arange(200), values)
    plus, minus = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
    score = queries @ values.T
    for share in topk.DEPTHS:
        lower, upper, last = block.bounds(plus, minus, share, np.float64)
        assert (lower <= score).all() and (score <= upper).all()
    assert last and (lower == score).all()


def test_clustered_queries_stop_before_the_lists_end(monkeypatch):
    read, bounds = [], topk.Block.bounds
    monkeypatch.setattr(topk.Block, "bounds", lambda self, plus, minus, share, kind: read.append((share, len(plus))) or bounds(self, plus, minus, share, kind))
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(160, 64))
    v = np.repeat(centres / np.linalg.norm(centres, axis=1, keepdims=True), 50, 0) + 0.02 * rng.normal(size=(8000, 64))
    v = np.floor(64 * v).astype(np.int64)
    ids, asked = np.arange(len(v)), np.arange(0, len(v), 20)
    best = topk.Best(len(asked), 20)
    topk.search_block(asked, v[asked], topk.Block(ids, v), best)
    assert read[0] == (1 / 16, len(asked)) and max(share for share, _ in read) < 1
    for q, i in enumerate(asked):
        score = v @ v[i]
        score[i] = -(1 << 40)
        assert best.id[q].tolist() == np.lexsort((ids, -score))[:20].tolist()
