import math

import numpy as np
import pytest

from tessera.llm import exact_topk as X


def brute(rows, k, every):
    vecs = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in vecs:
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vecs if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,query_rows", [(8192, 1024), (60, 7)])
def test_against_brute_force(spark, monkeypatch, shard_rows, query_rows):
    monkeypatch.setattr(X, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(X, "QUERY_ROWS", query_rows)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 16).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(1000, None), (1020, [None, 1.0]), (1040, [float("nan")] * 16), (1060, [float("inf")] * 16), (None, [1.0] * 16), (1080, []), (1100, [0.5, -0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    ints = X.integer_vectors(df, "vec_id", "embedding")
    got = sorted(tuple(r) for r in X.top_k(ints, ints.where("id % 20 = 0"), 20).collect())
    assert got == brute(rows, 20, 20)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<float>")
    ints = X.integer_vectors(df, "vec_id", "embedding")
    assert sorted(tuple(r) for r in X.top_k(ints, ints.where("id = 0"), 20).collect()) == [(0, 1, 1, 8192), (0, 2, 2, -4096)]
    assert X.top_k(ints.limit(0), ints.limit(0), 20).count() == 0


@pytest.mark.parametrize("scale", [3, 1 << 12, 1 << 28])
def test_probing_is_exact(scale):
    rng = np.random.default_rng(9)
    base = rng.integers(-scale, scale, (4, 64))
    docs = np.concatenate([base.repeat(50, axis=0) + rng.integers(-1, 2, (200, 64)), rng.integers(-2, 3, (3000, 64))])
    ids = rng.permutation(len(docs)).astype(np.int64)
    who, found, scores = X.maxscore(docs[:200:10], ids[:200:10], docs, ids, 10)
    for i, q in enumerate(docs[:200:10]):
        all_ = sorted((-int(np.dot(q.astype(object), d.astype(object))), int(j)) for d, j in zip(docs, ids) if j != ids[10 * i])[:10]
        assert [(-int(s), int(f)) for s, f in zip(scores[who == i], found[who == i])] == all_
