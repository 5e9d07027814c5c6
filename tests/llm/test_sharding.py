import zlib
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import sharding as S


def test_permutation_of_every_small_size(spark):
    for n in (1, 2, 3, 5, 8, 17, 26, 99, 1000):
        rows = spark.range(n).select(F.col("id").alias("x"), F.lit(n).cast("long").alias("n"))
        got = [r[0] for r in rows.select(F.expr(S.permuted_sql("x", "n", 42))).collect()]
        assert sorted(got) == list(range(n))
    assert got != sorted(got)


def _plain(x, n, seed):
    """The same permutation in plain Python."""
    import math

    a = math.ceil(math.sqrt(n))
    b = (n + a - 1) // a

    def f(v, m, c):
        t = (v * m + c) % S.PRIME
        return ((t ^ (t >> 13)) * 1103515245 + m) % S.PRIME

    def step(y):
        l, r, p, q = y // b, y % b, a, b
        for m, c in S.round_keys(seed):
            l, r, p, q = r, (l + f(r, m, c)) % p, q, p
        return l * q + r

    y = step(x)
    while y >= n:
        y = step(y)
    return y


def test_place_is_computable(spark):
    for n in (7, 90, 5000):
        rows = spark.range(n).select(F.col("id").alias("x"), F.lit(n).cast("long").alias("n"))
        got = {r[0]: r[1] for r in rows.select("x", F.expr(S.permuted_sql("x", "n", 5))).collect()}
        assert got == {x: _plain(x, n, 5) for x in range(n)}


def test_law_and_reproducibility(spark, docs, corpus):
    key = ["doc_id", "text"]
    a = S.shard(docs, 8, key)
    rows = a.collect()
    assert len(rows) == len(corpus)
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    again = S.shard(docs.repartition(7), 8, key).collect()
    place = lambda rs: sorted((r["doc_id"], r["text"] or "", r["shard"], r["slot"]) for r in rs)
    assert place(rows) == place(again)
    assert place(S.shard(docs, 8, key, seed=1).collect()) != place(rows)


def test_empty_and_null_keys(spark, no_docs):
    assert S.shard(no_docs, 8, ["doc_id"]).count() == 0
    rows = S.shard(spark.createDataFrame([(None,), (None,), (1,)], "doc_id long"), 2, ["doc_id"]).collect()
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(0, 0), (0, 1), (1, 0)]


def test_query(spark, tmp_path, docs, corpus):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = S.op1_feistel_sharding(spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in corpus)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_plan_is_native(spark, docs):
    plan = S.shard(docs, 8, ["doc_id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
