import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import periodic_runs as P


def brute(words, least=24, periods=3):
    """All runs by trying every period."""
    number = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], dtype=np.int64)
    found = {}
    for q in range(1, len(w) // periods + 1):
        same = np.diff(np.concatenate([[0], (w[:-q] == w[q:]).astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(same == 1).tolist(), np.flatnonzero(same == -1).tolist()):
            if b - a + q >= max(least, periods * q):
                found.setdefault((a, b - a + q), q)  # the same words have no smaller period
    return sorted((a, n, q) for (a, n), q in found.items())


def noisy(rng, n, letters, copies):
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(copies):
        if n > 20:
            a, p = rng.randrange(n - 10), rng.randrange(1, 14)
            for i in range(a + p, rng.randrange(a, n)):
                w[i] = w[i - p]
    return [b"w%d" % x for x in w]


def test_runs_equal_a_search_over_all_periods():
    rng = random.Random(5)
    for _ in range(700):
        words = noisy(rng, rng.randrange(130), rng.choice([1, 2, 3, 9, 50]), rng.randrange(4))
        assert [tuple(r) for r in P.word_runs(words).tolist()] == brute(words)
        ids = [int(x[1:]) + 1 for x in words]
        assert [tuple(r) for r in P.runs_of(ids, max(ids, default=1), 2, 2).tolist()] == brute(words, 2, 2)


def test_extensions_and_lyndon_words():
    rng = random.Random(9)
    for _ in range(60):
        n = rng.randrange(2, 60)
        s = [rng.randrange(1, rng.choice([2, 3, 5]) + 1) for _ in range(n)]
        tree = P.SuffixTree(s, 5)
        order, common = tree.tour()
        assert order.tolist() == sorted(range(n + 1), key=lambda i: s[i:])
        ext = P.Extensions(order, common)
        i, j = (x.ravel() for x in np.meshgrid(range(n + 1), range(n + 1)))
        i, j = i[i != j], j[i != j]

        def lce(a, b):
            k = 0
            while max(a, b) + k < n and s[a + k] == s[b + k]:
                k += 1
            return k
        assert ext(i, j).tolist() == [lce(a, b) for a, b in zip(i.tolist(), j.tolist())]

        def lyndon(a, text):
            return max(k for k in range(1, n - a + 1) if all(text[a:a + k] < text[a + m:a + k] for m in range(1, k)))
        assert P.lyndon_lengths(ext.rank).tolist() == [lyndon(a, s) for a in range(n)]
        opposite, rank = [-x for x in s], np.empty(n + 1, dtype=np.int64)
        rank[tree.tour(opposite=True)[0]] = np.arange(n + 1)
        assert P.lyndon_lengths(rank).tolist() == [lyndon(a, opposite) for a in range(n)]


def test_long_text_of_one_word_and_of_long_periods():
    rng = random.Random(2)
    block = [b"b%d" % rng.randrange(900) for _ in range(1200)]
    assert P.word_runs([b"x"] * 9000).tolist() == [[0, 9000, 1]]
    assert P.word_runs(block * 5 + block[:7]).tolist() == [[0, 6007, 1200]]
    assert P.word_runs(block * 2 + block[:1199]).tolist() == []


def planted(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def check(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = P.op12_suffix_tree_runs(spark, str(tmp_path))
    assert got.columns == COLUMNS
    want = [expected(*r) for r in rows]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    return want


def test_query_on_defined_cases(spark, tmp_path, corpus):
    rng = random.Random(8)
    rows = list(corpus) + [(None, None), (None, "a b c " * 30), (9001, "a  b\tc\x0bd e " * 40)] + [corpus[3]]
    rows += [(7000 + i, b" ".join(noisy(rng, 200, 6, 3)).decode()) for i in range(60)]
    want = check(spark, tmp_path, rows)
    assert sum(r[1] > 1 for r in want) > 10 and sum(r[1] == 0 for r in want) > 10


def test_query_on_the_smallest_tables(spark):
    got = {r[0]: tuple(r) for r in P.op12_suffix_tree_runs(spark, "/root/testdata/sf0.001").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows) and all(got[r.doc_id] == expected(r.doc_id, r.text) for r in rows)


def test_empty_table_and_clashing_names(spark, tmp_path, docs, no_docs):
    assert P.periodic_runs(no_docs).count() == 0
    odd = docs.withColumn("f", F.lit(1)).withColumn("a.b", F.lit(2)).withColumn("runs", F.lit(3)).limit(5)
    got = P.periodic_runs(odd)
    assert set(got.columns) == set(odd.columns) | {"collapsed"} and all(r["a.b"] == 2 and r.f == 1 for r in got.collect())
