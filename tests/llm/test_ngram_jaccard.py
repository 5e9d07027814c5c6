import itertools
import re

import numpy as np
import pytest

from tessera.llm import ngram_jaccard as N


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) or (frozenset([tuple(w)]) if w else frozenset()))
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            top[root(a)] = root(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (1, 50)])
def test_against_all_pairs(spark, docs, corpus, k, percent):
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.near_duplicates(docs, k, percent).collect())
    assert got == brute(corpus, k, percent)


def test_chain_of_links_is_one_component(spark):
    base = [f"t{i}" for i in range(200)]
    rows = [(9 - i, " ".join(base[3 * i: 3 * i + 150])) for i in range(10)]  # each similar to its neighbours only
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect())
    assert got == brute(rows, 4, 85)


def test_prefix_keeps_enough():
    rng = np.random.default_rng(1)
    sketch = rng.integers(1, 50, N.CELLS).astype(np.float32)
    for n in (1, 2, 5, 40, 300):
        found = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        part, l = N.prefix(found, sketch, 1.0, 85)
        assert 1 <= l <= N.least_shared(len(found), 85) and len(part) == len(found) - N.least_shared(len(found), 85) + l


def test_empty_table_and_null_ids(spark, no_docs):
    assert N.near_duplicates(no_docs).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in N.near_duplicates(rows).collect()}
    assert got == {(None, 2, 3), (3, 2, 3), (None, 0, None)}


def test_one_of_each_group_stays(spark, docs, corpus):
    """Row 10 of the corpus is there twice, with the same text: one of the two stays; rows without words have an id each."""
    got = sorted(r["doc_id"] for r in N.keep_first(docs).collect())
    assert got == sorted({d for d, _, c in brute(corpus, 5, 80) if d == c})
    assert N.keep_first(docs).columns == docs.columns


def test_rows_that_share_an_id_are_judged_each(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = a.replace("a39", "end")
    rows = [(1, a), (2, near), (2, b), (3, b + " more"), (4, c), (4, c + " more"), (None, c), (None, None), (None, None)]
    rows += [(None, "no id " + b[::-1])] * 3
    got = sorted(((r["doc_id"], r["text"]) for r in N.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert [r for r in got if r[0] != 4] == sorted([(1, a), (2, b), (None, None), (None, None), rows[-1]], key=str)
    assert sum(r[0] == 4 for r in got) == 1


def test_repeated_rows_and_odd_names(spark):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(1, text, 1, 2, 3)] * 4 + [(2, text, 1, 2, 3)] * 2 + [(3, "other words", 1, 2, 3)] * 3 + [(4, "", 1, 2, 3)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int, __hash int, mark_id int")
    out = N.keep_first(df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, text, 1, 2, 3), (3, "other words", 1, 2, 3), (4, "", 1, 2, 3), (4, "", 1, 2, 3)]


def test_bitmaps_rule_out_no_similar_pair():
    rng = np.random.default_rng(8)
    out = []
    for percent, share in itertools.product((80, 85), np.linspace(0, 1, 21)):
        for n in (1, 5, 60, 64, 65, 500, 513, 3000):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            b = np.unique(np.concatenate((a[:round(n * share)], rng.integers(0, 1 << 63, n - round(n * share) + n // 20, dtype=np.uint64))))
            both = len(np.intersect1d(a, b))
            may = N.may_be_similar(*(np.frombuffer(N.parity(x), dtype=np.uint8) for x in (a, b)), len(a) + len(b), percent)
            assert may or 100 * both < percent * (len(a) + len(b) - both)
            out.append((both / (len(a) + len(b) - both), len(a), may))
    assert not any(may for j, n, may in out if j < 0.6 and n >= 500)


def test_only_sets_that_may_be_similar_travel(spark, monkeypatch):
    """Texts that share a passage with each of two others meet in the postings; whole sets travel only for those that their bitmaps leave."""
    rng = np.random.default_rng(6)
    words = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    passages = [words(100) for _ in range(40)]
    rows = [(i, " ".join(passages[i] + passages[i - 1])) for i in range(40)]
    near = words(300)
    rows += [(500, " ".join(near)), (501, " ".join(near[:-4] + words(4)))]
    wanted, sets = [], N._sets
    monkeypatch.setattr(N, "_sets", lambda docs, ids, k: (wanted.extend(r[0] for r in ids.collect()), sets(docs, ids, k))[1])
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert got == {i: 500 if i == 501 else i for i, _ in rows}
    assert sorted(wanted) == [500, 501]
