import numpy as np

from tessera.llm import quality as Q


def walk(forest, row):
    total = forest.base
    for at in forest.roots:
        while forest.left[at] != at:
            at = forest.left[at] if row[forest.feature[at]] <= forest.limit[at] else forest.right[at]
        total += forest.value[at]
    return total


def test_flat_trees_equal_a_plain_walk_and_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, len(Q.STATISTICS)))
    y = ((x[:, 2] > 0.3) & (x[:, 5] < 0.5)).astype(int)
    forest = Q.fit(x[:600], y[:600], trees=20)
    assert np.allclose(forest.margins(x[:50]), [walk(forest, r) for r in x[:50]])
    assert ((forest.scores(x[600:]) >= 0.5) == y[600:]).mean() > 0.95


def test_fit_without_two_classes():
    none = np.zeros((0, len(Q.STATISTICS)))
    assert Q.fit(none, np.array([])).scores(np.zeros((2, len(Q.STATISTICS)))).tolist() == [0.5, 0.5]
    one = Q.fit(np.ones((5, len(Q.STATISTICS))), np.ones(5))
    assert one.scores(np.ones((1, len(Q.STATISTICS))))[0] > 0.9


def test_statistics_are_finite():
    for t in (None, "", " \n", "a", "A B\nA B", "é!|" * 1000, "\ud800"):
        got = Q.statistics(t)
        assert len(got) == len(Q.STATISTICS) and np.isfinite(got).all()
    s = dict(zip(Q.STATISTICS, Q.statistics("Aa Aa Aa 12!\n")))
    assert s["repeated_next"] == 0.5 and s["top_word"] == 0.75 and abs(s["digits"] - 2 / 13) < 1e-12


def test_defined_cases(spark, docs, no_docs, corpus):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(100, len(Q.STATISTICS)))
    forest = Q.fit(x, (x[:, 0] > 0).astype(int), trees=5)
    out = Q.score(docs, forest)
    assert set(out.columns) == set(docs.columns) and out.count() == len(corpus)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.collect())
    assert Q.score(no_docs, forest).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.op9_boosted_quality(spark, sf)
    both = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in both) / len(both) > 0.95
