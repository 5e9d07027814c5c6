import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import toxicity as T
from tessera.llm.common import held_out, labelled_sample, stored


def made(n, seed=1):
    rng = random.Random(seed)
    bad = ["idiot", "moron", "scumbag", "worthless"]
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 80))]
        y = int(i % 4 == 0)
        if y:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((" ".join(words), y))
    return rows


def test_held_out_accuracy_and_misspellings():
    rows = made(600)
    model = T.fit(*zip(*rows))
    test = made(300, seed=2)
    scores = T.Scorer(model).scores([t for t, _ in test])
    assert sum((s >= 0.5) == bool(y) for s, (_, y) in zip(scores, test)) >= 290
    unseen = " ".join(f"w{i}" for i in range(30)) + " idiott moronn wortthless"
    assert T.Scorer(model).margin(unseen) > T.Scorer(model).margin(" ".join(f"w{i}" for i in range(33)))


def test_scoring_is_the_average_of_subwords():
    model = T.fit(*zip(*made(100)), epochs=5)
    text = "Idiot w1 w2, w2\nW7"
    share = {"idiot": np.log(2), "w1": np.log(2), "w2": np.log(3), "w7": np.log(2)}
    total = sum(s * float(model.weights[T.subwords(w)].mean()) for w, s in share.items())
    length = np.sqrt(T.SMOOTH + sum(s * s for s in share.values()))
    assert abs(T.Scorer(model).margin(text) - (model.bias + T.SCALE * total / length)) < 1e-6


def test_defined_cases(spark, docs, no_docs, corpus):
    model = T.fit(*zip(*made(50)), epochs=3)
    out = T.score(docs, model)
    assert set(out.columns) == set(docs.columns) and out.count() == len(corpus)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out.collect())
    blank = {round(r["score"], 9) for r in out.where("doc_id in (5000, 5001, 5002)").collect()}
    assert len(blank) == 1
    assert T.score(no_docs, model).count() == 0
    assert T.fit([], []).weights.any() == False and T.fit(["a"], [1]).bias > 0  # noqa: E712


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)] + [(None, "x"), (3, None)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("toxic")).unionByName(spark.createDataFrame([(7, 0), (None, 1), (8, None)], "doc_id long, toxic int"))
    got = [r["doc_id"] for r in labelled_sample(docs, labels, "toxic", 50, 1000).collect()]
    assert len(got) == len(set(got)) == 50 and 7 not in got
    assert all(zlib.crc32(str(i).encode()) % 5 for i in got)
    folds = docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 5 == 0) for r in folds)


def test_words_counted_by_spark_give_the_model_of_the_texts(spark):
    rows = [(i, t, y) for i, (t, y) in enumerate(made(150))] + [(900, "", 1), (901, None, 0), (902, "rare", 1), (903, "Straße ÉTÉ w1 w1", 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    learnt = [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5]
    want, got = T.fit(*zip(*learnt)), T.fit_on(docs, labels)
    assert got.weights.any() and abs(got.bias - want.bias) < 1e-4 and np.abs(got.weights - want.weights).max() < 1e-3
    assert T.fit_on(docs, labels.limit(0)).weights.any() == False  # noqa: E712


def test_query(spark):
    got = T.op3_subword_toxicity(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(0 <= r["score"] <= 1 for r in got)


def test_the_fit_stores_no_more_than_its_sample(spark, monkeypatch):
    """No row a word is written or joined; the model is that of the sample in memory."""
    rows = made(120)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    kept = []
    monkeypatch.setattr(T, "stored", lambda df, name: kept.append(stored(df, name)) or kept[-1])
    model = T.fit_on(docs, labels)
    sample = labelled_sample(docs, labels, "toxic", T.FIT_ROWS, T.FIT_MAX_BYTES).collect()
    assert sum(df.count() for df in kept) <= len(sample) < 120
    want = T.fit([r["text"] for r in sample], [r["y"] for r in sample])
    assert want.bias == model.bias and np.array_equal(want.weights, model.weights) and want.weights.any()
