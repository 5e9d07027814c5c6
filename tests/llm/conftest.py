import random

import pytest
from pyspark.sql import functions as F


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}x" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Small texts with copies, near copies, shared passages, blanks, nulls and repeated rows."""
    rng = random.Random(3)
    texts = [words(rng, rng.choice([3, 30, 120, 300]), 5000) for _ in range(60)]
    passage = words(rng, 40, 5000)
    rows = []
    for i, t in enumerate(texts):
        rows.append((10 * i, t))
        if i % 5 == 0:
            rows.append((10 * i + 1, t))  # an exact copy
        if i % 4 == 0:
            w = t.split()
            w[len(w) // 2] = "changed"
            rows.append((10 * i + 2, " ".join(w)))  # a near copy
        if i % 3 == 0:
            rows.append((10 * i + 3, t[: len(t) // 2] + " " + passage + " é " + t[len(t) // 2:]))
    rows += [(5000, None), (5001, ""), (5002, "  \n\t"), (5003, "one"), (5004, "one"), (5005, "ab " * 400), (5006, "ab " * 300)]
    rows += [(5007, "long " + words(rng, 6000, 50_000)), (10, texts[1]), (5008, "SAME words Here " * 3), (5009, "same WORDS here " * 3)]
    return rows


@pytest.fixture()
def docs(spark, corpus):
    """The corpus with columns whose names clash with those of the operators."""
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    names = ["score", "predicted", "node", "n", "position", "n_rows", "spans", "_k", "start", "length", "component_id", "lead"]
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])


@pytest.fixture()
def no_docs(docs):
    return docs.limit(0)
