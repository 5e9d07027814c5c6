import math
import random
from collections import Counter

import numpy as np

from tessera.llm import decontaminate as D


def items(n=40, seed=3):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(600)] + ["the", "of", "and"] * 60
    return [" ".join(rng.choice(vocab) for _ in range(rng.randrange(12, 40))) + "? " + " ".join(rng.choice(vocab) for _ in range(8)) + "." for _ in range(n)]


def bm25(texts):
    """Plain normalised impacts: item -> word -> share."""
    words = [D.words_of(t) for t in texts]
    filled = [len(w) for w in words if w]
    mean, df = sum(filled) / len(filled), Counter(t for w in words for t in set(w))
    out = []
    for w in words:
        x = {t: math.log(1 + (len(filled) - df[t] + .5) / (df[t] + .5)) * c * (D.K1 + 1) / (c + D.K1 * (1 - D.B + D.B * len(w) / mean)) for t, c in Counter(w).items()}
        total = sum(x.values())
        out.append({t: v / total for t, v in x.items()})
    return out


def test_retrieval_is_complete():
    texts = items() + ["", None]
    index, plain = D.Index(texts, 0.3), bm25(texts)
    rng = random.Random(8)
    for _ in range(200):
        src = D.words_of(rng.choice(texts[:40]))
        passage = set(rng.sample(src, rng.randrange(1, len(src)))) | {f"v{rng.randrange(600)}" for _ in range(30)} | {"the", "of"}
        terms = sorted(index.term[w] for w in passage if w in index.term)
        ceiling = index.ceilings(np.zeros(len(terms), dtype=np.int64), np.array(terms), 1)[0]
        got = {i: round(s, 9) for i, s in index.above(terms, np.flatnonzero(ceiling >= 0.3 - 1e-9).tolist())}
        want = {i: round(s, 9) for i, x in enumerate(plain) if (s := sum(x.get(w, 0) for w in passage)) >= 0.3}
        assert got == want


def test_leaks_against_brute_force(spark, docs, corpus):
    texts = items()
    rng = random.Random(1)
    rows = [(1000 + i, t) for i, t in enumerate(texts)]
    leaked = [(i, f"{' '.join(f'n{rng.randrange(9999)}' for _ in range(rng.randrange(0, 300)))} {texts[i % 40].upper()} {' '.join(f'n{rng.randrange(9999)}' for _ in range(rng.randrange(0, 300)))}") for i in range(60)]
    half = [(70, texts[0][: len(texts[0]) // 3]), (71, None), (72, "")]
    df = docs.select("doc_id", "text").where("doc_id >= 100").unionByName(spark.createDataFrame(leaked + half, "doc_id long, text string"))
    bench = spark.createDataFrame(rows + [(2000, None), (None, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(df, bench).collect()}
    assert got == {(i, 1000 + i % 40) for i in range(60)}
    small = {(r["doc_id"], r["item_id"]) for r in D.leaks(df, bench, group_bytes=2000).collect()}
    assert small == got
    left = D.clean(df, bench)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} & set(range(60)) == set()
    assert left.count() == df.count() - 60


def test_groups_do_not_change_scores(spark):
    """Partial copies on both sides of the threshold, repeated items, any split of the benchmark."""
    texts = items(30, 5)
    rng = random.Random(4)
    partial = [(i, " ".join(w for w in texts[i % 30].split() if rng.random() < 0.75)) for i in range(120)]
    df = spark.createDataFrame(partial, "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])] * 3 + [(99, texts[1])], "item_id long, text string")
    found = []
    for group_bytes in (10 ** 9, 1500, 200):
        rows = D.leaks(df, bench, 0.5, 0.1, 0.1, group_bytes).collect()
        found.append(sorted((r["doc_id"], r["item_id"], round(r["score"], 9), r["question_overlap"], r["answer_overlap"], r["passages"]) for r in rows))
    assert found[0] == found[1] == found[2] and any(r[1] == 99 for r in found[0])
    assert {r[0] for r in found[0]} != set(range(120)) and sum(r[1] == 0 for r in found[0]) % 4 == 0
    assert D.clean(df, bench, 0.5, 0.1, 0.1, 200).count() == 120 - len({r[0] for r in found[0]})


def test_other_columns_pass_through(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 7, 8, 9)], ["doc_id", "text", "leaks", "a.b", "__leaks"])
    got = D.clean(df, spark.createDataFrame([(1, "x y z. u v w.")], "item_id long, text string"))
    assert got.columns == df.columns and got.collect() == df.collect()


def test_empty_tables(spark, docs, no_docs, corpus):
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert D.leaks(no_docs, bench).count() == 0
    assert D.leaks(docs, bench.limit(0)).count() == 0
    assert D.clean(docs, bench.limit(0)).count() == len(corpus)


def test_query_finds_every_verbatim_item(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]) for r in D.op10_blockmax_wand_decontamination(spark, sf).collect()}
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    flat = [(r["item_id"], " ".join(D.words_of(r["text"]))) for r in bench]
    want = {(d["doc_id"], i) for d in docs for i, t in flat if t in " ".join(D.words_of(d["text"]))}
    assert got == want and want
