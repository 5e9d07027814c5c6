"""Each stage of the corpus pipeline against what its operator says of the stage's own input."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tessera.llm import decontaminate, packing, toxicity
from tessera.llm.common import stored

from test_ngram_jaccard import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in C.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), f"test_{name}"))
    return docs


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(steps):
    assert all(d.columns == steps[0].columns for d in steps[:5]) and len(C.STAGES) == 5


def test_stages(spark, steps):
    docs, clean, single, safe, masked, packed = steps
    model = toxicity.fit_on(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(clean) == ids(toxicity.score(docs, model).where("score < 0.5"))
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert ids(single) == sorted(d for d, _, c in brute(rows, 5, 80) if d == c)
    leaked = {r["doc_id"] for r in decontaminate.leaks(single, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids(safe) == [i for i in ids(single) if i not in leaked]
    was, now = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (safe, masked))
    key = re.compile(r"(?<=token = \")[0-9a-f]{40}|AKIA[0-9A-Z]{16}")
    assert now == {i: key.sub("[SECRET]", t) for i, t in was.items()}
    tokens = packing.Encoder(packing.default_tokenizer())
    want = sorted((i, p["piece"], p["ids_crc32"]) for i, t in now.items() for p in packing.cut(tokens.encode(t)))
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed.collect()) == want


def test_run_equals_the_stages(spark, steps):
    assert C.run(spark, SF).count() == steps[-1].count()


def test_odd_rows_and_names(spark, steps):
    """Nulls, blanks, repeated rows, clashing and dotted names, and an empty table through all stages."""
    base = steps[0].select("*", F.lit(1).alias("score"), F.lit(2).alias("__k"), F.lit(3).alias("a.b"))
    odd = [(900001, None), (900002, ""), (None, None), (900003, "x " * 50_000), (900004, "fine words of a text"), (900004, "fine words of a text")]
    frame = spark.createDataFrame([(i, t, None, None, None, 1, 2, 3) for i, t in odd], base.schema)
    docs = base.unionByName(frame)
    for name, stage in C.STAGES:
        columns = docs.columns
        docs = stored(stage(spark, docs, SF), f"odd_{name}")
        if name != "packing":
            assert docs.columns == columns
            assert {tuple(r)[-3:] for r in docs.select("score", "__k", "`a.b`").collect()} == {(1, 2, 3)}
    got = {}
    for r in docs.where("doc_id is null or doc_id > 900000").collect():
        got.setdefault(r["doc_id"], []).append(r["length"])
    assert got[900001] == got[900002] == got[None] == [1] and len(got[900003]) > 1 and len(got[900004]) == 1
    for name, stage in C.STAGES:
        assert stage(spark, base.limit(0), SF).count() == 0
