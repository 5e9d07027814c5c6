import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import token_counts as T

ALPHABET = [*"abst'rvelmd  \n\t!?.19é日’ÀﬁⅣ²", " ", "　", "\x85", "\U0001F642", "́", "'re", "'ll", "'ve", "<|endoftext|>", "<|endoftext|",
            "  ", "\r\n", "the ", " hello", "ing", "tion", "Ġ"]


@pytest.fixture(scope="module")
def counter():
    return T.Counter(T.default_tokenizer())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(T.default_tokenizer())
    return lambda texts: [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(1)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(3000)]
    made += [bytes(rng.randrange(256) for _ in range(40)).decode("utf-8", "ignore") for _ in range(300)]
    return made + ["", None, "a" * 5000, " " * 700, "'" * 99, "ab" * 3000, "<|endoftext|>" * 3, "'s 't'LL", "x \n y \n\n", "ha" * 40 + "\n" * 9]


def test_counts_equal_the_library(counter, library, odd):
    assert counter.counts(odd).tolist() == library(odd)


def test_any_chunk_and_group_length(counter, library, odd, monkeypatch):
    want = library(odd)
    splitter = counter.splitter.starts
    monkeypatch.setattr(T, "GROUP", 100)
    monkeypatch.setattr(T, "SLAB", 7)
    for chunk in (1, 3, 64):
        monkeypatch.setattr(counter.splitter, "starts", lambda codes, first, c=chunk: splitter(codes, first, c))
        assert counter.counts(odd).tolist() == want


def test_scan_is_the_sequential_composition():
    rng = np.random.default_rng(4)
    maps = rng.integers(0, 9, (77, 9)).astype(np.uint8)
    got, state = T.compose_scan(maps), np.arange(9)
    for row, m in zip(got, maps):
        state = m[state]
        assert row.tolist() == state.tolist()


def test_pairs_survive_as_in_merging(counter):
    m, rng = counter.merger, random.Random(3)
    ids = [i for i in m.spelt if m._fits(-1, i)]
    for _ in range(5000):
        a, b = rng.choice(ids), rng.choice(ids)
        assert m._apart(a, b) == (m.merged(m.spelt[a] + m.spelt[b]) == [a, b])


def test_tables_start_anew_without_changing_counts(counter, library, odd, monkeypatch):
    for name, limit in (("MAX_STATES", 50), ("MAX_WORDS", 20), ("REMEMBERED", 3)):
        monkeypatch.setattr(T, name, limit)
    assert counter.counts(odd[:800]).tolist() == library(odd[:800])


def test_query(spark, docs, no_docs, library):
    got = T.token_counts(docs.union(docs.limit(3)), T.default_tokenizer(), limit=50).collect()
    assert [r.n_tokens for r in got] == library([r.text for r in got])
    assert all(r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 50) for r in got)
    assert len(got) == docs.count() + 3 and got[0].score == 0
    nulls = spark.createDataFrame([(None, None), (None, "a b")], "doc_id long, text string")
    assert [(r.n_bytes, r.n_tokens) for r in T.token_counts(nulls, T.default_tokenizer()).collect()] == [(0, 0), (3, 2)]
    assert T.token_counts(no_docs, T.default_tokenizer()).count() == 0
    clash = docs.withColumn("n_tokens", F.lit("x")).withColumn("a.b", F.lit(1))
    assert dict(T.token_counts(clash, T.default_tokenizer()).dtypes)["n_tokens"] == "bigint"


def test_registered_query(spark, library):
    df = T.op11_transducer_token_counts(spark, "/root/testdata/sf0.001")
    assert df.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = df.collect()
    assert len(rows) == 200 and [r.n_tokens for r in rows] == library([text[r.doc_id] for r in rows])
    assert all(r.over_limit == (r.n_tokens > 1024) for r in rows)


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        T.Counter(public_tokenizers.path("word_bpe_49k.json"))
