import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import packing as P


@pytest.fixture(scope="module")
def encoder():
    return P.Encoder(P.default_tokenizer())


def test_ids_equal_the_tokenizer(encoder, corpus):
    odd = ["a|b |", "|", "<|endoftext|> x<|startoftext|>y", "don't I'M we'll", "é́ é ́x", "Ünï code　x y", "a\x0bb\x0cc\x1cd", "日本語 12345 🙂🙂", "x" * 3000,
           "ﬁ ẞ Σς İ", "a  b\n\n\tc "]
    for t in [t for _, t in corpus if t] + odd:
        want = encoder.tokenizer.encode(t, add_special_tokens=False).ids + [P.END_ID]
        assert np.frombuffer(encoder.encode(t), dtype="<u4").tolist() == want, t[:40]
    assert encoder.encode(None) == encoder.encode("") == b"\0\0\0\0"


def test_long_texts_by_segments(encoder, monkeypatch, corpus):
    whole = [encoder.encode(t) for _, t in corpus]
    monkeypatch.setattr(P, "SEGMENT", 50)
    assert [encoder.encode(t) for _, t in corpus] == whole


def test_cut():
    ids = np.arange(5000, dtype="<u4").tobytes()
    got = P.cut(ids)
    assert [(p["piece"], p["start"], p["length"]) for p in got] == [(0, 0, 2048), (1, 2048, 2048), (2, 4096, 904)]
    assert got[1]["ids_crc32"] == zlib.crc32(ids[2048 * 4:4096 * 4])
    assert len(P.cut(np.zeros(2048, dtype="<u4").tobytes())) == 1


def valid(packing, lengths, capacity):
    fill = defaultdict(int)
    for i, b in enumerate(packing):
        fill[b] += lengths[i]
    return len(packing) == len(lengths) and max(fill.values()) <= capacity


def test_evolution_never_gets_worse():
    rng = random.Random(2)
    for seed in range(8):
        lengths = [rng.randrange(200, 1200) for _ in range(150)]
        first = P.evolve(lengths, [], 2048, seed, generations=0)
        last = P.evolve(lengths, first, 2048, seed, generations=15)
        assert all(valid(p, lengths, 2048) for p in first + last)
        assert P.cost(P.bins_of(last[0], lengths)) <= P.cost(P.bins_of(first[0], lengths))


def hard_lengths(kind, n, seed=3):
    """Pieces round a third of a sequence, or threes that fill one exactly: best fit leaves much room on both."""
    rng = random.Random(seed)
    if kind == "thirds":
        return [rng.randrange(620, 760) for _ in range(n)]
    out = []
    for _ in range(n // 3):
        a = rng.randrange(500, 900)
        b = rng.randrange(500, 2048 - a - 300)
        out += [a, b, 2048 - a - b]
    return out


@pytest.mark.parametrize("kind,share", [("thirds", 0.95), ("threes", 0.99)])
def test_evolution_beats_best_fit_on_hard_lengths(kind, share):
    lengths = hard_lengths(kind, 1998)
    plain = P.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, [], 2048)
    best = P.evolve(lengths, [], 2048, 7)[0]
    assert valid(best, lengths, 2048) and max(best) + 1 <= share * len(plain)


def test_trade_keeps_pieces_and_fills_bins():
    rng = random.Random(9)
    lengths = [rng.randrange(1, 1500) for _ in range(200)]
    bins = P.best_fit(list(range(150)), lengths, [], 2048)
    before = [b[0] for b in bins]
    left = P.trade(bins, list(range(150, 200)), lengths, 2048)
    assert sorted(left + [i for b in bins for i in b[1]]) == list(range(200))
    assert all(b[0] == sum(lengths[i] for i in b[1]) <= 2048 and b[0] >= w for b, w in zip(bins, before))


@pytest.mark.parametrize("kind", ["thirds", "threes"])
def test_blocks_beat_best_fit_of_everything(spark, kind):
    lengths = hard_lengths(kind, 2400)
    plain = P.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, [], 2048)
    got = P.pack(spark.createDataFrame(list(enumerate(lengths)), "uid long, length long"), block_items=600)
    fill = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.countDistinct("offset").alias("k"), F.count("*").alias("m")).collect()
    assert sum(r["m"] for r in fill) == len(lengths) and all(r["n"] <= 2048 and r["k"] == r["m"] for r in fill)
    assert len(fill) < len(plain)


def test_crossover_keeps_every_piece():
    rng = random.Random(5)
    lengths = [rng.randrange(1, 2047) for _ in range(300)]
    a = P.best_fit(sorted(range(300), key=lambda i: -lengths[i]), lengths, [], 2048)
    b = P.best_fit(list(range(300)), lengths, [], 2048)
    for _ in range(20):
        child = P.crossover(a, b, lengths, 2048, rng)
        assert sorted(i for x in child for i in x[1]) == list(range(300))
        assert all(x[0] == sum(lengths[i] for i in x[1]) <= 2048 for x in child)


@pytest.mark.parametrize("block_items", [2000, 40])
def test_pack_over_blocks_and_levels(spark, block_items):
    rng = random.Random(1)
    rows = [(i, rng.choice([2048, rng.randrange(1, 2048), rng.randrange(1, 300)])) for i in range(400)]
    pieces = spark.createDataFrame(rows, "uid long, length long")
    got = P.pack(pieces, block_items=block_items).collect()
    assert sorted((r["uid"], r["length"]) for r in got) == sorted(rows)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(n for _, n in rows) // 2048)
    assert len(by) <= least * 1.03 + 1


def test_documents(spark, docs, no_docs, corpus, encoder):
    got = P.pack_documents(docs, P.default_tokenizer()).collect()
    want = sorted((i if i is not None else -1, p["piece"], p["length"], p["ids_crc32"]) for i, t in corpus for p in P.cut(encoder.encode(t)))
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in got) == want
    assert P.pack_documents(no_docs, P.default_tokenizer()).count() == 0
