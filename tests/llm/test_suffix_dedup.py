import hashlib
import random

import numpy as np
import pytest

from tessera.llm import suffix_dedup as S


def brute(rows):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (t or "").encode()
        for j in range(len(b) - 49):
            first.setdefault(b[j:j + 50], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if i is not None and first.get(b[j:j + 50], i) < i:
                gone[j:j + 50] = b"\1" * 50
        runs = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


def test_against_brute_force(docs, corpus):
    assert found(S.report(docs)) == brute(corpus)


def test_null_ids_zero_bytes_and_edges(spark):
    same = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(49))
    rows = [(None, same + "XY"), (4, same + "X"), (2, same + "X" + same), (9, "q" + same), (7, "\0" * 60), (8, "\0" * 60 + "z"), (4, "\0" * 70),
            (11, "é" * 30 + same), (12, "é" * 30), (13, same)]
    assert found(S.report(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_many_small_batches(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 64)  # this process only: anchors of long texts by segments
    for _, t in corpus[:20]:
        raw = (t or "").encode()
        by_segment = S.anchors(raw)
        served = {}
        for p, lo, hi in zip(by_segment[0], by_segment[2], by_segment[3]):
            served.update({s: p for s in range(lo, hi + 1)})
        monkeypatch.setattr(S, "SEGMENT", 1 << 22)
        whole = {}
        for p, _, lo, hi in zip(*S.anchors(raw)):
            whole.update({s: p for s in range(lo, hi + 1)})
        monkeypatch.setattr(S, "SEGMENT", 64)
        assert served == whole and sorted(served) == list(range(max(0, len(raw) - 49)))


def test_multikey_order():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 3, (500, 4)).astype(">u8")
    order, starts = S.multikey_order(keys)
    rows = [tuple(keys[i]) for i in order]
    assert rows == sorted(map(tuple, keys))
    assert [bool(s) for s in starts] == [i == 0 or rows[i] != rows[i - 1] for i in range(len(rows))]


def test_empty_and_clean(spark, docs, no_docs, corpus):
    assert S.report(no_docs).count() == 0
    out = S.clean(docs)
    assert out.columns == docs.columns and out.count() == len(corpus)
    removed = {r[0] for r in brute(corpus) if r[2]}
    want = {i: t for i, t in corpus}
    assert all(r["text"] == want[r["doc_id"]] for r in out.collect() if r["doc_id"] not in removed)


def test_hot_tokens_and_single_range(docs, corpus, monkeypatch):
    monkeypatch.setattr(S, "HOT_BATCHES", 1)
    assert found(S.report(docs)) == brute(corpus)


def test_tasks_list_a_bounded_number_of_tokens(spark, monkeypatch):
    """A list is closed at TOKENS_HELD tokens, and its tokens fall evenly to the groups."""
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(str(rng.randrange(10**6)) for _ in range(200))) for i in range(40)], "doc_id long, text string").repartition(1)
    docs = docs.select("doc_id", S._half("text").alias("th"), "text")
    monkeypatch.setattr(S, "TOKENS_HELD", 300)
    lists = S._repeated_tokens(docs, np.zeros(1, dtype=np.int64), 3).collect()
    assert sum(r.bucket == -1 for r in lists) > 5 and {r.bucket for r in lists} == {-1, 0, 1, 2}
    assert max(len(r.tokens) // 6 for r in lists if r.bucket >= 0) < 300
    held = [sum(len(r.tokens) for r in lists if r.bucket == b) for b in range(3)]
    assert max(held) < 2 * min(held), held


def test_grams_serve_each_string_once(corpus):
    for _, t in corpus[:20]:
        raw = (t or "").encode()
        whole, served = {}, []
        for p, _, lo, hi in zip(*S.anchors(raw)):
            whole.update({s: p for s in range(lo, hi + 1)})
        for p, _, lo, hi in zip(*S.grams(raw)):
            assert all(whole[s] == p and (p - s <= S.SIDE) == (p - lo <= S.SIDE) for s in range(lo, hi + 1))
            served += range(lo, hi + 1)
        assert sorted(served) == sorted(whole)
    text = bytes(random.Random(3).randrange(97, 123) for _ in range(200))
    both = [{(p - shift, g) for p, g, lo, hi in zip(*S.grams(raw)) if lo >= shift and hi <= shift + 150} for raw, shift in ((text, 0), (b"another head " + text, 13))]
    assert both[0] & both[1] and len(both[0] ^ both[1]) <= 2


def test_short_phrases_that_repeat_do_not_travel(spark):
    """Phrases of 30 bytes hold whole tokens, but no 50-byte string; only longer grams that repeat are marked."""
    rng = random.Random(7)
    phrases = ["".join(rng.choice("abcdefghij ") for _ in range(30)) for _ in range(40)]
    docs = spark.createDataFrame([(i, " ".join(f"{rng.random()}{p}" for p in phrases)) for i in range(6)], "doc_id long, text string")
    assert all(S.anchors(t.encode())[1].tolist() for _, t in docs.collect())
    rows = S._merged_tokens(S._repeated_tokens(docs.select("doc_id", S._half("text").alias("th"), "text"), np.zeros(1, dtype=np.int64), 3))
    assert sum(len(r.bits) for r in rows.where("kind = 0").collect()) == 0
