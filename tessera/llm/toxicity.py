"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its hashed subwords (the marked word and its character 3- to 5-grams), a
document the average of its distinct words, weighted by the logarithm of their counts and scaled to unit length (with
``SMOOTH``, so that few words give little evidence); a softmax over two classes scores it.  Embeddings and softmax learn
together, so an unseen misspelling shares most of the vectors of the word it comes from.  The fit reads a bounded
labelled sample, whose words Spark counts: the driver gets numbers and the words that teach, never texts.  Scoring reads
every whole text.  As averaging is linear, scoring needs one number a subword.

Defined cases: null and empty texts, and texts without a word character, score as the bias alone; a null id
scores like any other; repeated rows give repeated results; very long texts are scored whole (only the fit leaves out those over
``FIT_MAX_BYTES``); an empty table gives an empty result; other columns pass through, and one called
``score`` or ``predicted`` is replaced by ``score`` and kept by ``clean``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import every, free_name, held_out, labelled_sample, stored

FIT_ROWS = 8000
FIT_MAX_BYTES = 200_000
FIT_TOGETHER = 64
SCORE_TOGETHER = 64
BUCKETS = 1 << 17
DIM = 8
SCALE = 4.0
SMOOTH = 8.0
RARE_WEIGHT = 1.5  # of the rarer label: this times the root of the ratio of the labels
EPOCHS = 140
LEARNING_RATE = 0.2
MIN_DOCS = 10
CACHE_WORDS = 1_000_000
WORD = re.compile(r"\w+")


def subwords(word: str, buckets: int = BUCKETS) -> list[int]:
    """Bucket numbers of the marked word and its character 3- to 5-grams."""
    w = f"<{word}>"
    parts = [w] + [w[i:i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1) if n < len(w)]
    return [zlib.crc32(p.encode("utf-8", "replace")) % buckets for p in parts]


@dataclass
class Model:
    """``weights[b]``: what subword ``b`` adds to the class margin; ``bias``: the margin of no words."""

    weights: np.ndarray
    bias: float


def bag_of(text: str | None) -> tuple[list[str], np.ndarray]:
    """Distinct words of a whole text and the share of each: what the mean of the text multiplies its vector with."""
    counts = Counter(WORD.findall((text or "").lower()))
    logs = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
    return list(counts), SCALE * logs / math.sqrt(SMOOTH + float(logs @ logs))


def known_of(bag: tuple[list[str], np.ndarray], vocab: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Of a bag the words in ``vocab``: their places there, in order, and their shares."""
    known = sorted((vocab[w], s) for w, s in zip(*bag) if w in vocab)
    return np.array([i for i, _ in known], dtype=np.int32), np.array([s for _, s in known], dtype=np.float32)


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, min_docs: int = MIN_DOCS) -> Model:
    """Fit on a few texts in memory; :func:`fit_on` counts the words of a table with Spark and gets the same model."""
    bags = [bag_of(t) for t in texts]
    in_docs = Counter(w for words, _ in bags for w in words)
    vocab = {w: i for i, w in enumerate(sorted(w for w, c in in_docs.items() if c >= min_docs))}
    places, shares = zip(*(known_of(b, vocab) for b in bags)) if bags else ((), ())
    return fit_bags(list(vocab), list(places), list(shares), labels, epochs)


def fit_bags(vocab: list[str], places: list[np.ndarray], shares: list[np.ndarray], labels: list[int],
             epochs: int = EPOCHS, seed: int = 7, l2: float = 1e-6) -> Model:
    """Full-batch Adam on the mean log loss; deterministic.  With one class or no rows, the bias is the log odds.

    ``places`` and ``shares``: of each document its words in ``vocab``, in order, and the share of each.
    """
    y = np.asarray(labels, dtype=np.float64)
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    prior = float(np.log((n1 + 0.5) / (n0 + 0.5)))
    keep = [i for i, b in enumerate(places) if len(b)]
    if not keep or not n1 or not n0:
        return Model(np.zeros(BUCKETS, dtype=np.float32), prior)
    places, shares, y = [places[i] for i in keep], [shares[i] for i in keep], y[keep]
    n_docs = len(keep)
    subs = [subwords(w) for w in vocab]
    s_size = np.fromiter(map(len, subs), dtype=np.int64)
    s_flat = np.fromiter((s for x in subs for s in x), dtype=np.int64, count=int(s_size.sum()))
    used, s_flat = np.unique(s_flat, return_inverse=True)
    s_start = np.concatenate(([0], np.cumsum(s_size)[:-1]))
    w_size = np.fromiter(map(len, places), dtype=np.int64)
    w_flat, w_share = np.concatenate(places).astype(np.intp), np.concatenate(shares)
    w_start = np.concatenate(([0], np.cumsum(w_size)[:-1]))
    d_of = np.repeat(np.arange(n_docs), w_size)
    s_word = np.repeat(np.arange(len(subs)), s_size)
    s_inv = (1.0 / s_size).astype(np.float32)[s_word]

    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (len(used), DIM)).astype(np.float32)
    soft = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.array([0.0, prior], dtype=np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (emb, soft, bias)]
    target = np.stack([1 - y, y], axis=1).astype(np.float32)
    weight = np.where(y == 1, max(1.0, RARE_WEIGHT * math.sqrt(n0 / n1)), 1.0).astype(np.float32)
    weight /= weight.sum()
    for t in range(1, epochs + 1):
        words = np.empty((len(subs), DIM), dtype=np.float32)
        for k in range(DIM):  # a column at a time, to keep the gathered copies small
            words[:, k] = np.add.reduceat(emb[s_flat, k], s_start) / s_size
        docs = np.empty((n_docs, DIM), dtype=np.float32)
        for k in range(DIM):
            docs[:, k] = np.add.reduceat(words[w_flat, k] * w_share, w_start)
        z = docs @ soft + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - target) * weight[:, None]
        back = g @ soft.T
        g_emb = np.empty_like(emb)
        for k in range(DIM):
            g_word = np.bincount(w_flat, weights=back[d_of, k] * w_share, minlength=len(subs)).astype(np.float32)
            g_emb[:, k] = np.bincount(s_flat, weights=g_word[s_word] * s_inv, minlength=len(used))
        for param, grad, (m, v) in zip((emb, soft, bias), (g_emb + l2 * emb, docs.T @ g + l2 * soft, g.sum(axis=0)), state):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            param -= LEARNING_RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    weights = np.zeros(BUCKETS, dtype=np.float32)
    weights[used] = emb @ (soft[:, 1] - soft[:, 0])
    return Model(weights, float(bias[1] - bias[0]))


class Scorer:
    """Margins of whole texts; remembers the values of words it has met, at most ``CACHE_WORDS`` of them."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def margin(self, text: str | None) -> float:
        counts = Counter(WORD.findall((text or "").lower()))
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(counts).difference(known):
            known[w] = float(self.model.weights[subwords(w)].mean())
        share = np.log1p(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))
        value = np.fromiter(map(known.__getitem__, counts), dtype=np.float64, count=len(counts))
        return self.model.bias + SCALE * float(share @ value) / math.sqrt(SMOOTH + float(share @ share))

    def scores(self, texts) -> np.ndarray:
        z = np.fromiter((self.margin(t) for t in texts), dtype=np.float64, count=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, max_bytes: int = FIT_MAX_BYTES,
           min_docs: int = MIN_DOCS) -> Model:
    """Fit on at most ``rows`` labelled documents of at most ``max_bytes`` each, none of the held-out fold.

    Words of fewer than ``min_docs`` documents of the sample count in a mean but teach nothing.  Executors make the bags,
    once to count the words and once to place them, so no row a word is stored, joined or sorted; the driver gets the
    vocabulary and, of each document, places in it and shares.
    """
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _few(batches):
            in_docs = Counter(w for t in texts["text"].to_pylist() for w in set(WORD.findall((t or "").lower())))
            yield pa.RecordBatch.from_arrays([pa.array(in_docs.keys(), pa.string()), pa.array(in_docs.values(), pa.int64())], names=["word", "n"])

    sample = stored(labelled_sample(docs, labels, "toxic", rows, max_bytes), "toxicity_sample")
    id_type = sample.schema["doc_id"].dataType.simpleString()
    counts = sample.select("text").mapInArrow(words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    vocab = sorted(r["word"] for r in counts.where(F.col("n") >= min_docs).select("word").toLocalIterator())
    shared = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(vocab)})  # bounded by the sample's bytes

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _few(batches):
            made = [known_of(bag_of(t), shared.value) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["y"], pa.array([p for p, _ in made], pa.list_(pa.int32())),
                                              pa.array([s for _, s in made], pa.list_(pa.float32()))], names=["doc_id", "y", "places", "shares"])

    got = (sample.mapInArrow(known, f"doc_id {id_type}, y int, places array<int>, shares array<float>")
           .orderBy("doc_id").select("y", "places", "shares").toArrow())
    return fit_bags(vocab, [np.asarray(p.values, dtype=np.int32) for p in got["places"]],
                    [np.asarray(s.values, dtype=np.float32) for s in got["shares"]], got["y"].to_pylist())


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``FIT_TOGETHER`` at a time."""
    for batch in batches:
        yield from (batch.slice(at, FIT_TOGETHER) for at in range(0, batch.num_rows, FIT_TOGETHER))


def _scored(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with a score column; no shuffle, only the text goes to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers, whatever the corpus

    @F.arrow_udf("double")
    def toxic(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for s in texts:  # a batch stays as Arrow has it; few of its texts are strings at once
            few = [scorer.scores(s.slice(at, SCORE_TOGETHER).to_pylist()) for at in range(0, len(s), SCORE_TOGETHER)]
            yield pa.array(np.concatenate([np.empty(0), *few]))

    return docs.withColumn(name, toxic.asNondeterministic()("text"))


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``."""
    return _scored(docs, model, "score").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents that the model does not reject; all columns pass through, whatever their names."""
    name = free_name(docs, "score")
    return _scored(docs, model, name).where(F.col(name) < threshold).select(*every(docs))


def op3_subword_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
