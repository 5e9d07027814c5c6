"""Benchmark decontamination: every training passage queries a BM25 index of test items by block-max WAND.

Test items are indexed by word with BM25 impacts, scaled so that an item scores 1 against itself.  A document is
read whole, in overlapping windows of words (passages); a window at least twice as long as any item, moved by half
its length, holds every copy of an item whole.  Each passage retrieves every item above a threshold: sums of block
maxima, for all passages of a text at once, leave the blocks of items that can reach it, and WAND pivots on term
bounds score items inside those blocks only.  A retrieved item is confirmed when enough of its question's and of its answer's word trigrams stand in the
passage (the last sentence is the answer; an item of one sentence is both).

Distinct item texts are split into groups of about ``GROUP_BYTES`` of text (a longer text alone is a group of its own
size); each group's index is broadcast and queried in a pass of its own, so what is broadcast never grows with the
benchmark.  The number of items, their mean length, the document frequency of words and the window are counted over the
whole benchmark, so scores and results are the same whatever the groups.

Defined cases: null or empty texts leak nothing; items without a word match nothing; repeated items are each
reported; a null ``doc_id`` or ``item_id`` is kept as null; very long texts are read window by window, in blocks of
``PASSAGES``; empty tables leak nothing; other columns of the documents are ignored by ``leaks`` and pass through
``clean``, whatever their names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import every, free_name, stored

THRESHOLD = 0.5
QUESTION_OVERLAP = 0.6
ANSWER_OVERLAP = 0.6
WINDOW = 64
BLOCK = 4
PASSAGES = 1024
K1, B = 1.2, 0.75
GROUP_BYTES = 2_000_000
WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
LEAK = "array<struct<item:int,score:double,question_overlap:double,answer_overlap:double,passages:int>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def trigrams(words: list[str]) -> set[tuple[str, ...]]:
    """Distinct word trigrams; fewer words count as one gram."""
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)} or ({tuple(words)} if words else set())


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's words before its last sentence, and of it; parts under three words take the whole item."""
    parts = [p for p in SENTENCE.split(text.strip()) if words_of(p)]
    whole = words_of(text)
    question, answer = words_of(" ".join(parts[:-1])), words_of(parts[-1]) if parts else []
    return (question if len(question) >= 3 else whole), (answer if len(answer) >= 3 else whole)


class Statistics(NamedTuple):
    """Of items with a word: how many, their mean and greatest number of words, and in how many of them a word stands."""

    n_items: int
    mean: float
    longest: int
    df: dict[str, int]


def statistics_of(words: list[list[str]]) -> Statistics:
    filled = [len(w) for w in words if w]
    return Statistics(len(filled), sum(filled) / max(len(filled), 1) or 1.0, max(filled, default=0), Counter(t for w in words for t in set(w)))


class Index:
    """BM25 impacts of one group of items: postings by term, and the largest impact of a term in each block of items.

    ``statistics`` are those of the whole benchmark; without them the texts are the whole benchmark.
    """

    def __init__(self, texts: list[str | None], least: float = THRESHOLD, statistics: Statistics | None = None):
        words = [words_of(t) for t in texts]
        self.size, self.least, self.n_blocks = len(texts), least, -(-len(texts) // BLOCK)
        n_items, mean, longest, df = statistics or statistics_of(words)
        self.term = {t: i for i, t in enumerate(dict.fromkeys(t for w in words for t in w))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.term]
        for i, w in enumerate(words):
            if not w:
                continue
            norm = K1 * (1 - B + B * len(w) / mean)
            impact = {t: math.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + norm)
                      for t, c in Counter(w).items()}
            full = sum(impact.values())
            for t, x in impact.items():
                postings[self.term[t]].append((i, x / full))
        self.items = [[i for i, _ in p] for p in postings]
        self.impacts = [[x for _, x in p] for p in postings]
        self.bound = [max(x) for x in self.impacts]
        tops = []
        for p in postings:
            top: dict[int, float] = {}
            for i, x in p:
                top[i // BLOCK] = max(top.get(i // BLOCK, 0.0), x)
            tops.append(top)
        self.first = np.concatenate(([0], np.cumsum([len(t) for t in tops]))).astype(np.int64)
        self.block = np.array([b for t in tops for b in t], dtype=np.int64)
        self.block_max = np.array([x for t in tops for x in t.values()], dtype=np.float64)
        self.window = max(WINDOW, 2 * longest)
        self.parts = []
        for t in texts:
            q, a = question_answer(t or "")
            self.parts.append((trigrams(q), trigrams(a)))

    def ceilings(self, passage: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """The most any item of each block can score in each of ``n`` passages, from distinct (passage, term) pairs."""
        count = self.first[term + 1] - self.first[term]
        ends = np.cumsum(count)
        at = np.repeat(self.first[term] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        cell = np.repeat(passage, count) * self.n_blocks + self.block[at]
        return np.bincount(cell, weights=self.block_max[at], minlength=n * self.n_blocks).reshape(n, self.n_blocks)

    def above(self, terms: list[int], blocks: list[int]) -> list[tuple[int, float]]:
        """Items of ``blocks`` (rising) whose impacts over ``terms`` (distinct) sum to the threshold: WAND.

        Postings between competitive blocks are skipped unread.
        """
        least, items, impacts, bound = self.least - 1e-9, self.items, self.impacts, self.bound
        found = []
        for block in blocks:
            lo, hi = block * BLOCK, (block + 1) * BLOCK
            cursors = [[items[t][p], t, p] for t in terms
                       if (p := bisect_left(items[t], lo)) < len(items[t]) and items[t][p] < hi]
            while cursors:
                cursors.sort()
                total, pivot = 0.0, -1
                for k, c in enumerate(cursors):
                    total += bound[c[1]]
                    if total >= least:
                        pivot = k
                        break
                if pivot < 0:
                    break
                item = cursors[pivot][0]
                score = 0.0
                for c in cursors:
                    if c[0] < item:
                        c[2] = bisect_left(items[c[1]], item, c[2])
                    elif c[0] > item:
                        break
                    if c[2] < len(items[c[1]]) and items[c[1]][c[2]] == item:
                        score += impacts[c[1]][c[2]]
                        c[2] += 1
                if score >= least:
                    found.append((item, score))
                cursors = [[items[t][p], t, p] for _, t, p in cursors if p < len(items[t]) and items[t][p] < hi]
        return found


class Matcher:
    """Finds the leaks of whole texts."""

    def __init__(self, index: Index, question: float, answer: float):
        self.index, self.question, self.answer = index, question, answer

    def leaks(self, text: str | None) -> list[dict]:
        index, least = self.index, self.index.least - 1e-9
        words = words_of(text)
        ids = np.fromiter(map(index.term.get, words, repeat(-1)), dtype=np.int64, count=len(words))  # -1: in no item
        step, n_terms = index.window // 2, len(index.items)
        place = np.flatnonzero(ids >= 0)
        if not len(place):
            return []
        # passage k holds the half windows k and k + 1; the last half window begins no further one
        half, n = place // step, max(-(-len(ids) // step) - 1, 1)
        key = np.concatenate((half * n_terms + ids[place], (half - 1) * n_terms + ids[place]))
        key = np.unique(key[(key >= 0) & (key < n * n_terms)])
        passage, term = key // n_terms, key % n_terms
        best: dict[int, tuple[float, float, float, int]] = {}
        for lo in range(0, n, PASSAGES):
            a, b = np.searchsorted(passage, (lo, lo + PASSAGES))
            ceiling = index.ceilings(passage[a:b] - lo, term[a:b], min(PASSAGES, n - lo))
            for k in np.flatnonzero((ceiling >= least).any(axis=1)).tolist():
                mine = slice(*np.searchsorted(passage, (lo + k, lo + k + 1)))
                grams = None
                for item, score in index.above(term[mine].tolist(), np.flatnonzero(ceiling[k] >= least).tolist()):
                    if grams is None:
                        grams = trigrams(words[(lo + k) * step:(lo + k + 2) * step])
                    q, a_ = (len(p & grams) / len(p) for p in index.parts[item])
                    if q >= self.question and a_ >= self.answer:
                        was = best.get(item, (0.0, 0.0, 0.0, 0))
                        best[item] = (max(was[0], score), max(was[1], q), max(was[2], a_), was[3] + 1)
        return [dict(item=i, score=float(v[0]), question_overlap=float(v[1]), answer_overlap=float(v[2]), passages=v[3])
                for i, v in sorted(best.items())]


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, text, words, key`` of the items with a word, stored; ``key`` is the digest of the text."""
    @F.pandas_udf("array<string>")
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(words_of)

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", words.asNondeterministic()("text").alias("words"))
    return stored(items.where(F.size("words") > 0).withColumn("key", F.sha2("text", 256)), "items")


def _groups(items: DataFrame, least: float, group_bytes: int) -> Iterator[tuple[list[str], Index]]:
    """The keys and the index of each group of distinct texts, one group at a time on the driver."""
    n_items, mean, longest = items.agg(F.count(F.lit(1)), F.avg(F.size("words")), F.max(F.size("words"))).first()
    if not n_items:
        return
    counts = stored(items.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "item_words")
    texts = stored(items.groupBy("key").agg(F.first("text").alias("text"), F.first("words").alias("words")), "item_texts")
    n = int(texts.agg(F.sum(F.octet_length("text"))).first()[0] // group_bytes) + 1
    for k in range(n):
        part = texts if n == 1 else texts.where(F.pmod(F.xxhash64("key"), F.lit(n)) == k)
        group = part.select("key", "text").orderBy("key").collect()
        if group:
            mine = part.select(F.explode("words").alias("word")).distinct()  # bounded like the group
            df = {r["word"]: r["n"] for r in mine.join(counts, "word").collect()}
            yield [r["key"] for r in group], Index([r["text"] for r in group], least, Statistics(n_items, mean, longest, df))


def _matched(docs: DataFrame, index: Index, question: float, answer: float, name: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf(LEAK)
    def leaks_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, question, answer)
        for s in texts:
            yield pd.Series([matcher.leaks(t) for t in s])

    return docs.withColumn(name, leaks_of.asNondeterministic()("text"))  # so that Spark runs it once


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = THRESHOLD, question: float = QUESTION_OVERLAP,
          answer: float = ANSWER_OVERLAP, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per document and item that leaks into it, with the best passage's score and overlaps."""
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, passages int")
    items = _items(benchmark)
    for keys, index in _groups(items, least, group_bytes):
        found = _matched(docs.select("doc_id", "text"), index, question, answer, "leaks").select("doc_id", F.explode("leaks").alias("x"))
        named = docs.sparkSession.createDataFrame(list(enumerate(keys)), "item int, key string")  # bounded like the group
        rows = found.join(F.broadcast(named), F.col("x.item") == F.col("item")).join(items.select("key", "item_id"), "key")
        out = out.unionByName(rows.select("doc_id", "item_id", "x.score", "x.question_overlap", "x.answer_overlap", "x.passages"))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, least: float = THRESHOLD, question: float = QUESTION_OVERLAP,
          answer: float = ANSWER_OVERLAP, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The documents that hold no item; no shuffle: each document's own text decides."""
    columns, name = every(docs), free_name(docs, "leaks")
    for _, index in _groups(_items(benchmark), least, group_bytes):
        docs = _matched(docs, index, question, answer, name).where(F.size(name) == 0).select(*columns)
    return docs


def op10_blockmax_wand_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
