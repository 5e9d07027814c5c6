"""Maximal periodic runs of words, found by Lyndon roots and longest common extensions from suffix trees.

The words of a text become integers.  Of a stretch of words, Ukkonen's algorithm builds the suffix trees of it and of its reversal.
An Euler tour of each tree lists the leaves and, between neighbours, the string depth of their lowest common ancestor,
so that a range minimum in a sparse table answers a common extension of two places in constant time, forwards by one tree
and backwards by the other.  Ranks of the suffixes under an order of the words and under its opposite give every
place its longest Lyndon word; each is a candidate root that is extended in both directions.  Every run has such a
root under one of the two orders, and no root has a shorter period, so the runs found are all and no other.

Before any tree is built, a text is reduced to stretches that can hold runs.  A run of ``MIN_LENGTH`` words or
more with three periods or more repeats each of its 16-word sequences at the distance of its period; so all its words lie in
sequences whose next or last equal lies in the same stretch, not farther than a third of it.  Sequences are
compared by hash (equal ones never differ), stretches without such sequences are given up, and most texts hold none.  Results do not change:
the test compares them with a search over all periods.

Nothing is shuffled; a task's memory is bounded by its Arrow batch and about 600 bytes for each word of the longest
stretch.  Defined cases: a null or empty text, or one without words, has no runs and collapses to the empty text;
repeated rows are each answered; a null ``doc_id`` is as good as any; an empty table gives an empty result; very long texts are read
whole; other columns pass through, but columns named ``runs`` and ``collapsed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 24
MIN_PERIODS = 3
RUN = "struct<start:long,length:long,period:long>"
GRAM = 16  # a power of two, at most two thirds of MIN_LENGTH
_BASE = 0x9E3779B97F4A7C15


class SuffixTree:
    """Ukkonen's suffix tree of ``symbols`` (integers from 1 to ``largest``) and an end mark below all symbols."""

    def __init__(self, symbols: list[int], largest: int):
        text = [*symbols, 0]
        n, width = len(text), largest + 1
        child: dict[int, int] = {}
        start, end, link, depth, leaf = [0], [0], [0], [0], [-1]
        node = at = length = pending = made = 0
        for i, symbol in enumerate(text):
            pending += 1
            split = 0
            while pending:
                if not length:
                    at = i
                key = node * width + text[at]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(i), end.append(n), link.append(0), depth.append(0), leaf.append(made)
                    made += 1
                    if split:
                        link[split] = node
                        split = 0
                else:
                    begin = start[below]
                    size = (end[below] if end[below] <= i else i + 1) - begin
                    if length >= size:
                        node = below
                        at += size
                        length -= size
                        continue
                    if text[begin + length] == symbol:
                        length += 1
                        if split:
                            link[split] = node
                        break
                    middle = len(start)
                    child[key] = middle
                    start.append(begin), end.append(begin + length), link.append(0), depth.append(depth[node] + length), leaf.append(-1)
                    start[below] = begin + length
                    child[middle * width + text[begin + length]] = below
                    child[middle * width + symbol] = middle + 1
                    start.append(i), end.append(n), link.append(0), depth.append(0), leaf.append(made)
                    made += 1
                    if split:
                        link[split] = middle
                    split = middle
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - pending + 1
        self.n, self.width, self.depth, self.leaf = n, width, np.array(depth), leaf
        self.keys = np.fromiter(child.keys(), np.int64, len(child))
        self.kids = np.fromiter(child.values(), np.int64, len(child))

    def tour(self, opposite: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order (of the words, or of their opposite order; the end mark first in both), and of each and the one before it
        the string depth of the lowest common ancestor."""
        parent, symbol = np.divmod(self.keys, self.width)
        if opposite:
            symbol = np.where(symbol > 0, self.width - symbol, 0)
        by = np.lexsort((symbol, parent))
        parent, kids = parent[by], self.kids[by]
        nodes = np.arange(len(self.leaf))
        first = np.searchsorted(parent, nodes).tolist()
        last = np.searchsorted(parent, nodes, side="right").tolist()
        above = np.full(len(nodes), -1, dtype=np.int64)  # depth of the parent of a later child
        later = np.append(False, parent[1:] == parent[:-1])
        above[kids[later]] = self.depth[parent[later]]
        above, down, leaf = above.tolist(), kids.tolist(), self.leaf
        order, common, branch, stack = [], [], 0, [0]
        while stack:
            v = stack.pop()
            if above[v] >= 0:
                branch = above[v]
            if leaf[v] >= 0:
                order.append(leaf[v])
                common.append(branch)
            else:
                stack.extend(down[first[v]:last[v]][::-1])
        return np.array(order), np.array(common)


class Extensions:
    """Longest common extensions of two places in constant time: a range minimum over the leaves of the Euler tour."""

    def __init__(self, order: np.ndarray, common: np.ndarray):
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        self.table = [common.astype(np.int32)]
        step = 1
        while 2 * step <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2
        self.flat = np.concatenate(self.table)
        self.offset = np.cumsum([0] + [len(t) for t in self.table[:-1]])

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For ``i`` and ``j`` different in every place."""
        a, b = self.rank[i], self.rank[j]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        base = self.offset[level]
        return np.minimum(self.flat[base + lo], self.flat[base + hi - (1 << level)]).astype(np.int64)


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place: up to the next suffix of smaller rank."""
    ranks = rank.tolist()
    out = [0] * (len(ranks) - 1)
    stack = [len(out)]  # the end mark is below all
    for i in range(len(out) - 1, -1, -1):
        r = ranks[i]
        while ranks[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1] - i
        stack.append(i)
    return np.array(out, dtype=np.int64)


def runs_of(symbols: list[int], largest: int, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows ``start, length, period`` of all maximal runs of integers from 1 to ``largest``, by start, then period."""
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), dtype=np.int64)
    tree = SuffixTree(symbols, largest)
    order, common = tree.tour()
    ahead = Extensions(order, common)
    opposite = np.empty(n + 1, dtype=np.int64)
    opposite[tree.tour(opposite=True)[0]] = np.arange(n + 1)
    back = Extensions(*SuffixTree(symbols[::-1], largest).tour())
    place = np.tile(np.arange(n), 2)
    period = np.concatenate([lyndon_lengths(ahead.rank), lyndon_lengths(opposite)])
    kept = period <= n // min_periods
    place, period = place[kept], period[kept]
    after, before = ahead(place, place + period), back(n - place, n - place - period)
    length = before + period + after
    long = (length >= min_length) & (length >= min_periods * period)
    return np.unique(np.stack([place - before, length, period], axis=1)[long], axis=0)


def stretches(words: list[bytes]) -> list[tuple[int, int]]:
    """Spans of words outside which no run of ``MIN_LENGTH`` words and ``MIN_PERIODS`` periods has a word."""
    n = len(words)
    if n < MIN_LENGTH:
        return []
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    size, base = 1, _BASE
    while size < GRAM:
        h = h[:-size] * np.uint64(base) + h[size:]
        size, base = 2 * size, base * base % (1 << 64)
    by = np.argsort(h, kind="stable")
    same = h[by[1:]] == h[by[:-1]]
    if not same.any():
        return []
    i, j = by[:-1][same], by[1:][same]
    while len(i):
        edge = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edge, i, 1)
        np.add.at(edge, j, 1)
        np.add.at(edge, i + GRAM, -1)
        np.add.at(edge, j + GRAM, -1)
        inside = np.diff(np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
        mine = np.searchsorted(starts, i, side="right") - 1
        good = (j < ends[mine]) & (MIN_PERIODS * (j - i) <= (ends - starts)[mine])
        if good.all():
            return [(a, b) for a, b in zip(starts.tolist(), ends.tolist()) if b - a >= MIN_LENGTH]
        i, j = i[good], j[good]
    return []


def word_runs(words: list[bytes]) -> np.ndarray:
    """Rows ``start, length, period`` of all runs of a text's words, by start, then period."""
    found = []
    for a, b in stretches(words):
        number: dict[bytes, int] = {}
        ids = [number.setdefault(w, len(number) + 1) for w in words[a:b]]
        rows = runs_of(ids, len(number))
        rows[:, 0] += a
        found.append(rows)
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with ``runs`` (by start, then period; in words of ``text``) and the text ``collapsed`` to one period of each run."""

    @F.pandas_udf(f"struct<runs:array<{RUN}>,collapsed:string>")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            runs, collapsed = [], []
            for t in s:
                words = t.encode().split() if isinstance(t, str) else []
                rows = word_runs(words)
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in rows.tolist()])
                collapsed.append(collapse(words, rows).decode())
            yield pd.DataFrame({"runs": runs, "collapsed": collapsed})

    free = "f"
    while free in docs.columns:
        free += "f"
    return docs.withColumn(free, found.asNondeterministic()("text")).withColumns(
        {"runs": F.col(free)["runs"], "collapsed": F.col(free)["collapsed"]}).drop(free)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: where crc32 of the decimal ``doc_id`` (null: the empty text) is divisible by ten, words from one on repeat
    with a period."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    some = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w").cast("long")
    some = some.withColumn("n", n).withColumn("a", F.when(n > 0, F.col("g") % n))
    some = some.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))

    def planted(w: Column, i: Column) -> Column:
        return F.when(i < F.col("a"), w).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))

    return some.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", F.transform("w", planted))).otherwise(F.col("text")).alias("text"))


def op12_suffix_tree_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = periodic_runs(with_planted_runs(docs)).select("doc_id", "runs", F.sha2("collapsed", 256).alias("collapsed_sha256"))
    # runs come by start, then period, so the first of equal exponents is the one wanted
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    out = rows.withColumn("b", best)
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "b.start", "b.length", "b.period",
                      F.expr("1000 * b.length div b.period").alias("exponent_milli"),
                      F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), "collapsed_sha256")
