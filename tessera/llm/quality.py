"""Quality by histogram gradient-boosted trees over document statistics, in numpy.

Statistics of every whole text are binned by quantiles of the fit sample; trees grow level by level from
gradient histograms and are flattened into arrays, so scoring moves all rows of a batch down all trees at once.

Defined cases: a null text counts as empty, and empty texts are scored from their (zero) statistics; a null id
scores like any other; repeated rows give repeated results; other columns pass through, and one called
``score`` or ``predicted`` is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import held_out, labelled_sample

FIT_ROWS = 20_000
FIT_MAX_BYTES = 1_000_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
MIN_ROWS = 5
L2 = 1.0
STATISTICS = (
    "log_bytes", "log_words", "word_length", "long_words", "short_words", "upper", "digits", "spaces", "non_ascii",
    "marks", "symbols", "exclamations", "bars", "byte_entropy", "distinct_words", "top_word", "repeated_next",
    "repeated_pairs", "log_lines", "repeated_lines", "stops", "capital_words",
)
_TABLE = np.zeros(256, dtype=np.int64)  # 1 upper, 2 digit, 3 space, 4 non-ASCII, 5 punctuation, 6 symbol
for _c in range(256):
    ch = chr(_c)
    _TABLE[_c] = (4 if _c >= 128 else 1 if ch.isupper() else 2 if ch.isdigit() else 3 if ch.isspace()
                  else 5 if ch in ".,;:?'\"-()" else 6 if ch.isprintable() and not ch.isalnum() else 0)


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text, in the order of ``STATISTICS``."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, m = max(len(raw), 1), max(len(words), 1)
    hist = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kind = np.bincount(_TABLE, weights=hist, minlength=7)
    share = hist[hist > 0] / n
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    counts = Counter(words)
    top = max(counts.values(), default=0)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in raw.split(b"\n") if x]
    return [
        np.log1p(len(raw)), np.log1p(len(words)), float(sizes.mean()) if len(words) else 0.0,
        float((sizes > 12).mean()) if len(words) else 0.0, float((sizes < 4).mean()) if len(words) else 0.0,
        kind[1] / n, kind[2] / n, kind[3] / n, kind[4] / n, kind[5] / n, kind[6] / n, hist[33] / n, hist[124] / n,
        float(-(share * np.log2(share)).sum()) if len(raw) else 0.0, len(counts) / m, top / m,
        sum(map(eq, words, words[1:])) / m, 1 - pairs / max(len(words) - 1, 1) if len(words) > 1 else 0.0,
        np.log1p(len(lines)), 1 - len(set(lines)) / max(len(lines), 1) if lines else 0.0,
        (hist[46] + hist[63]) / m, sum(w[:1].isupper() for w in words) / m,
    ]


@dataclass
class Forest:
    """Flat trees: nodes of all trees in one array each; a leaf points at itself."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            below = x[rows, self.feature[at]] <= self.limit[at]
            at = np.where(below, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(x), -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Forest:
    """Boost log loss.  With one class or no rows there are no splits and the score is the prior."""
    y = np.asarray(y, dtype=np.float64)
    base = float(np.log((y.sum() + 0.5) / ((1 - y).sum() + 0.5)))
    nodes: list[list[float]] = []  # feature, limit, left, right, value
    roots = []
    n, width = x.shape if len(x) else (0, len(STATISTICS))
    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        margin = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            root = len(nodes)
            roots.append(root)
            nodes.append([0, np.inf, root, root, 0.0])
            at = np.full(n, root)
            level = [root]
            for depth in range(DEPTH + 1):
                where = np.full(len(nodes), -1)
                where[level] = np.arange(len(level))
                slot = where[at]
                on = slot >= 0
                k, s = len(level), slot[on]
                g_all = np.bincount(s, weights=grad[on], minlength=k)
                h_all = np.bincount(s, weights=hess[on], minlength=k)
                for i, node in enumerate(level):
                    nodes[node][4] = -RATE * g_all[i] / (h_all[i] + L2)
                if depth == DEPTH:
                    break
                best = np.full(k, 1e-6)
                split = [None] * k
                for j in range(width):
                    if not len(cuts[j]):
                        continue
                    b = len(cuts[j]) + 1
                    cell = s * b + binned[on, j]
                    g, h, c = (np.cumsum(np.bincount(cell, weights=w, minlength=k * b).reshape(k, b), axis=1)[:, :-1]
                               for w in (grad[on], hess[on], None))
                    total = np.bincount(s, minlength=k)[:, None]
                    ga, ha = g_all[:, None], h_all[:, None]
                    gain = g ** 2 / (h + L2) + (ga - g) ** 2 / (ha - h + L2) - ga ** 2 / (ha + L2)
                    gain[(c < MIN_ROWS) | (total - c < MIN_ROWS)] = -1
                    cut = gain.argmax(axis=1)
                    for i in np.flatnonzero(gain[np.arange(k), cut] > best):
                        best[i], split[i] = gain[i, cut[i]], (j, int(cut[i]))
                deeper = []
                for i, node in enumerate(level):
                    if split[i] is None:
                        continue
                    j, cut = split[i]
                    a = len(nodes)
                    nodes.extend([[0, np.inf, a, a, 0.0], [0, np.inf, a + 1, a + 1, 0.0]])
                    nodes[node][:4] = [j, cuts[j][cut], a, a + 1]
                    mine = at == node
                    at[mine] = np.where(binned[mine, j] <= cut, a, a + 1)
                    deeper += [a, a + 1]
                level = deeper
                if not level:
                    break
            margin += np.array([v[4] for v in nodes])[at]
    if not nodes:
        nodes, roots = [[0, np.inf, 0, 0, 0.0]], [0]
    cols = list(zip(*nodes))
    return Forest(np.array(cols[0], dtype=np.int64), np.array(cols[1]), np.array(cols[2], dtype=np.int64),
                  np.array(cols[3], dtype=np.int64), np.array(cols[4]), np.array(roots, dtype=np.int64), base)


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, max_bytes: int = FIT_MAX_BYTES) -> Forest:
    """Fit on the statistics (made on the executors) of at most ``rows`` labelled documents of at most ``max_bytes`` each, none of the held-out fold."""

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    sample = labelled_sample(docs, labels, "quality", rows, max_bytes).select("doc_id", measured("text").alias("x"), "y").orderBy("doc_id").toPandas()
    x = np.array(sample["x"].tolist(), dtype=np.float64).reshape(len(sample), len(STATISTICS))
    return fit(x, sample["y"].to_numpy())


def score(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; no shuffle, only the text goes to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # at most TREES * 2**(DEPTH + 1) nodes

    @F.pandas_udf("double")
    def good(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            x = np.array([statistics(t) for t in s], dtype=np.float64).reshape(len(s), len(STATISTICS))
            yield pd.Series(shared.value.scores(x))

    return docs.withColumn("score", good.asNondeterministic()("text")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_boosted_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    forest = fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, forest).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
