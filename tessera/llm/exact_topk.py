"""Exact top-k inner product search of a query set against all rows, by MaxScore over shards of candidates.

Components are the terms, a candidate's integer component the impact of its posting, and a shard keeps for each
term the largest and smallest impact, which bound what the term can add to a query's score.  Terms are taken in
falling order of those bounds.  The essential ones are traversed for all candidates of the shard; once the bounds
of the others no longer let most candidates reach the k-th best score found so far, only the still competitive
candidates are probed in the remaining terms and dropped as soon as they cannot reach it.  No candidate is dropped
that could tie.  Every block of queries meets every shard by a join on the pair's own key; each pair returns k rows
a query, which a window merges.

Defined cases: rows with a null id, a null vector, or a null or non-finite component take no part; shorter vectors
end in zeros; a query never meets rows of its own id; ties go to the smaller id; repeated rows of one id are
candidates each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARD_ROWS = 8192
QUERY_ROWS = 1024
TERMS_A_STEP = 8
PROBE_SHARE = 0.1
PAIR_TASKS = 4096


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int = 64) -> DataFrame:
    """``id, x``: floor(scale * component) of the rows that take part."""
    v = F.col(vector_col)
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & v.isNotNull() & sound)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("x")))


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def maxscore(queries: np.ndarray, query_ids: np.ndarray, docs: np.ndarray, doc_ids: np.ndarray, k: int):
    """For each query the rows of its ``k`` best documents, as (query rows, document rows, scores)."""
    order = np.lexsort((doc_ids,))
    docs, doc_ids = docs[order], doc_ids[order]
    high, low = docs.max(axis=0), docs.min(axis=0)
    # what each term can add to each query's score, and the least it adds
    upper = np.maximum(queries * high, queries * low)
    spread = upper - np.minimum(queries * high, queries * low)
    terms = np.argsort(-spread.sum(axis=0), kind="stable")
    most = int((np.abs(queries).max(initial=0)) * np.abs(docs).max(initial=0) * max(docs.shape[1], 1))
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64  # all exact
    q, d = queries[:, terms].astype(kind), np.ascontiguousarray(docs[:, terms].astype(kind))
    upper = upper[:, terms]
    rest = np.concatenate((np.cumsum(upper[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1), dtype=np.int64)), axis=1)
    n, width = d.shape
    own = query_ids[:, None] == doc_ids[None, :]
    partial = np.zeros((len(q), n), dtype=kind)
    floor = np.full(len(q), np.iinfo(np.int64).min // 4, dtype=np.int64)
    at = 0
    while at < width:
        step = slice(at, at + TERMS_A_STEP)
        partial += q[:, step] @ d[:, step].T
        at = min(at + TERMS_A_STEP, width)
        if at == width or n <= k:
            continue
        if at == TERMS_A_STEP or at * 2 >= width and at - TERMS_A_STEP < width / 2:
            # whole scores of the most promising documents give the k-th best so far
            lead = min(n, 2 * k + 1)
            some = np.argpartition(partial, n - lead, axis=1)[:, n - lead:]
            for i in range(len(q)):
                mine = some[i][~own[i, some[i]]]
                if len(mine) >= k:
                    floor[i] = max(floor[i], int(np.sort((d[mine] @ q[i]).astype(np.int64))[-k]))
        alive = partial >= (floor - rest[:, at])[:, None].astype(kind)
        if alive.mean() <= PROBE_SHARE:
            return _probe(q, d, doc_ids, partial, alive & ~own, floor, rest, at, k)
    rows, found, scores = [], [], []
    for i in range(len(q)):
        mine = np.flatnonzero(~own[i])
        score = partial[i, mine].astype(np.int64)
        best = _best(score, k)
        rows.append(np.full(len(best), i))
        found.append(doc_ids[mine[best]])
        scores.append(score[best])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest, ties in order of place."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        places = np.flatnonzero(score >= least)
    else:
        places = np.arange(len(score))
    return places[np.argsort(-score[places], kind="stable")][:k]


def _probe(q, d, doc_ids, partial, alive, floor, rest, at, k):
    rows, found, scores = [], [], []
    for i in range(len(q)):
        mine = np.flatnonzero(alive[i])
        score = partial[i, mine]
        for lo in range(at, d.shape[1], TERMS_A_STEP):
            score = score + d[mine, lo:lo + TERMS_A_STEP] @ q[i, lo:lo + TERMS_A_STEP]
            still = score >= floor[i] - rest[i, min(lo + TERMS_A_STEP, d.shape[1])]
            mine, score = mine[still], score[still]
        score = score.astype(np.int64)
        best = _best(score, k)
        rows.append(np.full(len(best), i))
        found.append(doc_ids[mine[best]])
        scores.append(score[best])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best of ``candidates`` for each of ``queries`` (both ``id, x``)."""
    n, m = candidates.count(), queries.count()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-m // QUERY_ROWS))
    tasks = min(shards * blocks, PAIR_TASKS)

    def packed(rows: DataFrame, name: str, parts: int, other: str, others: int, prefix: str) -> DataFrame:
        groups = rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(parts)).alias(name)).agg(F.collect_list(F.struct("id", "x")).alias("r"))
        return (groups.select(name, F.col("r.id").alias(f"{prefix}_ids"), F.col("r.x").alias(f"{prefix}_x"),
                              F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))).alias(other))
                .repartition(tasks, "shard", "block"))

    pairs = packed(candidates, "shard", shards, "block", blocks, "c").join(packed(queries, "block", blocks, "shard", shards, "q"), ["shard", "block"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                width = max((len(x) for part in (r.c_x, r.q_x) for x in part), default=0)
                q_ids = np.asarray(r.q_ids, dtype=np.int64)
                who, ids, scores = maxscore(_matrix(r.q_x, width), q_ids, _matrix(r.c_x, width), np.asarray(r.c_ids, dtype=np.int64), k)
                yield pd.DataFrame({"query_id": q_ids[who], "vec_id": ids, "score": scores})

    found = pairs.select("c_ids", "c_x", "q_ids", "q_x").mapInPandas(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_maxscore_topk(spark, sf_dir: str) -> DataFrame:
    """Rows whose id is divisible by 20 against all rows; the 20 best of each."""
    rows = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return top_k(rows, rows.where("id % 20 = 0"), 20)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
