"""Reproducible global shuffle into shards: a Feistel permutation over global row numbers.

Rows get gapless global row numbers from a canonical order of their key, a keyed Feistel network with
cycle walking permutes ``0..n-1``, and the permuted position gives shard (``mod``) and slot (``div``).
Anyone who knows ``n``, the seed and a row's number can compute its place without touching another
row.  Only DataFrame and SQL functions are used.

Defined cases: a null key value sorts first and takes part like any other; rows equal in the whole key
are interchangeable and get different places; an empty table gives an empty result; a column of the
input called like one added here is read as a key if named so, and replaced in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROUNDS = 6  # even, so that the halves end in their own ranges
PRIME = 2147483647
BUCKETS = 4096


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Two 31-bit constants for each Feistel round, from a Lehmer generator."""
    x, keys = seed % (PRIME - 1) + 1, []
    for _ in range(ROUNDS):
        pair = []
        for _ in range(2):
            for _ in range(3):
                x = x * 48271 % PRIME
            pair.append(x)
        keys.append((pair[0] | 1, pair[1]))
    return keys


def _mixed(expr: str, mul: str, add: str) -> str:
    """A keyed hash of a 31-bit value that never leaves 63 bits."""
    t = f"(({expr} * {mul} + {add}) % {PRIME}L)"
    t = f"((({t}) ^ shiftright({t}, 13)) * 1103515245L + {mul}) % {PRIME}L"
    return f"({t})"


def feistel_sql(x: str, a: str, b: str, seed: int) -> str:
    """SQL text permuting ``0..a*b-1``: the halves, in Z_a and Z_b, add a keyed hash of each other in turn."""
    keys = ", ".join(f"struct({m}L as m, {c}L as c)" for m, c in round_keys(seed))
    return (f"aggregate(array({keys}), named_struct('l', {x} div {b}, 'r', {x} % {b}, 'p', {a}, 'q', {b}), "
            f"(s, k) -> named_struct('l', s.r, 'r', (s.l + {_mixed('s.r', 'k.m', 'k.c')}) % s.p, 'p', s.q, 'q', s.p), "
            "s -> s.l * s.q + s.r)")


def permuted_sql(x: str, n: str, seed: int) -> str:
    """SQL text of the place of row number ``x`` among ``n`` rows.

    ``a*b`` is the least rectangle with ``a = ceil(sqrt(n))`` that holds ``n``, so fewer than ``a`` points lie
    outside.  A walk passes each of them once at most, so ``a*b - n`` further steps always suffice, and only about
    one row in ``sqrt(n)`` walks at all.
    """
    a = f"cast(ceil(sqrt({n})) as bigint)"
    b = f"(({n} + {a} - 1) div {a})"
    step = feistel_sql("y", a, b, seed)
    first = feistel_sql(x, a, b, seed)
    return (f"aggregate(array({first}), 0L, (u, v) -> if(v < {n}, v, aggregate(sequence(1L, greatest({a} * {b} - {n}, 1L)), v, "
            f"(y, i) -> if(y < {n}, y, {step}))))")


def row_numbers(df: DataFrame, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Add ``row_number`` (gapless from 0, in order of bucket and key) and ``n_rows``.

    One exchange by bucket serves the numbering and the bucket counts; the counts (``buckets`` rows, whatever
    the data) are summed and broadcast.  The bucket hashes the whole key, so no single value is hot.
    """
    bucketed = df.withColumn("__bucket", F.pmod(F.xxhash64(*key), F.lit(buckets))).repartition("__bucket")
    counts = bucketed.groupBy(F.col("__bucket").alias("__of")).agg(F.count(F.lit(1)).alias("__count"))
    before = W.orderBy("__of").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("__of", F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__start"),
                           F.sum("__count").over(W.partitionBy()).alias("__rows"))
    ranked = bucketed.withColumn("__rank", F.row_number().over(W.partitionBy("__bucket").orderBy(*key)))
    return (ranked.join(F.broadcast(counts), F.col("__bucket") == F.col("__of"))
            .withColumn("row_number", F.col("__start") + F.col("__rank") - 1).withColumn("n_rows", F.col("__rows"))
            .drop("__bucket", "__of", "__start", "__rank", "__rows"))


def shard(df: DataFrame, n_shards: int, key: list[str], seed: int = 42) -> DataFrame:
    """Every row of ``df`` with its ``position`` in the shuffle, ``shard`` and ``slot`` (gapless in each shard).

    Shard sizes differ by one row at most.  ``key`` must tell apart rows that are not interchangeable.
    """
    return (row_numbers(df, key)
            .withColumn("position", F.expr(permuted_sql("row_number", "n_rows", seed)))
            .withColumn("shard", (F.col("position") % n_shards).cast("int"))
            .withColumn("slot", F.expr(f"position div {n_shards}")))


def op1_feistel_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by law ``rows``; a null text counts as empty."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard(rows, 8, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
