"""Joins by row key that split hot rows: by measured size at run time, or by a sketch of the frequent keys.

A join on ``rowkey`` alone hands its partitioning on to what follows: a cell aggregate on (rowkey, family, qualifier) then
runs in the join's own stage, and adaptive execution may not split a hot row there, because the aggregate would see
its groups in several tasks.  :func:`join_by_row` joins on the row key and its length.  The length changes no result, but a
partitioning by both says nothing of groups by key, so the next aggregate takes an exchange of its own (with
partial aggregation before it), and both inputs of the join are plain exchanges: adaptive execution splits the partition of a hot row
by its measured bytes and repeats only the other side's rows of that partition.  Rows that are not hot cost
nothing, no key is replicated, and no pass over the log is needed to find the hot ones.

:func:`semi_join_rows` splits hot rows before the join too, whatever adaptive execution does.  A frequent-items sketch
(``approx_top_k``, one pass over the row keys alone) names at most ``TRACKED`` rows and their counts; those of more than
``ROWS_PER_SALT`` entries get as many salts as their count asks for, and only their keys are repeated, once a salt.  The
sketch overestimates no row by more than its share of the untracked rest, and a row it misses is left to the run-time split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LENGTH = "__rowkey_length"


def join_by_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """``left`` joined with ``right`` (at most one row a key) on ``rowkey``; a hot row of ``left`` is split where its size asks for it."""
    length = F.length("rowkey")
    return left.withColumn(_LENGTH, length).join(right.withColumn(_LENGTH, length), ["rowkey", _LENGTH], how).drop(_LENGTH)


TRACKED = 1000
ROWS_PER_SALT = 20_000


def hot_rows(df: DataFrame) -> DataFrame:
    """``rowkey, salts`` of the frequent rows of ``df``, at most ``TRACKED``."""
    top = df.agg(F.expr(f"approx_top_k(rowkey, {TRACKED}, {10 * TRACKED})").alias("top")).select(F.inline("top"))
    return top.filter(F.col("count") > ROWS_PER_SALT).selectExpr("item AS rowkey", f"int(ceil(count / {ROWS_PER_SALT})) AS salts")


def semi_join_rows(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` (log or cells) whose ``rowkey`` is among ``keys``; hot rows are split by salts of column and version."""
    hot = F.broadcast(hot_rows(df))
    salt = F.when(F.col("__salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("family", "qualifier", "ts"), F.col("__salts"))).cast("int")
    left = df.join(hot.withColumnRenamed("salts", "__salts"), "rowkey", "left").withColumn("__salt", salt).drop("__salts")
    right = keys.select("rowkey").distinct().join(hot, "rowkey", "left").selectExpr(
        "rowkey", "explode(sequence(0, coalesce(salts, 1) - 1)) AS __salt")
    return left.join(right, ["rowkey", "__salt"], "left_semi").select(*df.columns)
