"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over a uint64 array."""
    x = x + GOLDEN
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def every(df: DataFrame) -> list[Column]:
    """All columns of ``df`` under their own names, dots and back-ticks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def held_out(doc_id: Column) -> Column:
    """The fold no label is learnt from: crc32(doc_id as text) mod 5 is 0 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    Cuts lineage and survives a lost executor; every later use reads the same rows.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int) -> DataFrame:
    """A bounded, reproducible sample ``(text, y)`` of the labelled documents outside the held-out fold.

    At most ``rows`` rows, smallest hash of the id first; a document over ``max_bytes`` UTF-8 bytes is
    left out of the fit (never of scoring).  Rows with a null id or label are not labelled rows; an id
    labelled both ways is left out.
    """
    y = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
         .groupBy("doc_id").agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
         .where("lo = hi").select("doc_id", F.col("lo").cast("int").alias("y"))
         .where(~held_out(F.col("doc_id")))
         .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    t = docs.select("doc_id", "text").where(F.octet_length(F.coalesce("text", F.lit(""))) <= max_bytes)
    # y has at most ``rows`` rows of two numbers, so it is broadcast and no text but the sample moves
    one = t.join(F.broadcast(y), "doc_id").groupBy("doc_id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return one.select("doc_id", "text", "y").orderBy("doc_id")
