"""Delimited text puts (``rowkey,qualifier,value`` per line)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.model import PUT
from tessera.operators.batch import put_seq, put_ts


def parse_text_puts(lines: DataFrame, family: str, *, ts=None, seq=None, order: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines -> ``(puts, rejects)``.  Extra fields are ignored; lines with < 3 fields are rejected.

    ``ts`` defaults to the batch time and ``seq`` to the batch number, as for every other write.  Lines of one
    load that name the same cell share both: with ``order``, a sortable column of ``lines``, the last of them is the put of the
    load (the store keeps one put a cell and ts); without it, which of them wins is arbitrary.
    """
    at = [] if order is None else [order.alias("at")]
    parts = lines.select(F.col("value").alias("line"), F.split(F.col("value"), ",").alias("f"), *at)
    good = F.size("f") >= 3
    found = parts.filter(good).select(F.col("f")[0].alias("rowkey"), F.col("f")[1].alias("qualifier"), F.col("f")[2].alias("text"),
                                      *(["at"] if at else []))
    if at:
        found = found.groupBy("rowkey", "qualifier").agg(F.max_by("text", "at").alias("text"))
    puts = found.select(
        "rowkey", F.lit(family).alias("family"), "qualifier",
        put_ts(ts).alias("ts"), put_seq(seq).alias("seq"), F.lit(PUT).alias("op"), F.encode("text", "UTF-8").alias("value"))
    rejects = parts.filter(~good).select("line")
    return puts, rejects


def line_order() -> Column:
    """The place of a text line: file path, start of the block it is read in, and its place within the block.

    A block is read by one task from its start on, so however the files are split, lines of one file compare as they stand in it.
    """
    return F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line"))


def load_text_puts(spark: SparkSession, paths: str, family: str, **kw) -> tuple[DataFrame, DataFrame]:
    """bulkPutFromFile: comma-separated list of input paths, read in parallel by Spark.

    Of the lines of one load that name the same cell the last wins: by file path, then by place in the file.
    """
    lines = spark.read.text([p for p in paths.split(",") if p])
    return parse_text_puts(lines, family, **{"order": line_order(), **kw})
