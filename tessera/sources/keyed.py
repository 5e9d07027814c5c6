"""Logs laid out by key: a keyed lookup reads the parts of its keys only.

``mutate.bulk_load(..., key_parts=n)`` writes a partition folder for each residue of the row key's hash; the name of the
partition column carries ``n``, so a log tells its own layout and appended batches follow it.  A lookup joins the
log with the parts of its keys, at most ``MAX_KEY_PARTS`` integers and therefore broadcast.  Spark reuses that broadcast as a
dynamic partition filter: folders of other parts are neither listed into tasks nor opened, and the files of those
that stay are sorted, so row groups without wanted cells are skipped as in any scan.

How many parts: about the log's bytes over what one lookup may read for a key, say 1 GB; a part of a hot row has many files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.keys import key_parts, part_column, part_of


def among_parts(log: DataFrame, keys: DataFrame) -> DataFrame:
    """``log`` without parts that hold none of ``keys`` (column ``rowkey``); any other log as it is."""
    parts = key_parts(log.columns)
    if parts is None:
        return log
    name = part_column(parts)
    wanted = keys.select(part_of(F.col("rowkey").cast("string"), parts).alias(name)).distinct()
    # residues are never negative: the comparison only tells the planner that the keys are a selection
    return log.join(F.broadcast(wanted.filter(F.col(name) >= 0)), name, "left_semi")


def only_part_of(log: DataFrame, key: str) -> DataFrame:
    """``log`` without parts that cannot hold the row ``key``: a partition filter known before the scan."""
    parts = key_parts(log.columns)
    return log if parts is None else log.filter(F.col(part_column(parts)) == part_of(F.lit(key), parts))
