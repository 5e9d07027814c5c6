"""V1: resolve the live latest version of every cell of a mutation log.

Semantics (store rules): a put is hidden by a ``del_row`` of its row or a
``del_column`` of its cell whose ts is >= the put's ts, and by a
``del_version`` at exactly its ts.  Among the visible puts of a cell the one
with the highest ``(ts, seq)`` wins.

Plan, chosen for skew and scale:

1. *Version level* (only when version deletes may exist): aggregate on
   ``(rowkey, family, qualifier, ts)``.  Hashing on ``ts`` as well spreads a
   hot cell with millions of versions over many tasks; duplicates of one
   version collapse in the map-side partial aggregate.
2. *Cell level*: ``max_by(struct(ts, seq, value))`` grouped by cell, with
   the column-tombstone watermark in the same aggregate.  Partial
   aggregation combines map-side, so a hot cell leaves each task as one row.
   Because tombstones hide everything at or below their ts, comparing only
   the newest put with the watermark is exact.
3. *Row level*: one row per deleted row (max tombstone ts) joined by key
   such that AQE can split a wide hot row by its measured size
   (:mod:`tessera.operators.skew`).  AQE turns it into a broadcast when the
   tombstone side is small at run time.

All stages are planned unless the caller states that the log holds no
version or no row tombstones; building a plan never runs a job.  A log of
puts and column deletes so described resolves with a single partially
aggregated shuffle.  Binary values make Spark sort each side of the aggregate;
``values=False`` leaves them out of scan, shuffle and sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.model import DEL_COLUMN, DEL_ROW, DEL_VERSION, LOG_COLUMNS, PUT
from tessera.operators.skew import join_by_row

CELL = ["rowkey", "family", "qualifier"]
CELL_COLUMNS = ["rowkey", "family", "qualifier", "ts", "seq", "value"]
AFTER_ROW_DELETE = "tr IS NULL OR ts > tr"


def latest_cells(log: DataFrame, *, version_deletes: bool = True, row_deletes: bool = True, values: bool = True) -> DataFrame:
    """Live latest cells ``(rowkey, family, qualifier, ts, seq, value)``.

    ``version_deletes`` / ``row_deletes``: ``False`` skips the stage, for logs
    that hold no such tombstones; it saves a full shuffle (version level) or
    a join (row level).  ``values=False`` resolves coordinates only: the
    value column is not read, and every ``value`` is empty.
    """
    entries = log.select(*LOG_COLUMNS) if values else log.select(*LOG_COLUMNS[:-1]).withColumn("value", F.lit(b""))
    cells = resolve_cells(entries, version_deletes=version_deletes)
    if row_deletes:
        marks = entries.filter(F.col("op") == DEL_ROW).groupBy("rowkey").agg(F.max("ts").alias("tr"))
        cells = join_by_row(cells, marks, "left").filter(AFTER_ROW_DELETE).select(*CELL_COLUMNS)
    return cells


def resolve_cells(entries: DataFrame, *, version_deletes: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """The version and cell levels alone; columns ``carry``, equal in all entries of a row, stay with its cells."""
    op = F.col("op")
    is_put = op == PUT
    kept = [F.max(c).alias(c) for c in carry]
    if version_deletes:
        per_version = (
            entries.filter(op.isin(PUT, DEL_COLUMN, DEL_VERSION))
            .groupBy(*CELL, "ts")
            .agg(
                F.max_by(F.when(is_put, F.struct("seq", "value")), F.when(is_put, F.col("seq"))).alias("top"),
                F.max(F.when(op == DEL_VERSION, F.lit(True))).alias("vdel"),
                F.max(F.when(op == DEL_COLUMN, F.lit(True))).alias("cdel"),
                *kept,
            )
        )
        live_put = F.col("top").isNotNull() & F.col("vdel").isNull()
        order = F.when(live_put, F.struct("ts", F.col("top.seq").alias("seq")))
        cells = per_version.groupBy(*CELL).agg(
            F.max_by(F.when(live_put, F.struct("ts", F.col("top.seq").alias("seq"), F.col("top.value").alias("value"))),
                     order).alias("top"),
            F.max(F.when(F.col("cdel"), F.col("ts"))).alias("tc"),
            *kept,
        )
    else:
        order = F.when(is_put, F.struct("ts", "seq"))
        cells = (
            entries.filter(op.isin(PUT, DEL_COLUMN))
            .groupBy(*CELL)
            .agg(
                F.max_by(F.when(is_put, F.struct("ts", "seq", "value")), order).alias("top"),
                F.max(F.when(op == DEL_COLUMN, F.col("ts"))).alias("tc"),
                *kept,
            )
        )
    cells = cells.filter(F.col("top").isNotNull() & (F.col("tc").isNull() | (F.col("top.ts") > F.col("tc"))))
    return cells.select(*CELL, "top.ts", "top.seq", "top.value", *carry)


def tested_rows(entries: DataFrame, family: str, qualifier: str, value_pred, *, version_deletes: bool = True, row_deletes: bool = True) -> DataFrame:
    """``rowkey, tr``: rows whose live value of one column satisfies ``value_pred``, with the ts of their row tombstone.

    Verdict and row tombstones come from one pass: the predicate is evaluated where an entry is read, so that the aggregates
    carry a boolean and numbers (a hash aggregate) instead of values.
    """
    op = F.col("op")
    tested = (F.col("family") == family) & (F.col("qualifier") == qualifier)
    need = entries.filter((tested & op.isin(PUT, DEL_COLUMN, DEL_VERSION)) | (op == DEL_ROW)).select(
        "rowkey", "ts", "seq", "op", F.when(op == PUT, F.coalesce(value_pred, F.lit(False))).alias("ok"))
    if version_deletes:
        need = need.groupBy("rowkey", "ts").agg(
            F.max_by("ok", F.when(op == PUT, F.col("seq"))).alias("ok"),
            *[F.max(F.when(op == d, F.lit(True))).alias(d) for d in (DEL_VERSION, DEL_COLUMN, DEL_ROW)])
        put = F.col("ok").isNotNull() & F.col(DEL_VERSION).isNull()
        top = [F.max_by(F.when(put, F.col("ok")), F.when(put, F.col("ts"))).alias("ok"), F.max(F.when(put, F.col("ts"))).alias("ts")]
        marks = [F.max(F.when(F.col(DEL_COLUMN), F.col("ts"))).alias("tc"), F.max(F.when(F.col(DEL_ROW), F.col("ts"))).alias("tr")]
    else:
        order = F.when(op == PUT, F.struct("ts", "seq"))
        top = [F.max_by("ok", order).alias("ok"), F.max(F.when(op == PUT, F.col("ts"))).alias("ts")]
        marks = [F.max(F.when(op == d, F.col("ts"))).alias(t) for d, t in ((DEL_COLUMN, "tc"), (DEL_ROW, "tr"))]
    rows = need.groupBy("rowkey").agg(*top, *marks).filter("ok AND (tc IS NULL OR ts > tc)")
    return rows.filter(AFTER_ROW_DELETE).select("rowkey", "tr") if row_deletes else rows.select("rowkey", F.lit(None).cast("long").alias("tr"))
