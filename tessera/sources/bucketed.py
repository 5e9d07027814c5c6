"""Logs bucketed by cell: version resolution without an exchange for the cells.

``bulk_load_bucketed`` (W6) writes a Spark table clustered and sorted by (row key, family, qualifier).  All versions and tombstones
of a cell lie in one bucket, so both aggregations of :func:`resolve_cells` run on the scan's own partitioning; what remains is the
join with the row tombstones.  With one file a bucket, as a load writes them, and ``spark.sql.legacy.bucketedTableScan.outputOrdering``
Spark takes the files' order too.

A bucket is read by one task.  A row of many columns is spread over the buckets, a cell of many versions is not: cells of more than
``HOT_VERSIONS`` entries, named by a frequent-items sketch of at most ``TRACKED`` cells, go to a plain folder beside the table and are
resolved by exchange, where versions spread over tasks.  Each cell is in one of the two, so the results just add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.model import DEL_ROW, LOG_COLUMNS, LOG_SCHEMA
from tessera.operators.partitioning import partitions_for
from tessera.operators.skew import TRACKED, join_by_row
from tessera.operators.versions import AFTER_ROW_DELETE, CELL, CELL_COLUMNS, resolve_cells

HOT_VERSIONS = 1_000_000
_NAME = "__cell"


def _with_name(rows: DataFrame) -> DataFrame:
    """One text for each cell; cells that share a text are parted alike, which is all that matters here."""
    return rows.withColumn(_NAME, F.concat_ws("\0", *CELL))


def hot_cells(rows: DataFrame, versions: int = HOT_VERSIONS) -> DataFrame:
    """The names of cells of more than ``versions`` entries, at most ``TRACKED``."""
    top = _with_name(rows).agg(F.expr(f"approx_top_k({_NAME}, {TRACKED}, {10 * TRACKED})").alias("top")).select(F.inline("top"))
    return top.filter(F.col("count") > versions).select(F.col("item").alias(_NAME))


def bulk_load_bucketed(cells: DataFrame, table: str, path: str, buckets: int, *, hot_versions: int = HOT_VERSIONS) -> None:
    """Write ``cells`` as the external table ``table`` of at least ``buckets`` buckets under ``path``; older files there are replaced.

    The input is read three times (sketch, hot cells, the others): stage it first where it is dear to compute.
    """
    rows = cells.select(*LOG_COLUMNS)
    hot = F.broadcast(hot_cells(rows, hot_versions))
    number = partitions_for(rows, buckets)
    named = _with_name(rows)
    named.join(hot, _NAME, "left_semi").select(*LOG_COLUMNS).write.mode("overwrite").parquet(f"{path}/hot")
    (named.join(hot, _NAME, "left_anti").select(*LOG_COLUMNS).repartition(number, *CELL)
     .write.mode("overwrite").bucketBy(number, *CELL).sortBy(*CELL).option("path", f"{path}/buckets").saveAsTable(table))


def attach(spark: SparkSession, table: str, path: str, buckets: int) -> None:
    """Name the files of an earlier load, of ``buckets`` buckets, as ``table`` in this session's catalog."""
    cell = ", ".join(CELL)
    spark.sql(f"CREATE TABLE {table} ({LOG_SCHEMA.toDDL()}) USING parquet CLUSTERED BY ({cell}) SORTED BY ({cell}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}/buckets'")


def latest_cells_bucketed(spark: SparkSession, table: str, path: str, *, version_deletes: bool = True, row_deletes: bool = True) -> DataFrame:
    """Live latest cells of a bucketed log, as :func:`latest_cells` gives them."""
    parts = [spark.table(table).select(*LOG_COLUMNS), spark.read.schema(LOG_SCHEMA).parquet(f"{path}/hot")]
    cells = resolve_cells(parts[0], version_deletes=version_deletes).unionByName(resolve_cells(parts[1], version_deletes=version_deletes))
    if row_deletes:
        marks = [p.filter(F.col("op") == DEL_ROW).select("rowkey", "ts") for p in parts]
        marks = marks[0].unionByName(marks[1]).groupBy("rowkey").agg(F.max("ts").alias("tr"))
        cells = join_by_row(cells, marks, "left").filter(AFTER_ROW_DELETE)
    return cells.select(*CELL_COLUMNS)
