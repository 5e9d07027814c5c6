"""Writes, deletes and table-to-table jobs as mutation batches.

Every mutation is a log row; a batch is a DataFrame in the log layout.
:func:`append` writes a batch (Parquet append: parallel, no read of the
table), and :func:`apply_batch` returns the live view of ``log + batch``
without writing, which the query plans use.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.model import DEL_COLUMN, DEL_ROW, DEL_VERSION, LOG_COLUMNS, PUT
from tessera.functions.keys import part_column, part_of
from tessera.operators.batch import batch_ts, put_seq, put_ts  # noqa: F401
from tessera.operators.filters import row_range, rows_in
from tessera.operators.partitioning import partitions_for
from tessera.operators.shape import encode_cf, encode_family, explode_map_batch, melt_to_cells
from tessera.operators.versions import latest_cells


def append(batch: DataFrame, path: str, *, key_parts: int | None = None) -> None:
    """Append a mutation batch to the log at ``path`` (``key_parts``: of a log laid out by key, its number of parts)."""
    rows = batch.select(*LOG_COLUMNS)
    if key_parts is None:
        rows.write.mode("append").parquet(path)
    else:
        part = part_column(key_parts)
        rows.withColumn(part, part_of("rowkey", key_parts)).write.mode("append").partitionBy(part).parquet(path)


def with_batches(log: DataFrame, *batches: DataFrame) -> DataFrame:
    """The log as it reads after appending ``batches`` (a union; nothing is written)."""
    out = log.select(*LOG_COLUMNS)
    for b in batches:
        out = out.unionByName(b.select(*LOG_COLUMNS))
    return out


def apply_batch(log: DataFrame, *batches: DataFrame, **resolve) -> DataFrame:
    """Live cells after applying ``batches`` to ``log`` (union -> latest_cells)."""
    return latest_cells(with_batches(log, *batches), **resolve)


# ------------------------------------------------------------------- puts
def upsert_cf_map(data: DataFrame, key: str = "rowkey", map_col: str = "cells", *, ts=None, seq=None,
                  types: dict[str, str] | None = None) -> DataFrame:
    """putRDD(table, RDD[(key, Map["cf:q", value])]): one put per map entry (``types``: of mixed string values)."""
    return explode_map_batch(data, key, map_col, ts=put_ts(ts), seq=put_seq(seq), types=types)


def upsert_mapped(data: DataFrame, mapper: Callable[[DataFrame], DataFrame], *, ts=None, seq=None) -> DataFrame:
    """putRDD with a user mapper: ``mapper`` turns the input rows into ``(rowkey, family, qualifier, value)``."""
    cells = data.transform(mapper)
    return cells.select(F.col("rowkey").cast("string"), "family", "qualifier", put_ts(ts).alias("ts"),
                        put_seq(seq).alias("seq"), F.lit(PUT).alias("op"), "value")


def upsert_family(data: DataFrame, key: str, family: str, *, ts=None, seq=None) -> DataFrame:
    """putRDD with a fixed family: every non-key column becomes ``family:<column>``."""
    return encode_family(data, key, family, ts=put_ts(ts), seq=put_seq(seq))


def upsert_cf_columns(data: DataFrame, key: str, *, ts=None, seq=None) -> DataFrame:
    """Columns named ``family:qualifier`` -> puts."""
    return encode_cf(data, key, ts=put_ts(ts), seq=put_seq(seq))


def bulk_put(data: DataFrame, key: str = "rowkey", cells_col: str = "cells", *, ts=None, seq=None) -> DataFrame:
    """bulkPut: ``(key, array<struct<family, qualifier, value>>)`` -> puts (values already bytes or text)."""
    exploded = data.select(F.col(key).cast("string").alias("rowkey"), F.inline(cells_col))
    value = F.col("value")
    if dict(exploded.dtypes)["value"] != "binary":
        value = F.encode(F.col("value").cast("string"), "UTF-8")
    return exploded.select("rowkey", "family", "qualifier", put_ts(ts).alias("ts"), put_seq(seq).alias("seq"),
                           F.lit(PUT).alias("op"), value.alias("value"))


def bulk_put_with_timestamp(data: DataFrame, ts: int, key: str = "rowkey", cells_col: str = "cells",
                            *, seq=None) -> DataFrame:
    """bulkPutWithTimestamp: one explicit ts for the whole batch (an older ts does not win)."""
    return bulk_put(data, key, cells_col, ts=ts, seq=seq)


# ---------------------------------------------------------------- deletes
def _tomb(keys: DataFrame, op: str, ts, seq, family=None, qualifier=None) -> DataFrame:
    fam = family if isinstance(family, Column) else F.lit(family).cast("string")
    qual = qualifier if isinstance(qualifier, Column) else F.lit(qualifier).cast("string")
    return keys.select(F.col("rowkey").cast("string").alias("rowkey"), fam.alias("family"), qual.alias("qualifier"),
                       put_ts(ts).alias("ts"), put_seq(seq).alias("seq"), F.lit(op).alias("op"),
                       F.lit(None).cast("binary").alias("value"))


def delete_rows(keys: DataFrame, *, ts=None, seq=None) -> DataFrame:
    """deleteRDD(table, rows) / bulkDelete: whole-row tombstones for a frame of keys."""
    return _tomb(keys, DEL_ROW, ts, seq)


def delete_columns(data: DataFrame, family: str, key: str = "rowkey", cols: str = "columns", *, ts=None,
                   seq=None) -> DataFrame:
    """deleteRDD(table, cf, RDD[(key, List[column])]): all versions of each listed column."""
    exploded = data.select(F.col(key).alias("rowkey"), F.explode(cols).alias("qualifier"))
    return _tomb(exploded, DEL_COLUMN, ts, seq, family=family, qualifier=F.col("qualifier"))


def delete_mapped(data: DataFrame, mapper: Callable[[DataFrame], DataFrame], *, ts=None, seq=None) -> DataFrame:
    """deleteRDD with a user mapper: ``mapper`` yields ``(rowkey, family, qualifier)`` columns to delete (all versions)."""
    cells = data.transform(mapper)
    return _tomb(cells, DEL_COLUMN, ts, seq, family=F.col("family"), qualifier=F.col("qualifier"))


def delete_latest_version(log: DataFrame, targets: DataFrame, *, seq=None, **resolve) -> DataFrame:
    """deleteRecord: delete only the newest live version of each ``(rowkey, family, qualifier)`` target.

    The live version's ts comes from a join with the resolved cells; the
    tombstone sits at exactly that ts, so the previous version resurfaces.
    """
    t = targets.select("rowkey", "family", "qualifier").distinct()
    live = latest_cells(rows_in(log, t), **resolve)
    hit = live.join(t, ["rowkey", "family", "qualifier"], "left_semi")
    return hit.select("rowkey", "family", "qualifier", "ts", put_seq(seq).alias("seq"),
                      F.lit(DEL_VERSION).alias("op"), F.lit(None).cast("binary").alias("value"))


def delete_range(log: DataFrame, start: str, stop: str, *, ts=None, seq=None, **resolve) -> DataFrame:
    """Scan-then-delete: row tombstones for every live row in ``[start, stop)``."""
    keys = latest_cells(log.filter(row_range(start, stop)), values=False, **resolve).select("rowkey").distinct()
    return delete_rows(keys, ts=ts, seq=seq)


# ------------------------------------------------------------- table copy
def copy_table(log: DataFrame, *, ts=None, seq=None, **resolve) -> DataFrame:
    """res2Put / write(read()): every live cell re-put into a target, re-stamped with the batch ts."""
    live = latest_cells(log, **resolve)
    return live.select("rowkey", "family", "qualifier", put_ts(ts).alias("ts"), put_seq(seq).alias("seq"),
                       F.lit(PUT).alias("op"), "value")


# -------------------------------------------------------------- bulk load
def bulk_load(cells: DataFrame, path: str, partitions: int, *, key_parts: int | None = None) -> None:
    """generateHFile: write cells as at least ``partitions`` ranges of (rowkey, family, qualifier), each file sorted.

    ``repartitionByRange`` samples the keys to pick balanced bounds; the range
    covers all three key columns, so a hot row spans several files, and more
    ranges are cut when the plan's size estimate asks for them.  Files are
    globally ordered, and Parquet min/max statistics prune later key-range
    scans.  The output folder is replaced (the old files are removed first).

    ``key_parts`` lays the files out by key instead (:mod:`tessera.sources.keyed`): a partition folder for each residue of the
    row key's hash, files sorted within it, so that a keyed lookup reads the folders of its keys only.
    """
    key = ["rowkey", "family", "qualifier"]
    rows = cells.select(*LOG_COLUMNS)
    least = partitions_for(rows, partitions)
    if key_parts is None:
        rows.repartitionByRange(least, *key).sortWithinPartitions(*key).write.mode("overwrite").parquet(path)
        return
    part = part_column(key_parts)
    (rows.withColumn(part, part_of("rowkey", key_parts)).repartitionByRange(max(least, min(key_parts, 4 * least)), part, *key)
     .sortWithinPartitions(part, *key).write.mode("overwrite").partitionBy(part).parquet(path))


def load_staged(spark, staged_path: str, table_path: str) -> None:
    """bulkLoadWithExistedHFile: move staged, sorted files into the table's log and remove the staging folder.

    A metadata operation of the table's filesystem; no byte is rewritten.
    File names are unique, so a repeated load after a failure moves the rest.  Partition folders keep their names, so a
    staging folder laid out by key joins a table of the same layout.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, target = path(staged_path), path(table_path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())

    def move(source, target) -> None:
        fs.mkdirs(target)
        for f in fs.listStatus(source):
            name = f.getPath().getName()
            if f.isDirectory() and "=" in name:
                move(f.getPath(), path(target, name))
            elif name.endswith(".parquet") and not fs.rename(f.getPath(), path(target, name)):
                raise OSError(f"cannot move {f.getPath()} to {target}")

    move(source, target)
    fs.delete(source, True)


def cells_from_columns(df: DataFrame, key: str, specs: Sequence, *, ts=None, seq=None) -> DataFrame:
    """Typed columns -> puts using explicit column specs."""
    return melt_to_cells(df, key, specs, ts=put_ts(ts), seq=put_seq(seq))
