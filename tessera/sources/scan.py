"""Scans over a mutation log.

Every scan is ``key predicate -> latest_cells -> projection``.  The key
predicate is applied to the log *before* version resolution, where it is a
Parquet-pushed filter and shrinks the aggregation; the column restriction
prunes cells the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.codec import decode
from tessera.model import LOG_COLUMNS
from tessera.operators.filters import row_range, rows_in
from tessera.operators.shape import decode_columns
from tessera.operators.skew import join_by_row
from tessera.operators.versions import AFTER_ROW_DELETE, CELL_COLUMNS, latest_cells, resolve_cells, tested_rows
from tessera.sources.keyed import among_parts, only_part_of

DEFAULT_START = "0"
DEFAULT_STOP = "~~~~"


def raw_scan(log: DataFrame, start: str | None = None, stop: str | None = None, *,
             families: Sequence[str] | None = None, columns: Sequence[tuple[str, str]] | None = None,
             **resolve) -> DataFrame:
    """getRawRDD: live cells of rows in ``[start, stop)``, optionally restricted to families / columns."""
    pruned = log.filter(row_range(start, stop))
    if families:
        pruned = pruned.filter(F.col("family").isin(*families) | F.col("family").isNull())
    if columns:
        cond = F.lit(False)
        for fam, qual in columns:
            cond = cond | ((F.col("family") == fam) & (F.col("qualifier") == qual))
        pruned = pruned.filter(cond | F.col("family").isNull())
    return latest_cells(pruned, **resolve)


def scan_column(log: DataFrame, family: str, qualifier: str, start: str = DEFAULT_START,
                stop: str = DEFAULT_STOP, **resolve) -> DataFrame:
    """getRawRDDByFamilyColumn: cells of one column; rows lacking the column do not appear."""
    return raw_scan(log, start, stop, columns=[(family, qualifier)], **resolve)


def scan_column_typed(log: DataFrame, family: str, qualifier: str, type_name: str, start: str | None = None,
                      stop: str | None = None, **resolve) -> DataFrame:
    """getRDD[T] (single column, all rows): ``(rowkey, value)``; NULL for rows without the column.

    Pivot-first (``decode_log``): one row per key before the row tombstones are joined.
    """
    from tessera.operators.shape import decode_log

    d = decode_log(log.filter(row_range(start, stop)), [(f"{family}:{qualifier}", type_name)], with_key=True,
                   defaults=False, all_rows=True, **resolve)
    return d.select(F.col("ROWKEY").alias("rowkey"), F.col(f"`{family}:{qualifier}`").alias("value"))


def scan_column_string(log: DataFrame, family: str, qualifier: str, start: str | None = None,
                       stop: str | None = None, **resolve) -> DataFrame:
    """getRDD -> String: ``(rowkey, value)`` of every live row in the bounds; NULL for rows without the column."""
    return scan_column_typed(log, family, qualifier, "string", start, stop, **resolve)


def scan_columns(log: DataFrame, family: str, columns: Sequence[tuple[str, str]], start: str | None = None,
                 stop: str | None = None, *, with_key: bool = True, **resolve) -> DataFrame:
    """Multi-column projection scan in one family: only listed columns are read and decoded."""
    cells = raw_scan(log, start, stop, columns=[(family, q) for q, _ in columns], **resolve)
    return decode_columns(cells, columns, family=family, with_key=with_key, all_rows=False)


def scan_mapped(log: DataFrame, mapper: Callable[[DataFrame], DataFrame], start: str | None = None,
                stop: str | None = None, **resolve) -> DataFrame:
    """getRDD with a Result mapper: the mapper is a DataFrame transform over the live cells."""
    return raw_scan(log, start, stop, **resolve).transform(mapper)


def scan_keys(log: DataFrame, start: str | None = None, stop: str | None = None, **resolve) -> DataFrame:
    """distributedScan -> keys: distinct live row keys."""
    return raw_scan(log, start, stop, values=False, **resolve).select("rowkey").distinct()


def scan_key_only(log: DataFrame, start: str | None = None, stop: str | None = None, **resolve) -> DataFrame:
    """KeyOnlyFilter during the scan: live coordinates with empty values; the value column is not read."""
    return raw_scan(log, start, stop, values=False, **resolve)


def scan_count(log: DataFrame, start: str | None = None, stop: str | None = None, **resolve) -> DataFrame:
    """Row count of the scan as a one-row frame (no driver-side loop)."""
    return raw_scan(log, start, stop, values=False, **resolve).agg(F.count_distinct("rowkey").alias("n_rows"))


def bulk_get(log: DataFrame, keys: DataFrame, *, keep_missing: bool = False, **resolve) -> DataFrame:
    """bulkGet: live cells of the rows named in ``keys`` (column ``rowkey``).

    A semi-join (:func:`rows_in`): the planner broadcasts the key frame
    when its measured size is small and splits hot rows otherwise.  ``keep_missing=True`` adds
    absent keys as rows with NULL coordinates.  Of a log laid out by key only the parts of ``keys`` are read.
    """
    k = keys.select(F.col("rowkey").cast("string")).distinct()
    hit = latest_cells(rows_in(among_parts(log, k), k), **resolve)
    if not keep_missing:
        return hit
    return k.join(hit, "rowkey", "left")


def get_value(log: DataFrame, keys: DataFrame, family: str, qualifier: str, type_name: str = "string",
              **resolve) -> DataFrame:
    """getAResult for a frame of keys: ``(rowkey, value)``, NULL when the row or column is absent."""
    k = keys.select(F.col("rowkey").cast("string")).distinct()
    col_log = log.filter(((F.col("family") == family) & (F.col("qualifier") == qualifier)) | F.col("family").isNull())
    cells = latest_cells(rows_in(among_parts(col_log, k), k), **resolve)
    return k.join(cells.select("rowkey", decode("value", type_name).alias("value")), "rowkey", "left")


def scan_row(log: DataFrame, key: str, **resolve) -> DataFrame:
    """RowFilter(EQUAL) during the scan: live cells of one row; of a log laid out by key one part is read."""
    return latest_cells(only_part_of(log, key).filter(F.col("rowkey") == F.lit(key)), **resolve)


def scan_record(log: DataFrame, family: str, qualifier: str, type_name: str = "string", **resolve) -> DataFrame:
    """scanRecord: ``(rowkey, value)`` of one column over the whole table."""
    cells = raw_scan(log, columns=[(family, qualifier)], **resolve)
    return cells.select("rowkey", decode("value", type_name).alias("value"))


def prefix_first_row(log: DataFrame, prefix: str, family: str, **resolve) -> DataFrame:
    """Prefix scan of one family returning the first live row only.

    The first key is a one-value aggregate used as a scalar subquery.
    """
    cells = raw_scan(log.filter(F.col("rowkey").startswith(prefix)) if prefix else log, families=[family],
                     **resolve).filter(F.col("family") == family)
    first = cells.agg(F.min("rowkey").alias("k")).scalar()
    return cells.filter(F.col("rowkey") == first)


def scan_rows_where_column(log: DataFrame, family: str, qualifier: str, value_pred, *, start: str | None = None,
                           stop: str | None = None, exclude_tested: bool = False, version_deletes: bool = True,
                           row_deletes: bool = True) -> DataFrame:
    """SingleColumnValueFilter applied during the scan (rows missing the column drop).

    1. One pass over the tested column and the row tombstones (the column
       restriction reaches the scan) gives the keys whose live value
       satisfies ``value_pred`` (a predicate over the ``value`` bytes), each
       with the ts of its row tombstone.
    2. The log's entries of those rows, joined by key, are resolved once;
       the row tombstone that came with the key hides what is older.

    Two scans of the log, no row tombstone is joined again, and a row without
    a match is not resolved.  AQE measures the keys before choosing broadcast or shuffle.
    """
    entries = log.filter(row_range(start, stop)).select(*LOG_COLUMNS)
    keys = tested_rows(entries, family, qualifier, value_pred, version_deletes=version_deletes, row_deletes=row_deletes)
    mine = entries.filter(F.col("family").isNotNull())
    if exclude_tested:
        mine = mine.filter(~((F.col("family") == family) & (F.col("qualifier") == qualifier)))
    cells = resolve_cells(join_by_row(mine, keys, "inner"), version_deletes=version_deletes, carry=("tr",))
    return cells.filter(AFTER_ROW_DELETE).select(*CELL_COLUMNS)
