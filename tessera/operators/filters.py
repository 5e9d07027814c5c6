"""Row, column and value filters as composable ``cells -> cells`` functions.

Key predicates (range, prefix, equality) are plain comparisons on
``rowkey`` and reach the Parquet scan as pushed filters; applied before
version resolution they also prune the aggregation input, because Catalyst
moves predicates on grouping keys below the aggregate.  Row-level filters
that depend on a cell value find the qualifying keys first and semi-join,
so the whole row is kept or dropped without collecting it.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.skew import semi_join_rows

CELL_ORDERED = ["rowkey", "family", "qualifier", "ts", "seq", "value"]
CellFilter = Callable[[DataFrame], DataFrame]


def _text(value: Column | str = "value") -> Column:
    c = F.col(value) if isinstance(value, str) else value
    return F.decode(c, "UTF-8")


# ------------------------------------------------------------------ keys
def row_range(start: str | None, stop: str | None) -> Column:
    """[start, stop): start inclusive, stop exclusive; empty / None bounds are open."""
    cond = F.lit(True)
    if start:
        cond = cond & (F.col("rowkey") >= F.lit(start))
    if stop:
        cond = cond & (F.col("rowkey") < F.lit(stop))
    return cond


def by_row_range(start: str | None, stop: str | None) -> CellFilter:
    return lambda cells: cells.filter(row_range(start, stop))


def by_row_prefix(prefix: str) -> CellFilter:
    """setRowPrefixFilter; the empty prefix keeps everything."""
    return lambda cells: cells if not prefix else cells.filter(F.col("rowkey").startswith(prefix))


def by_row_value(value: str) -> CellFilter:
    return lambda cells: cells.filter(F.col("rowkey") == F.lit(value))


def find_regex(col: Column, pattern: str) -> Column:
    """Java regex *find* with DOTALL, as the store's regex comparator."""
    return col.rlike("(?s)" + pattern)


def by_row_regex(pattern: str) -> CellFilter:
    return lambda cells: cells.filter(find_regex(F.col("rowkey"), pattern))


# ---------------------------------------------------------- rows by key frame
def rows_in(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` (log or cells) whose ``rowkey`` is in ``keys``, splittable within a hot row (:func:`semi_join_rows`)."""
    return semi_join_rows(df, keys)


# ---------------------------------------------------------- column value
def _rows_where(cells: DataFrame, cell_pred: Column) -> DataFrame:
    return cells.filter(cell_pred).select("rowkey")


def by_single_column_value(family: str, qualifier: str, value: bytes | str | Column, *,
                           exclude_tested: bool = False) -> CellFilter:
    """Whole rows whose ``family:qualifier`` equals ``value``; rows without the column drop.

    ``exclude_tested=True`` is SingleColumnValueExcludeFilter: the tested
    column is removed from the surviving rows.
    """
    def run(cells: DataFrame) -> DataFrame:
        target = value if isinstance(value, Column) else F.lit(value.encode() if isinstance(value, str) else value)
        tested = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        out = rows_in(cells, _rows_where(cells, tested & (F.col("value") == target)))
        return out.filter(~tested) if exclude_tested else out
    return run


def by_single_column_regex(family: str, qualifier: str, pattern: str) -> CellFilter:
    def run(cells: DataFrame) -> DataFrame:
        tested = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        return rows_in(cells, _rows_where(cells, tested & find_regex(_text(), pattern)))
    return run


# ------------------------------------------------------------- cell level
def key_only(cells: DataFrame) -> DataFrame:
    """KeyOnlyFilter: keep coordinates, empty every value."""
    return cells.withColumn("value", F.lit(b"").cast("binary"))


def column_prefix(prefix: str) -> CellFilter:
    return lambda cells: cells.filter(F.col("qualifier").startswith(prefix))


def value_substring(sub: str) -> CellFilter:
    """ValueFilter(SubstringComparator): case-insensitive containment in the value text."""
    return lambda cells: cells.filter(F.lower(_text()).contains(sub.lower()))


def value_matches(sub: str) -> Column:
    return F.lower(_text()).contains(sub.lower())


def filter_all(*filters: CellFilter) -> CellFilter:
    """FilterList(MUST_PASS_ALL): apply every filter in turn."""
    return lambda cells: functools.reduce(lambda acc, f: f(acc), filters, cells)


# --------------------------------------------------------------- row level
SKIP_SALTS = 16


def skip_rows(cell_pred: Column) -> CellFilter:
    """SkipFilter: drop the whole row when any of its cells fails ``cell_pred``.

    One pass: cells go by (row, salt of the column), so a hot row is settled by
    many tasks.  A failing cell is not sent itself; its verdict goes to every
    salt of its row, without the value, and each task drops the cells of a row that a verdict reached.
    """
    def run(cells: DataFrame) -> DataFrame:
        salt = F.pmod(F.xxhash64("family", "qualifier"), F.lit(SKIP_SALTS)).cast("int")
        judged = cells.withColumn("__fails", ~F.coalesce(cell_pred, F.lit(False)))
        verdict = F.transform(F.sequence(F.lit(0), F.lit(SKIP_SALTS - 1)), lambda s: F.struct(s.alias("salt"), F.lit(None).cast("binary").alias("value")))
        itself = F.array(F.struct(salt.alias("salt"), F.col("value").alias("value")))
        sent = judged.select(*[c for c in cells.columns if c != "value"], "__fails",
                             F.inline(F.when(F.col("__fails"), verdict).otherwise(itself)).alias("__salt", "value"))
        hit = F.max("__fails").over(Window.partitionBy("rowkey", "__salt"))
        return sent.withColumn("__hit", hit).filter(~F.col("__hit")).select(*cells.columns)
    return run


def column_count(n: int, *, stop_scan: bool = False) -> CellFilter:
    """ColumnCountGetFilter: first ``n`` cells of each row in (family, qualifier) order.

    ``stop_scan=True`` also ends the scan at the first row having more than
    ``n`` cells (that row keeps its first ``n`` cells): the stop key comes
    from partially aggregated counts, and the rank keeps Spark's group limit.
    """
    def run(cells: DataFrame) -> DataFrame:
        out = cells
        if stop_scan:
            counts = cells.groupBy("rowkey").agg(F.count(F.lit(1)).alias("c"))
            stop = counts.filter(F.col("c") > n).agg(F.min("rowkey").alias("m")).scalar()
            out = out.filter(stop.isNull() | (F.col("rowkey") <= stop))
        w = Window.partitionBy("rowkey").orderBy("family", "qualifier")
        return out.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")
    return run


def while_match(cell_pred: Column, *, by_key: bool = False) -> CellFilter:
    """WhileMatchFilter: rows in key order up to (not including) the first row with a failing cell.

    The stop key is a one-value aggregate used as a scalar subquery; no
    global sort and nothing on the driver.  No failing row keeps all rows.

    Both the subquery and the rows read the same shuffled cells, once resolved: each partition yields its first failing
    cell whole (so that both ask for the same columns), and the rows are cut behind a column that holds their
    partition, which keeps the cut from moving below the shuffle.  ``by_key=True`` states that the predicate reads nothing but
    ``rowkey``; then the subquery is a scan by key, and the cut reaches the scan of the rows instead.
    """
    def run(cells: DataFrame) -> DataFrame:
        fails = ~F.coalesce(cell_pred, F.lit(False))
        if by_key:
            stop = cells.filter(fails).agg(F.min("rowkey").alias("m")).scalar()
            return cells.filter(stop.isNull() | (F.col("rowkey") < stop))
        placed = cells.withColumn("__part", F.spark_partition_id())
        first = placed.groupBy("__part").agg(F.min(F.when(fails, F.struct(*[F.col(c) for c in CELL_ORDERED]))).alias("first"))
        stop = first.agg(F.min("first.rowkey").alias("m")).scalar()
        return placed.filter(stop.isNull() | (F.col("rowkey") < stop)).drop("__part")
    return run


def random_rows(fraction: float, *, seed: int | None = None, deterministic: bool = False) -> CellFilter:
    """RandomRowFilter: keep each *row* with probability ``fraction``.

    The decision is per row key, so a row's cells stay together: a hash of
    the key and the seed (drawn anew for each filter when none is given), or
    -- ``deterministic=True`` -- the first 8 hex digits of md5(rowkey) as a
    number below ``fraction * 16^8``, which is reproducible across engines.
    """
    s = random.randrange(1 << 62) if seed is None else seed

    def run(cells: DataFrame) -> DataFrame:
        if deterministic:
            u = F.conv(F.substring(F.md5(F.col("rowkey")), 1, 8), 16, 10).cast("bigint")
            return cells.filter(u < F.lit(int(fraction * (16 ** 8))))
        u = F.pmod(F.xxhash64(F.col("rowkey"), F.lit(s)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        return cells.filter(u < fraction)
    return run


def first_cell(cells: DataFrame) -> DataFrame:
    """FirstKeyOnlyFilter: the first cell of every row by (family, qualifier)."""
    first = cells.groupBy("rowkey").agg(
        F.min_by(F.struct("family", "qualifier", "ts", "seq", "value"), F.struct("family", "qualifier")).alias("c"))
    return first.select("rowkey", "c.family", "c.qualifier", "c.ts", "c.seq", "c.value")
