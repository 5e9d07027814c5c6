"""Catalog-mapped tables.

Two physical forms of one logical table:

* ``wide`` Parquet: one typed column per catalog column -- the fast path,
  with native filter pushdown and column pruning;
* the mutation log: decoded with the catalog after version resolution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.predicates import compare_bytes
from tessera.model import LOG_COLUMNS, SPARK_TYPES, Catalog
from tessera.operators.filters import row_range
from tessera.operators.partitioning import partitions_for
from tessera.operators.shape import decode_columns, melt_to_cells
from tessera.operators.skew import join_by_row
from tessera.operators.versions import latest_cells


def read_wide(catalog: Catalog, df: DataFrame) -> DataFrame:
    """Typed frame in catalog column order; each column cast to its catalog type."""
    return df.select(*[F.col(c.name).cast(SPARK_TYPES[c.type]).alias(c.name) for c in catalog.columns])


def read_log(catalog: Catalog, cells: DataFrame) -> DataFrame:
    """Catalog decode of live cells: key column plus one typed column per catalog column.

    Missing cells are NULL (the catalog connector's behaviour), not defaults.
    """
    cols = [(f"{c.family}:{c.qualifier}", c.type) for c in catalog.value_columns]
    decoded = decode_columns(cells, cols, with_key=True, defaults=False)
    renamed = [F.col("ROWKEY").alias(catalog.key_name)] + [
        F.col(f"`{c.family}:{c.qualifier}`").alias(c.name) for c in catalog.value_columns]
    return decoded.select(*renamed).select(*[c.name for c in catalog.columns])


def read_log_table(catalog: Catalog, log: DataFrame) -> DataFrame:
    """Catalog decode straight from a mutation log (resolution and pivot in one plan, see ``decode_log``)."""
    from tessera.operators.shape import decode_log

    cols = [(f"{c.family}:{c.qualifier}", c.type) for c in catalog.value_columns]
    decoded = decode_log(log, cols, with_key=True, defaults=False)
    renamed = [F.col("ROWKEY").alias(catalog.key_name)] + [
        F.col(f"`{c.family}:{c.qualifier}`").alias(c.name) for c in catalog.value_columns]
    return decoded.select(*renamed).select(*[c.name for c in catalog.columns])


def key_condition(ranges: Sequence[tuple[str | None, str | None]] = (), points: Sequence[str] = ()) -> Column:
    """Row keys in any of the ranges ``[start, stop)`` or among the points; without either, all."""
    if not ranges and not points:
        return F.lit(True)
    cond = F.col("rowkey").isin(*points) if points else F.lit(False)
    for start, stop in ranges:
        cond = cond | row_range(start, stop)
    return cond


def filter_log_table(catalog: Catalog, log: DataFrame, where: Sequence[tuple[str, str, object]] = (), *,
                     ranges: Sequence[tuple[str | None, str | None]] = (), points: Sequence[str] = (), **resolve) -> DataFrame:
    """``df.filter`` with a compound predicate over a *log*: key ranges or key points, and column values.

    ``where``: ``(catalog column, comparison, literal)``, all of which must hold (a missing cell holds none).  The key
    condition reaches the scan.  The typed comparisons are rewritten to comparisons of bytes; the tested cells are resolved with
    a one-byte verdict in place of their values, and rows that pass every test are decoded with the catalog.
    """
    keyed = log.filter(key_condition(ranges, points)).select(*LOG_COLUMNS)
    if not where:
        return read_log_table(catalog, keyed)
    specs = {c.name: c for c in catalog.value_columns}
    unknown = [name for name, *_ in where if name not in specs]
    if unknown:
        raise ValueError(f"not value columns of the catalog: {', '.join(unknown)}")
    tests: dict[str, Column] = {}
    for name, operator, literal in where:
        one = compare_bytes(F.col("value"), specs[name].type, operator, literal)
        tests[name] = tests[name] & one if name in tests else one
    passes, tested = F.lit(None).cast("boolean"), F.lit(False)
    for name, test in tests.items():
        here = (F.col("family") == specs[name].family) & (F.col("qualifier") == specs[name].qualifier)
        passes, tested = F.when(here, test).otherwise(passes), tested | here
    judged = keyed.filter(tested | F.col("family").isNull()).withColumn("value", F.when(passes, F.lit(b"\x01")))
    keys = (latest_cells(judged, **resolve).filter(F.col("value").isNotNull())
            .groupBy("rowkey").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(tests)).select("rowkey"))
    return read_log_table(catalog, join_by_row(keyed, keys, "left_semi"))


def to_cells(catalog: Catalog, df: DataFrame, *, ts, seq: Column | int = 0) -> DataFrame:
    """Catalog write to the log: every non-null catalog column becomes a put."""
    return melt_to_cells(df, catalog.key_name, catalog.value_columns, ts=ts, seq=seq)


def write_wide(catalog: Catalog, df: DataFrame, path: str, *, regions: int = 5, mode: str = "overwrite") -> None:
    """write2HBase with ``newTable -> regions``: range-partition by key into at least ``regions`` sorted files.

    Each output file covers one key range and is sorted inside, so Parquet
    row-group statistics prune key-range scans on read.  Large inputs get more
    ranges than ``regions`` (:func:`partitions_for`).
    """
    key = catalog.key_name
    rows = read_wide(catalog, df)
    (rows.repartitionByRange(partitions_for(rows, regions), key).sortWithinPartitions(key)
     .write.mode(mode).parquet(path))


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)
