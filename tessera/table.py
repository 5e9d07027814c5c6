"""A stored wide-column table: a mutation-log folder plus an optional catalog.

Convenience handle over the operators for code that addresses tables by
location, the way the store's helpers address tables by name.  Reads
resolve the live view of the log; writes append mutation batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.keys import key_parts
from tessera.model import LOG_COLUMNS, LOG_SCHEMA, Catalog
from tessera.operators import mutate as W
from tessera.operators.batch import put_seq, put_ts
from tessera.operators.shape import decode_log
from tessera.sources import catalog as C
from tessera.sources import scan as S


class WideTable:
    """``key_parts``: a table that nothing was written to yet is laid out by key in so many parts; others keep their layout."""

    def __init__(self, spark: SparkSession, path: str, catalog: Catalog | None = None, key_parts: int | None = None):
        self.spark = spark
        self.path = path
        self.catalog = catalog
        self.key_parts = key_parts

    # ------------------------------------------------------------ reads
    def log(self) -> DataFrame:
        """The raw mutation log (empty when nothing was written yet)."""
        if self._exists():
            return self.spark.read.parquet(self.path)
        return self.spark.createDataFrame([], LOG_SCHEMA)

    def cells(self, start: str | None = None, stop: str | None = None, *,
              columns: Sequence[tuple[str, str]] | None = None) -> DataFrame:
        """getRawRDD: live cells of ``[start, stop)``, optionally only some ``(family, qualifier)``."""
        return S.raw_scan(self.log(), start, stop, columns=columns)

    def get(self, keys: DataFrame, *, keep_missing: bool = False) -> DataFrame:
        """bulkGet."""
        return S.bulk_get(self.log(), keys, keep_missing=keep_missing)

    def read(self) -> DataFrame:
        """readFromHBase(catalog): the typed view of the live cells."""
        return C.read_log_table(self._catalog(), self.log())

    def decode(self, columns, *, family: str | None = None, with_key: bool = False) -> DataFrame:
        """getDF / getDFWithK: schema-on-read columns ``[(name, type)]`` with type defaults."""
        return decode_log(self.log(), columns, family=family, with_key=with_key)

    # ----------------------------------------------------------- writes
    def apply(self, batch: DataFrame) -> None:
        """Append any mutation batch (puts or tombstones)."""
        W.append(batch.select(*LOG_COLUMNS), self.path, key_parts=self._parts())

    def write(self, df: DataFrame, *, ts=None) -> None:
        """write2HBase(df, catalog): every catalog column becomes a put."""
        self.apply(C.to_cells(self._catalog(), df, ts=put_ts(ts), seq=put_seq(None)))

    def put_maps(self, df: DataFrame, key: str = "rowkey", map_col: str = "cells", *, ts=None) -> None:
        """putRDD(table, (key, Map["cf:q", value]))."""
        self.apply(W.upsert_cf_map(df, key, map_col, ts=ts))

    def put_columns(self, df: DataFrame, key: str, family: str, *, ts=None) -> None:
        """putRDD with a fixed family: every non-key column becomes family:column."""
        self.apply(W.upsert_family(df, key, family, ts=ts))

    def delete_rows(self, keys: DataFrame, *, ts=None) -> None:
        """deleteRDD(table, rows) / bulkDelete."""
        self.apply(W.delete_rows(keys, ts=ts))

    def delete_columns(self, df: DataFrame, family: str, key: str = "rowkey", cols: str = "columns", *,
                       ts=None) -> None:
        """deleteRDD(table, cf, (key, [column])): all versions of the listed columns."""
        self.apply(W.delete_columns(df, family, key, cols, ts=ts))

    def delete_latest(self, targets: DataFrame) -> None:
        """deleteRecord: remove only the newest live version of each target cell."""
        self.apply(W.delete_latest_version(self.log(), targets))

    def bulk_load(self, cells: DataFrame, staging_path: str, partitions: int) -> None:
        """generateHFile + bulk load: sorted, range-partitioned staging files moved into the log."""
        W.bulk_load(cells, staging_path, partitions, key_parts=self._parts())
        W.load_staged(self.spark, staging_path, self.path)

    # ---------------------------------------------------------- helpers
    def _parts(self) -> int | None:
        return key_parts(self.log().columns) if self._exists() else self.key_parts

    def _catalog(self) -> Catalog:
        if self.catalog is None:
            raise ValueError("this table has no catalog")
        return self.catalog

    def _exists(self) -> bool:
        """Existence on the table's filesystem (the cluster's default FS for paths without a scheme)."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)
