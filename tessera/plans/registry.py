"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Every query reads the tables of ``sf_dir`` (through :mod:`fixtures`) and
runs over whole tables; results have plain comparable columns (no maps or
bytes), with identical names in the Spark plan and the oracle SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import keys as K
from tessera.functions.codec import decode, encode
from tessera.functions.geohash import geohash
from tessera.model import LOG_SCHEMA
from tessera.operators import filters as FL
from tessera.operators import knn as G
from tessera.operators import mutate as W
from tessera.operators import shape as P
from tessera.operators.versions import latest_cells
from tessera.plans import fixtures as fx
from tessera.plans import oracle_sql as O
from tessera.session import scratch_path
from tessera.sources import bucketed as B
from tessera.sources import catalog as C
from tessera.sources import scan as S
from tessera.sources import sql as Q
from tessera.sources import text as TX

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ----------------------------------------------------------------- views
def orders_view(cells: DataFrame) -> DataFrame:
    return P.typed_view(cells, fx.ORDERS_TYPES)


def customer_view(cells: DataFrame) -> DataFrame:
    return P.typed_view(cells, fx.CUSTOMER_TYPES)


def ek_view(cells: DataFrame) -> DataFrame:
    return P.typed_view(cells, fx.EVENTS_KEYS_TYPES)


def orders_with_tombstones(spark, sf):
    return fx.orders_log(spark, sf).unionByName(fx.orders_tombstones(spark, sf))


def decoded_orders(cells: DataFrame, extra=()) -> DataFrame:
    return P.decode_columns(cells, fx.ORDERS_COLUMNS + list(extra), family="cf", with_key=True)


def decoded_orders_log(log: DataFrame, extra=()) -> DataFrame:
    return P.decode_log(log, fx.ORDERS_COLUMNS + list(extra), family="cf", with_key=True)


CELL_COLS = "rowkey, family, qualifier, ts, s_val, n_val"
DECODED_ORDERS_SQL = (f"{O.OKEY} AS ROWKEY, o_orderstatus AS status, o_orderpriority AS priority, "
                      f"o_custkey AS custkey, o_totalprice AS totalprice")

# ============================================================ V1 latest
@query("latest_cells", _with(O.EVENTS_VERSIONS) +
       "SELECT rowkey, family, qualifier, ts, seq, s_val, n_val FROM evr WHERE rn = 1")
def q_latest_cells(spark, sf):
    live = latest_cells(fx.events_log(spark, sf), version_deletes=False, row_deletes=False)
    return P.typed_view(live, fx.EVENTS_TYPES, extra=("ts", "seq"))


@query("latest_cells_stored", _with(O.ORDERS_CELLS, O.ORDERS_TOMB_CELLS) +
       "SELECT rowkey, family, qualifier, ts, s_val, n_val FROM orders_tcells")
def q_latest_cells_stored(spark, sf):
    """All stages, over a log that lies in the store."""
    return orders_view(latest_cells(fx.stored(orders_with_tombstones(spark, sf), "log-latest")))


@query("latest_cells_bucketed", _with(O.ORDERS_CELLS, O.ORDERS_TOMB_CELLS) +
       "SELECT rowkey, family, qualifier, ts, s_val, n_val FROM orders_tcells")
def q_latest_cells_bucketed(spark, sf):
    """All stages, over a log that a bulk load bucketed by cell: the cells take no exchange."""
    name, path = f"orders_log_{uuid.uuid4().hex[:12]}", scratch_path(spark, "log-bucketed")
    B.bulk_load_bucketed(orders_with_tombstones(spark, sf), name, path, 8)
    live = orders_view(B.latest_cells_bucketed(spark, name, path))
    spark.sql(f"DROP TABLE {name}")  # external: the written files stay
    return live


# ============================================================ S scans
@query("scan_range_stored", _with(O.ORDERS_CELLS, O.ORDERS_TOMB_CELLS) +
       "SELECT rowkey, family, qualifier, ts, s_val, n_val FROM orders_tcells WHERE rowkey >= '0000001000' AND rowkey < '0000002000'")
def q_scan_range_stored(spark, sf):
    return orders_view(S.raw_scan(fx.stored(orders_with_tombstones(spark, sf), "log-range"), "0000001000", "0000002000"))


@query("filter_column_value_stored", _with(O.ORDERS_CELLS, O.ORDERS_TOMB_CELLS) +
       "SELECT rowkey, family, qualifier, ts, s_val, n_val FROM orders_tcells WHERE ok % 10 <> 0 AND "
       "ok IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def q_filter_column_value_stored(spark, sf):
    return orders_view(S.scan_rows_where_column(fx.stored(orders_with_tombstones(spark, sf), "log-filter"), "cf", "status",
                                                F.col("value") == F.lit(b"F")))


@query("scan_range", _with(O.ORDERS_CELLS) +
       f"SELECT {CELL_COLS} FROM orders_cells WHERE rowkey >= '0000001000' AND rowkey < '0000002000'")
def q_scan_range(spark, sf):
    return orders_view(S.raw_scan(fx.orders_log(spark, sf), "0000001000", "0000002000"))


@query("scan_column_default_bounds", _with(O.ORDERS_CELLS) +
       "SELECT rowkey, family, qualifier, s_val FROM orders_cells WHERE qualifier = 'status'")
def q_scan_column_default_bounds(spark, sf):
    cells = S.scan_column(fx.orders_log(spark, sf), "cf", "status")
    return cells.select("rowkey", "family", "qualifier", decode("value", "string").alias("s_val"))


@query("scan_column_typed",
       f"SELECT {O.OKEY} AS rowkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS value "
       f"FROM orders WHERE {O.ALIVE}")
def q_scan_column_typed(spark, sf):
    return S.scan_column_typed(orders_with_tombstones(spark, sf), "cf", "custkey", "long")


@query("scan_column_string",
       f"SELECT {O.OKEY} AS rowkey, CASE WHEN o_orderkey % 21 = 0 THEN '9-REPUT' WHEN o_orderkey % 10 = 0 OR "
       f"o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS value FROM orders WHERE {O.ALIVE}")
def q_scan_column_string(spark, sf):
    return S.scan_column_string(orders_with_tombstones(spark, sf), "cf", "priority")


@query("scan_columns",
       f"SELECT {O.OKEY} AS ROWKEY, o_orderstatus AS status, o_totalprice AS totalprice FROM orders")
def q_scan_columns(spark, sf):
    return S.scan_columns(fx.orders_log(spark, sf), "cf", [("status", "string"), ("totalprice", "double")])


def _row_summary(cells: DataFrame) -> DataFrame:
    """Row mapper with bounded state per row (partial aggregation): cell count, value bytes, last column."""
    return cells.groupBy("rowkey").agg(
        F.count("*").alias("n_cells"),
        F.sum(F.length("value")).cast("bigint").alias("value_bytes"),
        F.max(F.concat_ws(":", "family", "qualifier")).alias("last_column"))


@query("scan_mapped",
       f"SELECT {O.CKEY} AS rowkey, CAST(CASE WHEN c_acctbal < 0 THEN 4 ELSE 3 END AS BIGINT) AS n_cells, "
       f"CAST(strlen(c_name) + strlen(c_mktsegment) + 8 + CASE WHEN c_acctbal < 0 THEN 3 ELSE 0 END AS BIGINT) "
       f"AS value_bytes, 'stats:counter' AS last_column FROM customer")
def q_scan_mapped(spark, sf):
    return S.scan_mapped(fx.customer_log(spark, sf), _row_summary)


@query("scan_mapped_arrow",
       f"SELECT {O.CKEY} AS rowkey, CAST(CASE WHEN c_acctbal < 0 THEN 4 ELSE 3 END AS BIGINT) AS n_cells, "
       f"'stats:counter' AS longest FROM customer")
def q_scan_mapped_arrow(spark, sf):
    def row_summary(batches):
        """Opaque mapper run in Arrow batches: number of cells and the longest qualifier of each row.

        Defined inside the query so it is shipped to the Python workers by value.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            cells = b.column("cells")
            n = pc.subtract(cells.offsets[1:], cells.offsets[:-1])
            # keys of all rows at once; within a row the longest key, then the last, comes last
            keys = cells.keys
            row = pc.cast(pc.list_parent_indices(pa.ListArray.from_arrays(cells.offsets, keys)), pa.int64())
            order = pc.sort_indices(pa.table({"r": row, "n": pc.utf8_length(keys), "k": keys}),
                                    sort_keys=[("r", "ascending"), ("n", "ascending"), ("k", "ascending")])
            last = pc.subtract(cells.offsets[1:], pa.scalar(1, pa.int32()))
            longest = keys.take(order).take(pc.subtract(last, cells.offsets[0]))
            yield pa.RecordBatch.from_arrays(
                [b.column("rowkey"), pc.cast(n, pa.int64()), pa.array(longest, pa.string())],
                names=["rowkey", "n_cells", "longest"])

    return S.scan_mapped(fx.customer_log(spark, sf), lambda cells: P.map_rows_arrow(
        cells, row_summary, "rowkey string, n_cells bigint, longest string"))


@query("scan_keys", f"SELECT {O.OKEY} AS rowkey FROM orders WHERE {O.ALIVE}")
def q_scan_keys(spark, sf):
    return S.scan_keys(orders_with_tombstones(spark, sf))


@query("scan_count", f"SELECT count(*) AS n_rows FROM orders WHERE {O.ALIVE}")
def q_scan_count(spark, sf):
    return S.scan_count(orders_with_tombstones(spark, sf))


FORMAT_LINE_SQL = (f"{O.CKEY} || ':' || CASE WHEN c_acctbal < 0 THEN '(flag,neg)' ELSE '' END || '(name,' || c_name "
                   f"|| ')(segment,' || c_mktsegment || ')(counter,' || CAST(c_nationkey AS VARCHAR) || ')'")


@query("scan_formatted", f"SELECT {O.CKEY} AS rowkey, {FORMAT_LINE_SQL} AS line FROM customer")
def q_scan_formatted(spark, sf):
    return S.scan_mapped(fx.customer_log(spark, sf), P.format_rows)


def _probe_keys(spark, sf) -> DataFrame:
    """Keys to look up: every 97th order (present) and shifted keys that do not exist."""
    o = fx.table(spark, sf, "orders")
    present = o.filter(F.col("o_orderkey") % 97 == 0).select(fx.order_key("o_orderkey").alias("rowkey"))
    absent = o.filter(F.col("o_orderkey") % 997 == 0).select(
        fx.padded(F.col("o_orderkey") + 1000000000, 10).alias("rowkey"))
    return present.unionByName(absent)


@query("bulk_get", _with(O.ORDERS_CELLS) + f"SELECT {CELL_COLS} FROM orders_cells WHERE ok % 97 = 0")
def q_bulk_get(spark, sf):
    return orders_view(S.bulk_get(fx.orders_log(spark, sf), _probe_keys(spark, sf)))


@query("bulk_get_keep_missing", _with(O.ORDERS_CELLS) +
       f"SELECT {CELL_COLS} FROM orders_cells WHERE ok % 97 = 0 UNION ALL "
       f"SELECT lpad(CAST(o_orderkey + 1000000000 AS VARCHAR), 10, '0'), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), "
       f"CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE) FROM orders WHERE o_orderkey % 997 = 0")
def q_bulk_get_keep_missing(spark, sf):
    return orders_view(S.bulk_get(fx.orders_log(spark, sf), _probe_keys(spark, sf), keep_missing=True))


@query("get_value",
       f"SELECT {O.OKEY} AS rowkey, o_orderstatus AS value FROM orders WHERE o_orderkey % 97 = 0 "
       f"UNION ALL SELECT lpad(CAST(o_orderkey + 1000000000 AS VARCHAR), 10, '0'), CAST(NULL AS VARCHAR) "
       f"FROM orders WHERE o_orderkey % 997 = 0")
def q_get_value(spark, sf):
    return S.get_value(fx.orders_log(spark, sf), _probe_keys(spark, sf), "cf", "status")


KEY_PARTS = 64


def _few_keys(spark, sf) -> DataFrame:
    """The keys of the orders of one customer in a hundred, of one priority, and a key that does not exist."""
    o = fx.table(spark, sf, "orders").filter((F.col("o_custkey") % 100 == 7) & (F.col("o_orderpriority") == "1-URGENT"))
    keys = o.select(F.explode(F.array(F.col("o_orderkey"), F.col("o_orderkey") + 1000000000)).alias("k"))
    return keys.select(fx.order_key("k").alias("rowkey"))


FEW = "o_custkey % 100 = 7 AND o_orderpriority = '1-URGENT'"


@query("bulk_get_stored", _with(O.ORDERS_CELLS, O.ORDERS_TOMB_CELLS) +
       f"SELECT {CELL_COLS} FROM orders_tcells WHERE ok IN (SELECT o_orderkey FROM orders WHERE {FEW})")
def q_bulk_get_stored(spark, sf):
    """Few keys of a log laid out by key: only their parts are read."""
    log = fx.stored_by_key(orders_with_tombstones(spark, sf), "log-keyed", KEY_PARTS)
    return orders_view(S.bulk_get(log, _few_keys(spark, sf)))


@query("get_value_stored",
       f"SELECT {O.OKEY} AS rowkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS value FROM orders WHERE {FEW} "
       f"UNION ALL SELECT lpad(CAST(o_orderkey + 1000000000 AS VARCHAR), 10, '0'), NULL FROM orders WHERE {FEW}")
def q_get_value_stored(spark, sf):
    log = fx.stored_by_key(orders_with_tombstones(spark, sf), "log-keyed", KEY_PARTS)
    return S.get_value(log, _few_keys(spark, sf), "cf", "custkey", "long")


@query("scan_row_stored", _with(O.ORDERS_CELLS, O.ORDERS_TOMB_CELLS) +
       f"SELECT {CELL_COLS} FROM orders_tcells WHERE rowkey = '0000000021'")
def q_scan_row_stored(spark, sf):
    """One row of a log laid out by key: one part is read."""
    log = fx.stored_by_key(orders_with_tombstones(spark, sf), "log-keyed", KEY_PARTS)
    return orders_view(S.scan_row(log, "0000000021"))


@query("scan_record",
       f"SELECT {O.OKEY} AS rowkey, CASE WHEN o_orderkey % 21 = 0 THEN '9-REPUT' ELSE o_orderpriority END AS value "
       f"FROM orders WHERE (o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0) OR o_orderkey % 21 = 0")
def q_scan_record(spark, sf):
    return S.scan_record(orders_with_tombstones(spark, sf), "cf", "priority")


@query("prefix_first_row", _with(O.EVENTS_KEYS_CELLS) +
       f"SELECT {CELL_COLS} FROM ek_cells WHERE rowkey = "
       f"(SELECT min(rowkey) FROM ek_cells WHERE starts_with(rowkey, '12_'))")
def q_prefix_first_row(spark, sf):
    return ek_view(S.prefix_first_row(fx.events_keys_log(spark, sf), "12_", "cf"))


def _text_puts(spark, sf):
    path = scratch_path(spark, "text-puts")
    fx.text_put_lines(spark, sf).write.mode("overwrite").text(path)
    return TX.load_text_puts(spark, path, "cf")


@query("load_text_puts",
       "SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS rowkey, 'cf' AS family, 'name' AS qualifier, "
       "p_name AS value FROM part UNION ALL SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0'), 'cf', 'brand', p_brand "
       "FROM part WHERE p_partkey % 5 <> 0")
def q_load_text_puts(spark, sf):
    puts, _ = _text_puts(spark, sf)
    live = latest_cells(puts, version_deletes=False, row_deletes=False)
    return live.select("rowkey", "family", "qualifier", decode("value", "string").alias("value"))


@query("load_text_rejects",
       "SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') || ',brand' AS line FROM part WHERE p_partkey % 5 = 0")
def q_load_text_rejects(spark, sf):
    _, rejects = _text_puts(spark, sf)
    return rejects


@query("load_text_last_line",
       "SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS rowkey, 'cf' AS family, 'name' AS qualifier, "
       "CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN p_brand ELSE p_type END AS value FROM part")
def q_load_text_last_line(spark, sf):
    """Lines of one load that name the same cell: the last one in the file wins."""
    p = fx.table(spark, sf, "part")
    texts = F.when(F.col("p_partkey") % 3 == 0, F.array("p_type", "p_brand", "p_name")).when(
        F.col("p_partkey") % 3 == 1, F.array("p_type", "p_brand")).otherwise(F.array("p_name", "p_brand", "p_type"))
    lines = p.select(fx.padded("p_partkey", 6).alias("k"), F.explode(texts).alias("t")).select(F.concat_ws(",", "k", F.lit("name"), "t"))
    path = scratch_path(spark, "text-lines")
    lines.write.text(path)
    puts, _ = TX.load_text_puts(spark, path, "cf")
    live = latest_cells(puts, version_deletes=False, row_deletes=False)
    return live.select("rowkey", "family", "qualifier", decode("value", "string").alias("value"))


CATALOG_SQL = (f"SELECT {O.OKEY} AS pk, o_orderstatus AS status, o_orderpriority AS priority, o_custkey AS custkey, "
               f"o_totalprice AS totalprice FROM orders")


@query("catalog_read", CATALOG_SQL)
def q_catalog_read(spark, sf):
    return C.read_wide(fx.ORDERS_CATALOG, fx.orders_wide(spark, sf))


@query("catalog_read_log",
       f"SELECT {O.OKEY} AS pk, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS status, "
       f"CASE WHEN o_orderkey % 21 = 0 THEN '9-REPUT' WHEN o_orderkey % 10 = 0 OR o_orderkey % 7 = 0 THEN NULL "
       f"ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS custkey, "
       f"CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS totalprice FROM orders WHERE {O.ALIVE}")
def q_catalog_read_log(spark, sf):
    return C.read_log_table(fx.ORDERS_CATALOG, orders_with_tombstones(spark, sf))


@query("sql_query",
       f"SELECT pk, status, totalprice FROM ({CATALOG_SQL}) t WHERE priority = '1-URGENT' "
       f"ORDER BY totalprice DESC, pk LIMIT 10")
def q_sql_query(spark, sf):
    name = f"orders_catalog_{uuid.uuid4().hex[:12]}"
    Q.register(C.read_wide(fx.ORDERS_CATALOG, fx.orders_wide(spark, sf)), name)
    out = Q.exec_query(spark, f"SELECT pk, status, totalprice FROM {name} WHERE priority = '1-URGENT' "
                              "ORDER BY totalprice DESC, pk LIMIT 10")
    spark.catalog.dropTempView(name)
    return out


# ============================================================ F filters
@query("filter_row_range", _with(O.ORDERS_CELLS) +
       f"SELECT {CELL_COLS} FROM orders_cells WHERE rowkey >= '0000002000' AND rowkey < '0000002500'")
def q_filter_row_range(spark, sf):
    return orders_view(FL.by_row_range("0000002000", "0000002500")(latest_cells(fx.orders_log(spark, sf))))


@query("filter_row_prefix", _with(O.EVENTS_KEYS_CELLS) +
       f"SELECT {CELL_COLS} FROM ek_cells WHERE starts_with(rowkey, '12_')")
def q_filter_row_prefix(spark, sf):
    return ek_view(FL.by_row_prefix("12_")(latest_cells(fx.events_keys_log(spark, sf))))


@query("filter_row_value", _with(O.ORDERS_CELLS) + f"SELECT {CELL_COLS} FROM orders_cells WHERE rowkey = '0000004242'")
def q_filter_row_value(spark, sf):
    return orders_view(FL.by_row_value("0000004242")(latest_cells(fx.orders_log(spark, sf))))


@query("filter_row_regex", _with(O.EVENTS_KEYS_CELLS) +
       f"SELECT {CELL_COLS} FROM ek_cells WHERE regexp_matches(rowkey, '.2024-01-03.', 's')")
def q_filter_row_regex(spark, sf):
    return ek_view(FL.by_row_regex(".2024-01-03.")(latest_cells(fx.events_keys_log(spark, sf))))


@query("filter_column_value", _with(O.ORDERS_CELLS) +
       f"SELECT {CELL_COLS} FROM orders_cells WHERE ok IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def q_filter_column_value(spark, sf):
    return orders_view(S.scan_rows_where_column(fx.orders_log(spark, sf), "cf", "status",
                                                F.col("value") == F.lit(b"F")))


@query("filter_column_regex", _with(O.ORDERS_CELLS) +
       f"SELECT {CELL_COLS} FROM orders_cells WHERE ok IN "
       f"(SELECT o_orderkey FROM orders WHERE regexp_matches(o_orderpriority, '.IG.', 's'))")
def q_filter_column_regex(spark, sf):
    return orders_view(S.scan_rows_where_column(fx.orders_log(spark, sf), "cf", "priority",
                                                FL.find_regex(decode("value", "string"), ".IG.")))


@query("filter_key_only", _with(O.ORDERS_CELLS) +
       "SELECT rowkey, family, qualifier, ts, CAST(0 AS INTEGER) AS nbytes FROM orders_cells")
def q_filter_key_only(spark, sf):
    cells = S.scan_key_only(fx.orders_log(spark, sf))
    return cells.select("rowkey", "family", "qualifier", "ts", F.length("value").alias("nbytes"))


@query("filter_all", _with(O.CUSTOMER_CELLS) +
       f"SELECT {CELL_COLS} FROM customer_cells WHERE starts_with(rowkey, '0001') AND starts_with(qualifier, 'se') "
       f"AND contains(lower(s_val), 'mach')")
def q_filter_all(spark, sf):
    f = FL.filter_all(FL.by_row_prefix("0001"), FL.column_prefix("se"), FL.value_substring("MACH"))
    return customer_view(f(latest_cells(fx.customer_log(spark, sf))))


@query("filter_column_prefix", _with(O.CUSTOMER_CELLS) +
       f"SELECT {CELL_COLS} FROM customer_cells WHERE starts_with(qualifier, 'se')")
def q_filter_column_prefix(spark, sf):
    return customer_view(FL.column_prefix("se")(latest_cells(fx.customer_log(spark, sf))))


@query("filter_value_substring", _with(O.CUSTOMER_CELLS) +
       f"SELECT {CELL_COLS} FROM customer_cells WHERE contains(lower(s_val), 'mach')")
def q_filter_value_substring(spark, sf):
    return customer_view(FL.value_substring("mach")(latest_cells(fx.customer_log(spark, sf))))


@query("filter_skip", _with(O.CUSTOMER_CELLS) +
       f"SELECT {CELL_COLS} FROM customer_cells WHERE c_mktsegment <> 'MACHINERY'")
def q_filter_skip(spark, sf):
    return customer_view(FL.skip_rows(~FL.value_matches("mach"))(latest_cells(fx.customer_log(spark, sf))))


@query("filter_column_count", _with(O.CUSTOMER_CELLS) +
       f"SELECT {CELL_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY family, qualifier) AS rn "
       f"FROM customer_cells) t WHERE rn <= 2")
def q_filter_column_count(spark, sf):
    return customer_view(FL.column_count(2)(latest_cells(fx.customer_log(spark, sf))))


@query("filter_column_count_stop", _with(O.CUSTOMER_CELLS) +
       f"SELECT {CELL_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY family, qualifier) AS rn "
       f"FROM customer_cells) t WHERE rn <= 3 AND rowkey <= (SELECT min({O.CKEY}) FROM customer WHERE c_acctbal < 0)")
def q_filter_column_count_stop(spark, sf):
    return customer_view(FL.column_count(3, stop_scan=True)(latest_cells(fx.customer_log(spark, sf))))


@query("filter_while_match", _with(O.CUSTOMER_CELLS) + f"SELECT {CELL_COLS} FROM customer_cells WHERE rowkey < '000700'")
def q_filter_while_match(spark, sf):
    return customer_view(FL.while_match(F.col("rowkey") != "000700", by_key=True)(latest_cells(fx.customer_log(spark, sf))))


@query("filter_while_match_value", _with(O.CUSTOMER_CELLS) + f"SELECT {CELL_COLS} FROM customer_cells WHERE rowkey < "
       f"(SELECT min({O.CKEY}) FROM customer WHERE c_mktsegment = 'MACHINERY')")
def q_filter_while_match_value(spark, sf):
    """The scan ends before the first row with a failing cell value."""
    return customer_view(FL.while_match(~FL.value_matches("machinery"))(latest_cells(fx.customer_log(spark, sf))))


@query("filter_random_rows_all", _with(O.CUSTOMER_CELLS) + f"SELECT {CELL_COLS} FROM customer_cells")
def q_filter_random_rows_all(spark, sf):
    """Fraction 1 keeps every row, by either kind of decision."""
    live = FL.random_rows(1.0, deterministic=True)(latest_cells(fx.customer_log(spark, sf)))
    return customer_view(FL.random_rows(1.0)(live))


@query("filter_random_rows", _with(O.CUSTOMER_CELLS) +
       f"SELECT {CELL_COLS} FROM customer_cells WHERE substring(md5(rowkey), 1, 8) < 'cccccccc'")
def q_filter_random_rows(spark, sf):
    return customer_view(FL.random_rows(0.8, deterministic=True)(latest_cells(fx.customer_log(spark, sf))))


@query("filter_first_cell", _with(O.CUSTOMER_CELLS) +
       f"SELECT {CELL_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY family, qualifier) AS rn "
       f"FROM customer_cells) t WHERE rn = 1")
def q_filter_first_cell(spark, sf):
    return customer_view(FL.first_cell(latest_cells(fx.customer_log(spark, sf))))


@query("filter_column_value_exclude", _with(O.ORDERS_CELLS) +
       f"SELECT {CELL_COLS} FROM orders_cells WHERE qualifier <> 'status' AND "
       f"ok IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def q_filter_column_value_exclude(spark, sf):
    return orders_view(S.scan_rows_where_column(fx.orders_log(spark, sf), "cf", "status",
                                                F.col("value") == F.lit(b"F"), exclude_tested=True))


@query("filter_compound",
       f"SELECT * FROM ({CATALOG_SQL}) t WHERE ((pk >= '0000000100' AND pk < '0000000200') OR pk IN "
       f"('0000005000', '0000007777')) AND status = 'O' AND totalprice > 100000.0")
def q_filter_compound(spark, sf):
    df = C.read_wide(fx.ORDERS_CATALOG, fx.orders_wide(spark, sf))
    pk = F.col("pk")
    return df.filter((((pk >= "0000000100") & (pk < "0000000200")) | pk.isin("0000005000", "0000007777"))
                     & (F.col("status") == "O") & (F.col("totalprice") > 100000.0))


@query("filter_compound_log",
       f"SELECT * FROM ({CATALOG_SQL}) t WHERE ((pk >= '0000000100' AND pk < '0000000200') OR pk IN "
       f"('0000005000', '0000007777')) AND status = 'O' AND totalprice > 100000.0")
def q_filter_compound_log(spark, sf):
    """The same predicate over the log: keys reach the scan, values are compared as bytes."""
    return C.filter_log_table(fx.ORDERS_CATALOG, fx.orders_log(spark, sf), [("status", "=", "O"), ("totalprice", ">", 100000.0)],
                              ranges=[("0000000100", "0000000200")], points=["0000005000", "0000007777"])


@query("filter_compound_log_wide",
       f"SELECT * FROM (SELECT {O.OKEY} AS pk, o_orderstatus AS status, CASE WHEN o_orderkey % 21 = 0 THEN '9-REPUT' "
       f"WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS priority, o_custkey AS custkey, o_totalprice AS totalprice "
       f"FROM orders WHERE o_orderkey % 10 <> 0) t WHERE priority >= '5' AND custkey <= 700 AND totalprice < 150000.0")
def q_filter_compound_log_wide(spark, sf):
    """Three columns over a whole log with tombstones."""
    return C.filter_log_table(fx.ORDERS_CATALOG, orders_with_tombstones(spark, sf),
                              [("priority", ">=", "5"), ("custkey", "<=", 700), ("totalprice", "<", 150000.0)])


# ============================================================ P shaping
CUST_MAP_SQL = (f"'counter=' || lpad(hex(CAST(c_nationkey AS BIGINT)), 16, '0') || ';' || "
                f"CASE WHEN c_acctbal < 0 THEN 'flag=' || hex('neg') || ';' ELSE '' END || "
                f"'name=' || hex(c_name) || ';segment=' || hex(c_mktsegment)")
CUST_CF_MAP_SQL = (f"CASE WHEN c_acctbal < 0 THEN 'cf:flag=' || hex('neg') || ';' ELSE '' END || "
                   f"'cf:name=' || hex(c_name) || ';cf:segment=' || hex(c_mktsegment) || "
                   f"';stats:counter=' || lpad(hex(CAST(c_nationkey AS BIGINT)), 16, '0')")


@query("rows_to_map", f"SELECT {O.CKEY} AS rowkey, {CUST_MAP_SQL} AS entries FROM customer")
def q_rows_to_map(spark, sf):
    m = P.rows_to_map(latest_cells(fx.customer_log(spark, sf)))
    return m.select("rowkey", P.render_map(F.col("cells")).alias("entries"))


@query("rows_to_str_map",
       f"SELECT {O.CKEY} AS rowkey, CASE WHEN c_acctbal < 0 THEN 'flag=neg;' ELSE '' END || 'name=' || c_name || "
       f"'!;segment=' || c_mktsegment AS entries FROM customer")
def q_rows_to_str_map(spark, sf):
    """All text cells of a row; ``name`` stands in two families, of which the higher one wins."""
    log = fx.customer_log(spark, sf).where("family = 'cf'")
    twin = log.where("qualifier = 'name'").withColumn("family", F.lit("stats")).withColumn("value", F.concat("value", F.lit(b"!")))
    m = P.rows_to_map(latest_cells(log.unionByName(twin)), as_string=True)
    return m.select("rowkey", P.render_map(F.col("cells"), value_render=lambda v: v).alias("entries"))


@query("rows_to_cf_map", f"SELECT {O.CKEY} AS rowkey, {CUST_CF_MAP_SQL} AS entries FROM customer")
def q_rows_to_cf_map(spark, sf):
    m = P.rows_to_cf_map(latest_cells(fx.customer_log(spark, sf)))
    return m.select("rowkey", P.render_map(F.col("cells")).alias("entries"))


@query("single_column_and_key",
       f"SELECT CASE WHEN c_acctbal < 0 THEN 'neg' ELSE c_name END AS value, {O.CKEY} AS rowkey FROM customer")
def q_single_column_and_key(spark, sf):
    """The first of all cells by (family, qualifier): ``flag`` where there is one, else ``name``."""
    live = latest_cells(fx.customer_log(spark, sf))
    return P.single_column_and_key(S.scan_keys(fx.customer_log(spark, sf)), live)


@query("decode_missing_columns",
       f"SELECT {O.CKEY} AS ROWKEY, CASE WHEN c_acctbal < 0 THEN 'neg' ELSE '' END AS flag FROM customer")
def q_decode_missing_columns(spark, sf):
    """A row without any requested column is a row of defaults."""
    return P.decode_columns(latest_cells(fx.customer_log(spark, sf)), [("flag", "string")], family="cf", with_key=True)


@query("decode_map_columns",
       f"SELECT {O.CKEY} AS ROWKEY, CASE WHEN c_acctbal < 0 THEN 'neg' ELSE '' END AS flag, "
       f"CAST(c_nationkey AS BIGINT) AS counter FROM customer")
def q_decode_map_columns(spark, sf):
    """Columns by qualifier alone, from (rowkey, map) rows."""
    rows = P.rows_to_map(latest_cells(fx.customer_log(spark, sf)))
    return P.decode_map(rows, [("flag", "string"), ("counter", "long")], with_key=True)


DECODE_TYPED_SQL = (
    "CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE o_orderstatus END AS status, "
    "CASE WHEN o_orderkey % 21 = 0 THEN '9-REPUT' WHEN o_orderkey % 10 = 0 OR o_orderkey % 7 = 0 THEN '' "
    "ELSE o_orderpriority END AS priority, "
    "CASE WHEN o_orderkey % 10 = 0 THEN CAST(0 AS BIGINT) ELSE o_custkey END AS custkey, "
    "CASE WHEN o_orderkey % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS totalprice "
    f"FROM orders WHERE {O.ALIVE}")


@query("decode_typed", "SELECT " + DECODE_TYPED_SQL)
def q_decode_typed(spark, sf):
    return P.decode_log(orders_with_tombstones(spark, sf), fx.ORDERS_COLUMNS, family="cf")


@query("decode_typed_stored", "SELECT " + DECODE_TYPED_SQL)
def q_decode_typed_stored(spark, sf):
    return P.decode_log(fx.stored(orders_with_tombstones(spark, sf), "log-decode"), fx.ORDERS_COLUMNS, family="cf")


@query("decode_typed_with_key", f"SELECT {O.OKEY} AS ROWKEY, " + DECODE_TYPED_SQL)
def q_decode_typed_with_key(spark, sf):
    return P.decode_log(orders_with_tombstones(spark, sf), fx.ORDERS_COLUMNS, family="cf", with_key=True)


@query("encode_family", f"SELECT {DECODED_ORDERS_SQL} FROM orders")
def q_encode_family(spark, sf):
    cells = P.encode_family(fx.orders_wide(spark, sf), "pk", "cf", ts=1)
    return decoded_orders(latest_cells(cells, version_deletes=False, row_deletes=False))


@query("encode_cf", f"SELECT {DECODED_ORDERS_SQL} FROM orders")
def q_encode_cf(spark, sf):
    w = fx.orders_wide(spark, sf).select(
        "pk", F.col("status").alias("cf:status"), F.col("priority").alias("cf:priority"),
        F.col("custkey").alias("meta:custkey"), F.col("totalprice").alias("meta:totalprice"))
    cells = P.encode_cf(w, "pk", ts=1)
    live = latest_cells(cells, version_deletes=False, row_deletes=False)
    d = P.decode_columns(live, [("cf:status", "string"), ("cf:priority", "string"), ("meta:custkey", "long"),
                                ("meta:totalprice", "double")], with_key=True)
    return d.select("ROWKEY", F.col("`cf:status`").alias("status"), F.col("`cf:priority`").alias("priority"),
                    F.col("`meta:custkey`").alias("custkey"), F.col("`meta:totalprice`").alias("totalprice"))


@query("format_rows", f"SELECT {O.CKEY} AS rowkey, {FORMAT_LINE_SQL} AS line FROM customer")
def q_format_rows(spark, sf):
    return P.format_rows(latest_cells(fx.customer_log(spark, sf)))


@query("catalog_select", f"SELECT pk, status, totalprice FROM ({CATALOG_SQL}) t")
def q_catalog_select(spark, sf):
    return C.select_columns(C.read_wide(fx.ORDERS_CATALOG, fx.orders_wide(spark, sf)), "pk", "status", "totalprice")


@query("salted_keys", _with(O.USERS) + "SELECT uid, concat(substring(md5(uid), 1, 3), uid) AS rowkey FROM users")
def q_salted_keys(spark, sf):
    return fx.users(spark, sf).select("uid", K.salted_key("uid").alias("rowkey"))


@query("generated_keys", "SELECT count(*) AS n, count(*) AS n_distinct FROM customer")
def q_generated_keys(spark, sf):
    k = fx.users(spark, sf).select(K.unique_key().alias("rowkey"))
    return k.agg(F.count("*").alias("n"), F.count_distinct("rowkey").alias("n_distinct"))


@query("generated_keys_ordered",
       "SELECT event_id, strftime(ts, '%Y%m%d%H%M%S%g') || '_' || md5(" + " || ".join(
           f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
           for c in ("event_id", "user_id", "event_type")) + ") AS rowkey FROM events")
def q_generated_keys_ordered(spark, sf):
    """Reproducible time-ordered keys for key-less rows (events)."""
    e = fx.table(spark, sf, "events")
    return e.select("event_id", K.time_ordered_key("ts", "event_id", "user_id", "event_type").alias("rowkey"))


# ============================================================ W writes
@query("upsert_cf_map",
       f"SELECT {O.OKEY} AS ROWKEY, CASE WHEN o_orderkey % 13 = 0 THEN 'U' ELSE o_orderstatus END AS status, "
       f"o_orderpriority AS priority, o_custkey AS custkey, o_totalprice AS totalprice, "
       f"CASE WHEN o_orderkey % 13 = 0 THEN 'n' || o_orderstatus ELSE '' END AS note FROM orders")
def q_upsert_cf_map(spark, sf):
    o = fx.table(spark, sf, "orders").filter(F.col("o_orderkey") % 13 == 0)
    batch = o.select(fx.order_key("o_orderkey").alias("rowkey"),
                     F.create_map(F.lit("cf:status"), F.lit("U"), F.lit("cf:note"),
                                  F.concat(F.lit("n"), F.col("o_orderstatus"))).alias("cells"))
    return decoded_orders_log(W.with_batches(fx.orders_log(spark, sf), W.upsert_cf_map(batch)),
                              extra=[("note", "string")])


def _user_cells(users: DataFrame) -> DataFrame:
    """User mapper: a UserData row -> its four cells under a salted key."""
    cells = F.array(*[F.struct(F.lit("cf").alias("family"), F.lit(n).alias("qualifier"), encode(n, t).alias("value"))
                      for n, t in fx.USER_COLUMNS])
    return users.select(K.salted_key("uid").alias("rowkey"), F.inline(cells))


USERS_DECODED_SQL = (_with(O.USERS) + "SELECT concat(substring(md5(uid), 1, 3), uid) AS ROWKEY, uid, sex, age, "
                     "created_time FROM users")


@query("upsert_mapped", USERS_DECODED_SQL)
def q_upsert_mapped(spark, sf):
    batch = W.upsert_mapped(fx.users(spark, sf), _user_cells, ts=1)
    live = W.apply_batch(spark.createDataFrame([], LOG_SCHEMA), batch)
    return P.decode_columns(live, fx.USER_COLUMNS, family="cf", with_key=True)


@query("bulk_put",
       f"SELECT {O.OKEY} AS ROWKEY, CASE WHEN o_orderkey % 11 = 0 THEN 'B' ELSE o_orderstatus END AS status, "
       f"o_orderpriority AS priority, o_custkey AS custkey, o_totalprice AS totalprice, "
       f"CASE WHEN o_orderkey % 11 = 0 THEN lower(o_orderpriority) ELSE '' END AS extra FROM orders")
def q_bulk_put(spark, sf):
    o = fx.table(spark, sf, "orders").filter(F.col("o_orderkey") % 11 == 0)
    batch = o.select(fx.order_key("o_orderkey").alias("rowkey"), F.array(
        F.struct(F.lit("cf").alias("family"), F.lit("status").alias("qualifier"), F.lit("B").alias("value")),
        F.struct(F.lit("cf").alias("family"), F.lit("extra").alias("qualifier"),
                 F.lower("o_orderpriority").alias("value"))).alias("cells"))
    return decoded_orders_log(W.with_batches(fx.orders_log(spark, sf), W.bulk_put(batch)),
                              extra=[("extra", "string")])


@query("bulk_put_timestamp",
       f"SELECT {O.OKEY} AS ROWKEY, CASE WHEN o_orderkey % 17 = 0 THEN 'NEW' ELSE o_orderstatus END AS status, "
       f"o_orderpriority AS priority, o_custkey AS custkey, o_totalprice AS totalprice FROM orders")
def q_bulk_put_timestamp(spark, sf):
    o = fx.table(spark, sf, "orders")

    def batch(mod, text):
        return o.filter(F.col("o_orderkey") % mod == 0).select(
            fx.order_key("o_orderkey").alias("rowkey"),
            F.array(F.struct(F.lit("cf").alias("family"), F.lit("status").alias("qualifier"),
                             F.lit(text).alias("value"))).alias("cells"))
    older = W.bulk_put_with_timestamp(batch(11, "OLD"), 0, seq=1)   # older than the table: must not win
    newer = W.bulk_put_with_timestamp(batch(17, "NEW"), 5, seq=2)
    return decoded_orders_log(W.with_batches(fx.orders_log(spark, sf), older, newer))


@query("bulk_put_same_ts",
       f"SELECT {O.OKEY} AS ROWKEY, CASE WHEN o_orderkey % 11 = 0 THEN 'second' ELSE o_orderstatus END AS status, "
       f"o_orderpriority AS priority, o_custkey AS custkey, o_totalprice AS totalprice FROM orders")
def q_bulk_put_same_ts(spark, sf):
    """Two batches at one ts: the later batch wins."""
    o = fx.table(spark, sf, "orders").filter(F.col("o_orderkey") % 11 == 0)

    def batch(text):
        return W.bulk_put_with_timestamp(o.select(
            fx.order_key("o_orderkey").alias("rowkey"),
            F.array(F.struct(F.lit("cf").alias("family"), F.lit("status").alias("qualifier"),
                             F.lit(text).alias("value"))).alias("cells")), 5)
    return decoded_orders_log(W.with_batches(fx.orders_log(spark, sf), batch("first"), batch("second")))


@query("catalog_write", CATALOG_SQL)
def q_catalog_write(spark, sf):
    path = scratch_path(spark, "catalog-write")
    C.write_wide(fx.ORDERS_CATALOG, fx.orders_wide(spark, sf), path, regions=5)
    return C.read_wide(fx.ORDERS_CATALOG, spark.read.parquet(path))


def bulk_load_sorted(users: DataFrame, path: str, partitions: int) -> None:
    """Users -> salted-key cells under their own names -> sorted, range-partitioned files."""
    W.bulk_load(W.upsert_mapped(users, _user_cells, ts=1), path, partitions)


@query("bulk_load_sorted", _with(O.USERS) +
       "SELECT concat(substring(md5(uid), 1, 3), uid) AS rowkey, 'cf' AS family, q AS qualifier, v AS value FROM "
       "(SELECT uid, 'uid' AS q, uid AS v FROM users UNION ALL SELECT uid, 'sex', sex FROM users UNION ALL "
       "SELECT uid, 'age', CAST(age AS VARCHAR) FROM users UNION ALL SELECT uid, 'created_time', created_time FROM users) t")
def q_bulk_load_sorted(spark, sf):
    path = scratch_path(spark, "bulk-load")
    bulk_load_sorted(fx.users(spark, sf), path, partitions=max(1, spark.sparkContext.defaultParallelism))
    cells = spark.read.parquet(path)
    text = F.when(F.col("qualifier") == "age", decode("value", "int").cast("string")).otherwise(decode("value", "string"))
    return cells.select("rowkey", "family", "qualifier", text.alias("value"))


@query("bulk_load_staged", USERS_DECODED_SQL)
def q_bulk_load_staged(spark, sf):
    stage = scratch_path(spark, "bulk-stage")
    table_path = scratch_path(spark, "bulk-table")
    bulk_load_sorted(fx.users(spark, sf), stage, partitions=max(1, spark.sparkContext.defaultParallelism))
    W.load_staged(spark, stage, table_path)
    live = latest_cells(spark.read.parquet(table_path))
    return P.decode_columns(live, fx.USER_COLUMNS, family="cf", with_key=True)


@query("delete_rows", f"SELECT {DECODED_ORDERS_SQL} FROM orders WHERE o_orderkey % 10 <> 0")
def q_delete_rows(spark, sf):
    keys = fx.table(spark, sf, "orders").filter(F.col("o_orderkey") % 10 == 0).select(
        fx.order_key("o_orderkey").alias("rowkey"))
    return decoded_orders_log(W.with_batches(fx.orders_log(spark, sf), W.delete_rows(keys, ts=2)))


@query("delete_columns",
       f"SELECT {O.OKEY} AS ROWKEY, o_orderstatus AS status, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority "
       f"END AS priority, o_custkey AS custkey, o_totalprice AS totalprice FROM orders")
def q_delete_columns(spark, sf):
    data = fx.table(spark, sf, "orders").filter(F.col("o_orderkey") % 7 == 0).select(
        fx.order_key("o_orderkey").alias("rowkey"), F.array(F.lit("priority")).alias("columns"))
    return decoded_orders_log(W.with_batches(fx.orders_log(spark, sf), W.delete_columns(data, "cf", ts=2)))


@query("delete_mapped",
       f"SELECT {O.OKEY} AS ROWKEY, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS status, "
       f"CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS priority, o_custkey AS custkey, "
       f"o_totalprice AS totalprice FROM orders")
def q_delete_mapped(spark, sf):
    def mapper(orders: DataFrame) -> DataFrame:
        """Finished orders lose their status and priority columns."""
        done = orders.filter(F.col("o_orderstatus") == "F").select(fx.order_key("o_orderkey").alias("rowkey"))
        return done.select("rowkey", F.lit("cf").alias("family"),
                           F.explode(F.array(F.lit("status"), F.lit("priority"))).alias("qualifier"))
    tomb = W.delete_mapped(fx.table(spark, sf, "orders"), mapper, ts=2)
    return decoded_orders_log(W.with_batches(fx.orders_log(spark, sf), tomb))


@query("delete_latest_version", _with(O.EVENTS_VERSIONS) +
       "SELECT rowkey, family, qualifier, ts, seq, s_val, n_val FROM evr "
       "WHERE (family = 'cf' AND user_id % 3 = 0 AND rn = 2) OR (NOT (family = 'cf' AND user_id % 3 = 0) AND rn = 1)")
def q_delete_latest_version(spark, sf):
    log = fx.events_log(spark, sf)
    targets = fx.table(spark, sf, "events").filter(F.col("user_id") % 3 == 0).select(
        fx.padded("user_id", 6).alias("rowkey"), F.lit("cf").alias("family"),
        F.col("event_type").alias("qualifier"))
    tomb = W.delete_latest_version(log, targets, seq=0)
    live = W.apply_batch(log, tomb)
    return P.typed_view(live, fx.EVENTS_TYPES, extra=("ts", "seq"))


@query("delete_range", f"SELECT {DECODED_ORDERS_SQL} FROM orders WHERE NOT ({O.OKEY} >= '0000002000' "
                       f"AND {O.OKEY} < '0000004000')")
def q_delete_range(spark, sf):
    log = fx.orders_log(spark, sf)
    return decoded_orders_log(W.with_batches(log, W.delete_range(log, "0000002000", "0000004000", ts=2)))


@query("copy_table", _with(O.ORDERS_CELLS) +
       "SELECT rowkey, family, qualifier, CAST(100 AS BIGINT) AS ts, s_val, n_val FROM orders_cells")
def q_copy_table(spark, sf):
    copied = W.copy_table(fx.orders_log(spark, sf), ts=100)
    return orders_view(latest_cells(copied, version_deletes=False, row_deletes=False))


@query("sql_insert",
       f"SELECT pk, status, totalprice FROM ({CATALOG_SQL}) t WHERE status = 'O' AND priority = '1-URGENT' "
       f"UNION ALL SELECT pk, status, totalprice FROM ({CATALOG_SQL}) t WHERE status = 'F' AND totalprice > 300000.0")
def q_sql_insert(spark, sf):
    tag = uuid.uuid4().hex[:12]
    view, name = f"orders_catalog_{tag}", f"orders_pick_{tag}"
    Q.register(C.read_wide(fx.ORDERS_CATALOG, fx.orders_wide(spark, sf)), view)
    location = scratch_path(spark, name)
    Q.create_parquet_table(spark, name, "pk STRING, status STRING, totalprice DOUBLE", location)
    Q.exec_update(spark, f"INSERT INTO {name} SELECT pk, status, totalprice FROM {view} "
                         f"WHERE status = 'O' AND priority = '1-URGENT'")
    Q.exec_update(spark, f"INSERT INTO {name} SELECT pk, status, totalprice FROM {view} "
                         f"WHERE status = 'F' AND totalprice > 300000.0")
    spark.catalog.dropTempView(view)
    spark.sql(f"DROP TABLE {name}")  # external: the written files stay
    return spark.read.parquet(location)


# ============================================================ G geo
@query("geohash_encode", _with(O.LOCATIONS) +
       f"SELECT uid, lon, lat, {O.geohash_sql('lat', 'lon', 12)} AS hash12, {O.geohash_sql('lat', 'lon', 1)} AS hash1, "
       f"{O.geohash_sql('lat', 'lon', 5)} AS hash5 FROM locations")
def q_geohash_encode(spark, sf):
    pts = fx.locations(spark, sf)
    lat, lon = F.col("lat"), F.col("lon")
    return pts.select("uid", "lon", "lat", geohash(lat, lon, 12).alias("hash12"), geohash(lat, lon, 1).alias("hash1"),
                      geohash(lat, lon, 5).alias("hash5"))


@query("geohash_neighbors", _with(O.QUERY_POINTS, O.blocks_sql(2)) +
       f"SELECT qid, dx, dy, {O.hash_sql('cx', 'cy', 2)} AS cell FROM blocks")
def q_geohash_neighbors(spark, sf):
    return G.query_blocks(fx.query_points(spark, sf), 2).select("qid", "dx", "dy", "cell")


def _decoded_locations(spark, sf) -> DataFrame:
    live = latest_cells(fx.locations_log(spark, sf), version_deletes=False, row_deletes=False)
    d = P.decode_columns(live, [("uid", "long"), ("longitude", "double"), ("latitude", "double")], family="cf",
                         with_key=True)
    return d.select("uid", F.col("ROWKEY").alias("hash"), F.col("longitude").alias("lon"),
                    F.col("latitude").alias("lat"))


DIST_SQL = "sqrt((l.lon - q.qlon) * (l.lon - q.qlon) + (l.lat - q.qlat) * (l.lat - q.qlat))"


def _centre_sql(p: int) -> str:
    return (_with(O.LOCATIONS, O.QUERY_POINTS,
                  f"qc AS ({O.cells_sql(p, 'qpts', 'qid', 'qid, lon AS qlon, lat AS qlat')})",
                  f"lc AS ({O.cells_sql(p, 'locations', 'uid', 'uid, hash, lon, lat')})"))


@query("cell_candidates", _centre_sql(1) +
       f"SELECT qid, CAST(rank AS INTEGER) AS rank, uid, hash, lon, lat, distance FROM (SELECT q.qid, l.uid, l.hash, l.lon, l.lat, "
       f"{DIST_SQL} AS distance, row_number() OVER (PARTITION BY q.qid ORDER BY {DIST_SQL}, l.uid) AS rank "
       f"FROM qc q JOIN lc l ON q.gx = l.gx AND q.gy = l.gy) t WHERE rank <= 5")
def q_cell_candidates(spark, sf):
    """takeN over the location *log*: decoded cells of each query's own cell, nearest 5."""
    return G.cell_candidates(_decoded_locations(spark, sf), fx.query_points(spark, sf), 1, 5)


def _centre_dist_sql(p: int) -> str:
    from tessera.functions.geohash import LAT_RANGE, LON_RANGE, bits_for

    lon_bits, lat_bits = bits_for(p)
    w = LON_RANGE[1] / (1 << lon_bits)
    h = LAT_RANGE[1] / (1 << lat_bits)
    cx = f"(CAST('{LON_RANGE[0]!r}' AS DOUBLE) + (CAST(gx AS DOUBLE) + CAST('0.5' AS DOUBLE)) * CAST('{w!r}' AS DOUBLE))"
    cy = f"(CAST('{LAT_RANGE[0]!r}' AS DOUBLE) + (CAST(gy AS DOUBLE) + CAST('0.5' AS DOUBLE)) * CAST('{h!r}' AS DOUBLE))"
    return (_with(O.LOCATIONS, f"lc AS ({O.cells_sql(p, 'locations', 'uid', 'uid, lon, lat')})") +
            f"SELECT uid, {O.hash_sql('gx', 'gy', p)} AS cell, sqrt((lon - {cx}) * (lon - {cx}) + "
            f"(lat - {cy}) * (lat - {cy})) AS distance FROM lc")


@query("planar_distance", _centre_dist_sql(2))
def q_planar_distance(spark, sf):
    return G.distance_to_cell_centre(fx.locations(spark, sf).select("uid", "lon", "lat"), 2)


KNN_SQL = (_with(O.LOCATIONS, O.QUERY_POINTS, O.blocks_sql(1),
                            f"lc AS ({O.cells_sql(1, 'locations', 'uid', 'uid, hash, lon, lat')})") +
       f"SELECT qid, CAST(rank AS INTEGER) AS rank, uid, hash, lon, lat, distance FROM (SELECT q.qid, l.uid, l.hash, l.lon, l.lat, "
       f"{DIST_SQL} AS distance, row_number() OVER (PARTITION BY q.qid ORDER BY {DIST_SQL}, l.uid) AS rank "
       f"FROM blocks q JOIN lc l ON q.cx = l.gx AND q.cy = l.gy) t WHERE rank <= 5")


@query("knn_geohash", KNN_SQL)
def q_knn_geohash(spark, sf):
    return G.knn_geohash(fx.locations(spark, sf), fx.query_points(spark, sf), n=5, precision=1)


@query("knn_geohash_multilevel", KNN_SQL)
def q_knn_geohash_multilevel(spark, sf):
    """The same kNN through the multi-resolution search (fine level 2), as used on dense data."""
    return G.knn_geohash(fx.locations(spark, sf), fx.query_points(spark, sf), n=5, precision=1, fine_precision=2)


@query("knn_geohash_edges",
       _with(O.LOCATIONS, O.QUERY_POINTS, O.EDGE_LOCATIONS, O.EDGE_QUERIES, O.blocks_sql(1, "equeries"),
             f"lc AS ({O.cells_sql(1, 'elocs', 'uid', 'uid, hash, lon, lat')})") +
       f"SELECT qid, CAST(rank AS INTEGER) AS rank, uid, hash, lon, lat, distance FROM (SELECT q.qid, l.uid, l.hash, l.lon, l.lat, "
       f"{DIST_SQL} AS distance, row_number() OVER (PARTITION BY q.qid ORDER BY {DIST_SQL}, l.uid) AS rank "
       f"FROM blocks q JOIN lc l ON q.cx = l.gx AND q.cy = l.gy) t WHERE rank <= 5")
def q_knn_geohash_edges(spark, sf):
    """kNN with points and queries on both sides of the antimeridian and at both poles."""
    pts = fx.at_edges(fx.locations(spark, sf).select("uid", "lon", "lat")).withColumn("hash", F.col("uid").cast("string"))
    return G.knn_geohash(pts, fx.at_edges(fx.query_points(spark, sf)), n=5, precision=1)


# ============================================================ J joins
@query("join_decoded",
       f"SELECT {O.OKEY} AS pk, c_name, o_orderstatus AS status, o_totalprice AS totalprice FROM orders "
       f"JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def q_join_decoded(spark, sf):
    decoded = C.read_log(fx.ORDERS_CATALOG, latest_cells(fx.orders_log(spark, sf), version_deletes=False,
                                                         row_deletes=False))
    cust = fx.table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return decoded.join(cust, decoded.custkey == cust.c_custkey).select("pk", "c_name", "status", "totalprice")
