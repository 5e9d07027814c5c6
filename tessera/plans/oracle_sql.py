"""DuckDB oracle SQL for the registered queries: the same fixtures, stated from the source tables.

Oracles never look at bytes: they state what the decoded result must be.
"""

from __future__ import annotations

from tessera.functions.geohash import LAT_RANGE, LON_RANGE, bits_for, cell_index_sql, geohash_sql, hash_of_cells_sql

OKEY = "lpad(CAST(o_orderkey AS VARCHAR), 10, '0')"
ALIVE = "(o_orderkey % 10 <> 0 OR o_orderkey % 21 = 0)"  # rows surviving the orders tombstones

ORDERS_CELLS = f"""orders_cells AS (
  SELECT {OKEY} AS rowkey, o_orderkey AS ok, 'cf' AS family, 'status' AS qualifier, CAST(1 AS BIGINT) AS ts,
         o_orderstatus AS s_val, CAST(NULL AS DOUBLE) AS n_val FROM orders
  UNION ALL SELECT {OKEY}, o_orderkey, 'cf', 'priority', CAST(1 AS BIGINT), o_orderpriority, CAST(NULL AS DOUBLE) FROM orders
  UNION ALL SELECT {OKEY}, o_orderkey, 'cf', 'custkey', CAST(1 AS BIGINT), CAST(NULL AS VARCHAR), CAST(o_custkey AS DOUBLE) FROM orders
  UNION ALL SELECT {OKEY}, o_orderkey, 'cf', 'totalprice', CAST(1 AS BIGINT), CAST(NULL AS VARCHAR), o_totalprice FROM orders)"""

# Live cells of orders after the tombstone fixture.
ORDERS_TOMB_CELLS = f"""orders_tcells AS (
  SELECT rowkey, ok, family, qualifier, ts, s_val, n_val FROM orders_cells
   WHERE ok % 10 <> 0 AND NOT (qualifier = 'priority' AND ok % 7 = 0)
  UNION ALL SELECT {OKEY}, o_orderkey, 'cf', 'priority', CAST(3 AS BIGINT), '9-REPUT', CAST(NULL AS DOUBLE)
   FROM orders WHERE o_orderkey % 21 = 0)"""

CKEY = "lpad(CAST(c_custkey AS VARCHAR), 6, '0')"
CUSTOMER_CELLS = f"""customer_cells AS (
  SELECT {CKEY} AS rowkey, 'cf' AS family, 'flag' AS qualifier, CAST(1 AS BIGINT) AS ts, 'neg' AS s_val,
         CAST(NULL AS DOUBLE) AS n_val, c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT {CKEY}, 'cf', 'name', CAST(1 AS BIGINT), c_name, CAST(NULL AS DOUBLE), c_custkey, c_mktsegment FROM customer
  UNION ALL SELECT {CKEY}, 'cf', 'segment', CAST(1 AS BIGINT), c_mktsegment, CAST(NULL AS DOUBLE), c_custkey, c_mktsegment FROM customer
  UNION ALL SELECT {CKEY}, 'stats', 'counter', CAST(1 AS BIGINT), CAST(NULL AS VARCHAR), CAST(c_nationkey AS DOUBLE), c_custkey, c_mktsegment FROM customer)"""

EKEY = "CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d') || '_' || CAST(event_id AS VARCHAR)"
EVENTS_KEYS_CELLS = f"""ek_cells AS (
  SELECT {EKEY} AS rowkey, 'cf' AS family, 'type' AS qualifier, CAST(1 AS BIGINT) AS ts, event_type AS s_val,
         CAST(NULL AS DOUBLE) AS n_val FROM events
  UNION ALL SELECT {EKEY}, 'cf', 'value', CAST(1 AS BIGINT), CAST(NULL AS VARCHAR), value FROM events)"""

EVENTS_VERSIONS = """ev AS (
  SELECT lpad(CAST(user_id AS VARCHAR), 6, '0') AS rowkey, user_id, 'cf' AS family, event_type AS qualifier,
         epoch_us(ts) AS ts, event_id AS seq, CAST(NULL AS VARCHAR) AS s_val, value AS n_val FROM events
  UNION ALL SELECT lpad(CAST(user_id AS VARCHAR), 6, '0'), user_id, 'meta', 'props', epoch_us(ts), event_id, props,
         CAST(NULL AS DOUBLE) FROM events),
evr AS (SELECT *, row_number() OVER (PARTITION BY rowkey, family, qualifier ORDER BY ts DESC, seq DESC) AS rn FROM ev)"""

USERS = """users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
         CAST(c_nationkey AS INTEGER) AS age, '2020-07-13 19:51:42.923' AS created_time FROM customer)"""

LOCATIONS = f"""locs AS (
  SELECT p_partkey AS uid, ((p_partkey * 7919) % 36000) / CAST(100 AS DOUBLE) - 180 AS lon,
         ((p_partkey * 104729) % 18000) / CAST(100 AS DOUBLE) - 90 AS lat, p_brand AS tag1 FROM part),
locations AS (SELECT uid, lon, lat, tag1, concat({geohash_sql('lat', 'lon', 12)}, CAST(uid AS VARCHAR)) AS hash FROM locs)"""

QUERY_POINTS = """qpts AS (
  SELECT s_suppkey AS qid, ((s_suppkey * 3571) % 36000) / CAST(100 AS DOUBLE) - 180 AS lon,
         ((s_suppkey * 1013) % 18000) / CAST(100 AS DOUBLE) - 90 AS lat FROM supplier)"""


def to_edge_sql(col: str, half: str) -> str:
    return (f"CASE WHEN {col} >= 0 THEN CAST({half} AS DOUBLE) - {col} / CAST(36 AS DOUBLE) "
            f"ELSE CAST(-{half} AS DOUBLE) - {col} / CAST(36 AS DOUBLE) END")


EDGE_LOCATIONS = f"""elocs AS (SELECT uid, CAST(uid AS VARCHAR) AS hash, {to_edge_sql('lon', '180')} AS lon,
  {to_edge_sql('lat', '90')} AS lat FROM locs)"""
EDGE_QUERIES = f"""equeries AS (SELECT qid, {to_edge_sql('lon', '180')} AS lon, {to_edge_sql('lat', '90')} AS lat FROM qpts)"""


def cells_sql(p: int, table: str, key: str, cols: str) -> str:
    lon_bits, lat_bits = bits_for(p)
    return (f"SELECT {cols}, {cell_index_sql('lon', *LON_RANGE, lon_bits)} AS gx, "
            f"{cell_index_sql('lat', *LAT_RANGE, lat_bits)} AS gy FROM {table}")


def blocks_sql(p: int, queries: str = "qpts") -> str:
    """3x3 wrapped blocks of every query point at precision p: qid, qlon, qlat, dx, dy, cx, cy."""
    lon_bits, lat_bits = bits_for(p)
    nx, ny = 1 << lon_bits, 1 << lat_bits
    return f"""qc AS ({cells_sql(p, queries, 'qid', 'qid, lon AS qlon, lat AS qlat')}),
offs AS (SELECT * FROM (VALUES (-1,-1),(0,-1),(1,-1),(-1,0),(0,0),(1,0),(-1,1),(0,1),(1,1)) t(dx, dy)),
blocks AS (SELECT DISTINCT qid, qlon, qlat, dx, dy, ((gx + dx) % {nx} + {nx}) % {nx} AS cx,
                  ((gy + dy) % {ny} + {ny}) % {ny} AS cy FROM qc, offs)"""


def hash_sql(gx: str, gy: str, p: int) -> str:
    return hash_of_cells_sql(gx, gy, p)
