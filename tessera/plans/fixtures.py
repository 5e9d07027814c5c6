"""Deterministic wide-column fixtures derived from the given parquet tables.

Each function reads the tables of ``sf_dir`` and derives a frame with
DataFrame operators only, so every fixture grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.geohash import with_geohash
from tessera.model import DEL_COLUMN, DEL_ROW, PUT, Catalog, ColumnSpec
from tessera.operators.mutate import bulk_load
from tessera.operators.shape import melt_to_cells
from tessera.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(log: DataFrame, name: str) -> DataFrame:
    """A log as it lies in the store: written under the shared checkpoint folder and read back."""
    path = scratch_path(log.sparkSession, name)
    log.write.parquet(path)
    return log.sparkSession.read.schema(log.schema).parquet(path)


def stored_by_key(log: DataFrame, name: str, key_parts: int) -> DataFrame:
    """A log as a bulk load by key (W6) leaves it, read back."""
    path = scratch_path(log.sparkSession, name)
    bulk_load(log, path, 1, key_parts=key_parts)
    return log.sparkSession.read.parquet(path)


# ------------------------------------------------------------------ orders
ORDERS_CATALOG = Catalog.from_json(
    """{"table": {"namespace": "default", "name": "orders"},
        "rowkey": "key",
        "columns": {
          "pk":         {"cf": "rowkey", "col": "key",        "type": "string"},
          "status":     {"cf": "cf",     "col": "status",     "type": "string"},
          "priority":   {"cf": "cf",     "col": "priority",   "type": "string"},
          "custkey":    {"cf": "cf",     "col": "custkey",    "type": "long"},
          "totalprice": {"cf": "cf",     "col": "totalprice", "type": "double"}}}"""
)
ORDERS_TYPES = {"status": "string", "priority": "string", "custkey": "long", "totalprice": "double"}
ORDERS_COLUMNS = [("status", "string"), ("priority", "string"), ("custkey", "long"), ("totalprice", "double")]
REPUT_PRIORITY = "9-REPUT"


def padded(c, width: int) -> F.Column:
    """A number as text with zeros up to ``width``; longer numbers stay whole, where lpad alone would cut them."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), "0")


def order_key(c) -> F.Column:
    return padded(c, 10)


def orders_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed table under the orders catalog: ``pk, status, priority, custkey, totalprice``."""
    return table(spark, sf_dir, "orders").select(
        order_key("o_orderkey").alias("pk"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_totalprice").alias("totalprice"),
    )


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders_wide as puts: family ``cf``, ts 1, seq 0."""
    specs = [ColumnSpec(c.name, c.family, c.qualifier, c.type) for c in ORDERS_CATALOG.value_columns]
    return melt_to_cells(orders_wide(spark, sf_dir), "pk", specs, ts=1, seq=0)


def orders_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """del_row for key % 10 = 0 and del_column(priority) for % 7 = 0 at ts 2; re-put of priority at ts 3 for % 21 = 0.

    One pass over orders: each order yields an array of its (possibly absent) mutations.
    """
    from tessera.functions.codec import encode

    ok = F.col("o_orderkey")

    def mutation(cond, family, qualifier, ts, seq, op, value):
        return F.when(cond, F.struct(
            F.lit(family).cast("string").alias("family"), F.lit(qualifier).cast("string").alias("qualifier"),
            F.lit(ts).cast("bigint").alias("ts"), F.lit(seq).cast("bigint").alias("seq"), F.lit(op).alias("op"),
            value.alias("value")))

    null_bin = F.lit(None).cast("binary")
    muts = F.array(
        mutation(ok % 10 == 0, None, None, 2, 1, DEL_ROW, null_bin),
        mutation(ok % 7 == 0, "cf", "priority", 2, 1, DEL_COLUMN, null_bin),
        mutation(ok % 21 == 0, "cf", "priority", 3, 2, PUT, F.encode(F.lit(REPUT_PRIORITY), "UTF-8")),
    )
    o = table(spark, sf_dir, "orders").select(order_key("o_orderkey").alias("rowkey"), F.explode(muts).alias("m"))
    return o.filter(F.col("m").isNotNull()).select("rowkey", "m.family", "m.qualifier", "m.ts", "m.seq", "m.op", "m.value")


# ------------------------------------------------------------------ events
EVENTS_TYPES = {"props": "string", "click": "double", "view": "double", "purchase": "double", "signup": "double",
                "error": "double"}


def event_micros(c: str = "ts") -> F.Column:
    """Epoch microseconds of a TIMESTAMP_NTZ column, independent of the session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rowkey = padded(user_id, 6); cf:<event_type> = value (double), meta:props = props; many versions per cell."""
    e = table(spark, sf_dir, "events")
    base = e.select(
        padded("user_id", 6).alias("rowkey"),
        event_micros("ts").alias("ts"), F.col("event_id").alias("seq"), "event_type", "value", "props")
    from tessera.functions.codec import encode

    cells = F.array(
        F.struct(F.lit("cf").alias("family"), F.col("event_type").alias("qualifier"),
                 encode("value", "double").alias("value")),
        F.struct(F.lit("meta").alias("family"), F.lit("props").alias("qualifier"),
                 encode("props", "string").alias("value")),
    )
    return base.select("rowkey", "ts", "seq", F.inline(cells)).filter(F.col("value").isNotNull()).select(
        "rowkey", "family", "qualifier", "ts", "seq", F.lit(PUT).alias("op"), "value")


def events_keys_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rowkey = user_id _ yyyy-MM-dd _ event_id; cf:type (string), cf:value (double)."""
    e = table(spark, sf_dir, "events")
    key = F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"),
                      F.col("event_id").cast("string"))
    wide = e.select(key.alias("rk"), F.col("event_type").alias("type"), "value")
    return melt_to_cells(wide, "rk", [ColumnSpec("type", "cf", "type", "string"),
                                      ColumnSpec("value", "cf", "value", "double")], ts=1, seq=0)


EVENTS_KEYS_TYPES = {"type": "string", "value": "double"}


# ---------------------------------------------------------------- customer
CUSTOMER_TYPES = {"flag": "string", "name": "string", "segment": "string", "counter": "long"}


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rowkey = padded(c_custkey, 6); cf:flag = 'neg' (negative balance only), cf:name, cf:segment, stats:counter (long)."""
    c = table(spark, sf_dir, "customer").select(
        padded("c_custkey", 6).alias("rk"),
        F.when(F.col("c_acctbal") < 0, F.lit("neg")).alias("flag"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("bigint").alias("counter"))
    specs = [ColumnSpec("flag", "cf", "flag", "string"), ColumnSpec("name", "cf", "name", "string"),
             ColumnSpec("segment", "cf", "segment", "string"), ColumnSpec("counter", "stats", "counter", "long")]
    return melt_to_cells(c, "rk", specs, ts=1, seq=0)


# ------------------------------------------------------------------- users
USER_CREATED = "2020-07-13 19:51:42.923"
USER_COLUMNS = [("uid", "string"), ("sex", "string"), ("age", "int"), ("created_time", "string")]


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UserData rows from customer: uid, sex (by key parity), age = nation key, constant created_time."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("uid"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("female")).otherwise(F.lit("male")).alias("sex"),
        F.col("c_nationkey").cast("int").alias("age"),
        F.lit(USER_CREATED).alias("created_time"),
    )


# --------------------------------------------------------------- locations
LOCATION_TYPES = {"uid": "long", "longitude": "double", "latitude": "double", "tag1": "string"}


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points from part: ``uid, lon, lat, tag1, hash`` where hash = geohash(12) || uid (the row key)."""
    p = table(spark, sf_dir, "part")
    lon = ((F.col("p_partkey") * 7919) % 36000) / F.lit(100.0) - 180
    lat = ((F.col("p_partkey") * 104729) % 18000) / F.lit(100.0) - 90
    pts = p.select(F.col("p_partkey").alias("uid"), lon.alias("lon"), lat.alias("lat"), F.col("p_brand").alias("tag1"))
    return with_geohash(pts, "lat", "lon", 12, "hash").withColumn("hash", F.concat("hash", F.col("uid").cast("string")))


def locations_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location table as cells: key = hash; cf:uid (long), cf:longitude, cf:latitude (double), cf:tag1."""
    specs = [ColumnSpec("uid", "cf", "uid", "long"), ColumnSpec("lon", "cf", "longitude", "double"),
             ColumnSpec("lat", "cf", "latitude", "double"), ColumnSpec("tag1", "cf", "tag1", "string")]
    return melt_to_cells(locations(spark, sf_dir), "hash", specs, ts=1, seq=0)


def query_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query points from supplier: ``qid, lon, lat``."""
    s = table(spark, sf_dir, "supplier")
    lon = ((F.col("s_suppkey") * 3571) % 36000) / F.lit(100.0) - 180
    lat = ((F.col("s_suppkey") * 1013) % 18000) / F.lit(100.0) - 90
    return s.select(F.col("s_suppkey").alias("qid"), lon.alias("lon"), lat.alias("lat"))


def _to_edge(col: str, half: float) -> F.Column:
    """A coordinate mirrored into the last thirty-sixth before either end of its range."""
    c = F.col(col)
    return F.when(c >= 0, F.lit(half) - c / F.lit(36.0)).otherwise(F.lit(-half) - c / F.lit(36.0))


def at_edges(points: DataFrame) -> DataFrame:
    """Points (or queries) moved to both sides of the antimeridian and to both poles."""
    return points.withColumn("lon", _to_edge("lon", 180.0)).withColumn("lat", _to_edge("lat", 90.0))


# --------------------------------------------------------------- text puts
def text_put_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rowkey,qualifier,value`` lines from part, plus 2-field lines (rejects) and 4-field lines (extra ignored)."""
    p = table(spark, sf_dir, "part")
    k = padded("p_partkey", 6)
    name = p.select(F.concat_ws(",", k, F.lit("name"), F.col("p_name")).alias("value"))
    brand = p.select(F.when(F.col("p_partkey") % 5 == 0, F.concat_ws(",", k, F.lit("brand")))
                     .otherwise(F.concat_ws(",", k, F.lit("brand"), F.col("p_brand"), F.lit("extra"))).alias("value"))
    return name.unionByName(brand)
