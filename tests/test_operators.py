"""Unit tests built from the reference's demo rows and semantics."""

import os

import pytest

from pyspark.sql import functions as F

from tessera.functions.geohash import geohash
from tessera.functions.keys import salted_key
from tessera.model import LOG_SCHEMA, Catalog
from tessera.operators import filters as FL
from tessera.operators import knn as G
from tessera.operators import mutate as W
from tessera.operators import shape as P
from tessera.operators.versions import latest_cells
from tessera.session import scratch_path
from tessera.sources import catalog as C
from tessera.sources import scan as S
from tessera.sources import text as TX

USERS = [("lily", "female", 12, "2020-07-13 19:51:42.923"), ("lucy", "female", 22, "2020-08-13 19:52:42.923")]


def empty_log(spark):
    return spark.createDataFrame([], LOG_SCHEMA)


def test_salted_key_sample(spark):
    assert spark.range(1).select(salted_key(F.lit("lily")).alias("k")).first().k == "89flily"


def test_geohash_sample(spark):
    r = spark.range(1).select(geohash(F.lit(23.78115770591269), F.lit(-32.59170314251077), 12).alias("h"),
                              geohash(F.lit(23.78115770591269), F.lit(-32.59170314251077), 1).alias("h1")).first()
    assert r.h == "ek0z635rq30e" and r.h1 == "e"


def test_geohash_edges(spark):
    df = spark.createDataFrame([(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)], "lat double, lon double")
    out = [r.h for r in df.select(geohash(F.col("lat"), F.col("lon"), 2).alias("h")).collect()]
    assert out == ["zz", "00", "s0"]


def test_bulk_put_get_delete(spark):
    # bulkPut keys 1-5 qualifier num, bulk get 1, 4, 5, delete 1-5
    data = spark.createDataFrame([(str(i), [("cf", "num", str(i))]) for i in range(1, 6)],
                                 "rowkey string, cells array<struct<family:string,qualifier:string,value:string>>")
    puts = W.bulk_put(data, ts=1)
    got = S.bulk_get(puts, spark.createDataFrame([("1",), ("4",), ("5",), ("9",)], "rowkey string"),
                     keep_missing=True)
    rows = sorted((r.rowkey, r.value.decode() if r.value else None) for r in got.collect())
    assert rows == [("1", "1"), ("4", "4"), ("5", "5"), ("9", None)]
    dels = W.delete_rows(spark.createDataFrame([(str(i),) for i in range(1, 6)], "rowkey string"), ts=2)
    assert W.apply_batch(puts, dels).count() == 0


def test_bulk_put_with_older_timestamp_loses(spark):
    base = W.bulk_put(spark.createDataFrame([("6", [("cf", "1", "new")])], "rowkey string, cells array<struct<family:string,qualifier:string,value:string>>"), ts=10)
    old = W.bulk_put_with_timestamp(spark.createDataFrame([("6", [("cf", "1", "old")])], "rowkey string, cells array<struct<family:string,qualifier:string,value:string>>"), 5)
    assert W.apply_batch(base, old).first().value == b"new"


def test_put_users_and_decode(spark):
    users = spark.createDataFrame(USERS, "uid string, sex string, age int, created_time string")
    puts = W.upsert_family(users, "uid", "cf", ts=1)
    d = P.decode_columns(latest_cells(puts), [("sex", "String"), ("age", "Int"), ("`created_time`", "String"),
                                              ("missing", "Double")], family="cf", with_key=True)
    rows = sorted(tuple(r) for r in d.collect())
    assert rows[0] == ("lily", "female", 12, "2020-07-13 19:51:42.923", 0.0)
    assert d.columns == ["ROWKEY", "sex", "age", "created_time", "missing"]


def test_cf_map_upsert_and_maps(spark):
    data = spark.createDataFrame([("k1", {"cf:a": "1", "info:a": "2", "cf:b": "3"})], "rowkey string, cells map<string,string>")
    cells = latest_cells(W.upsert_cf_map(data, ts=1))
    m = P.rows_to_map(cells, as_string=True).first().cells
    assert m == {"a": "2", "b": "3"}  # same qualifier in two families: highest family wins
    cfm = P.rows_to_cf_map(cells).first().cells
    assert set(cfm) == {"cf:a", "info:a", "cf:b"}


def test_short_and_boolean_decode(spark):
    df = spark.createDataFrame([("k", 7, True)], "k string, s short, b boolean")
    cells = P.encode_family(df, "k", "cf", ts=1)
    d = P.decode_columns(latest_cells(cells), [("s", "Short"), ("b", "Boolean")], family="cf").first()
    assert d.s == 7 and d.b is True


def test_format_rows_counter(spark):
    df = spark.createDataFrame([("r", 5, "x")], "rowkey string, counter long, name string")
    cells = P.encode_family(df, "rowkey", "cf", ts=1)
    assert P.format_rows(latest_cells(cells)).first().line == "r:(counter,5)(name,x)"


def test_filters_compose(spark):
    data = spark.createDataFrame([("row1", {"cf:qual1": "ROW2_QUAL1 x", "cf:other": "y"}),
                                  ("row2", {"cf:qual1": "nope"})], "rowkey string, cells map<string,string>")
    cells = latest_cells(W.upsert_cf_map(data, ts=1))
    out = FL.filter_all(FL.by_row_prefix("row"), FL.column_prefix("qual1"), FL.value_substring("row2_qual1"))(cells)
    assert [(r.rowkey, r.qualifier) for r in out.collect()] == [("row1", "qual1")]
    assert FL.skip_rows(FL.value_matches("o"))(cells).select("rowkey").distinct().count() == 1
    assert FL.first_cell(cells).count() == 2
    assert FL.column_count(1, stop_scan=True)(cells).select("rowkey").distinct().collect()[0].rowkey == "row1"
    assert FL.while_match(F.col("rowkey") != "zzz")(cells).count() == 3  # no failing row keeps all
    assert FL.random_rows(1.0)(cells).count() == 3 and FL.random_rows(0.0)(cells).count() == 0


def test_regex_is_find_with_dotall(spark):
    df = spark.createDataFrame([("a\n2020-07-22\nb",), ("x2020-07-22",), ("2020-07-22",)], "rowkey string")
    out = sorted(r.rowkey for r in df.filter(FL.find_regex(F.col("rowkey"), ".2020-07-22.")).collect())
    assert out == ["a\n2020-07-22\nb"]


def test_catalog_round_trip(spark):
    cat = Catalog.from_json('{"table":{"namespace":"default","name":"t"},"rowkey":"key","columns":{'
                            '"pkName":{"cf":"rowkey","col":"key","type":"string"},'
                            '"col1":{"cf":"cf","col":"age","type":"int"},'
                            '"col2":{"cf":"cf","col":"created_time","type":"string"},'
                            '"col3":{"cf":"cf","col":"sex","type":"string"}}}')
    df = spark.createDataFrame([("38", 20, "2020-11-38", "male"), ("39", 21, "2020-11-28", "female")],
                               "pkName string, col1 int, col2 string, col3 string")
    back = C.read_log(cat, latest_cells(C.to_cells(cat, df, ts=1)))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    assert Catalog.from_json(cat.to_json()) == cat
    path = scratch_path(spark, "cat-test")
    C.write_wide(cat, df, path, regions=2)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 2


def test_bulk_load_layout_is_globally_sorted(spark):
    from tessera.plans.registry import bulk_load_sorted

    users = spark.range(3000).select(F.col("id").cast("string").alias("uid"), F.lit("f").alias("sex"),
                                     F.lit(1).alias("age"), F.lit("t").alias("created_time"))
    path = scratch_path(spark, "bulk-test")
    bulk_load_sorted(users, path, partitions=5)
    parts = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert len(parts) == 5
    prev_last = None
    for f in parts:
        keys = [(r.rowkey, r.family, r.qualifier) for r in spark.read.parquet(os.path.join(path, f)).collect()]
        assert keys == sorted(keys)
        if prev_last is not None:
            assert prev_last < keys[0]
        prev_last = keys[-1]


def test_text_puts_rejects(spark):
    lines = spark.createDataFrame([("k1,q,v",), ("k2,q",), ("k3,q,v,extra",)], "value string")
    puts, rejects = TX.parse_text_puts(lines, "fam")
    assert sorted((r.rowkey, r.family, r.value.decode()) for r in puts.collect()) == [("k1", "fam", "v"), ("k3", "fam", "v")]
    assert [r.line for r in rejects.collect()] == ["k2,q"]


def test_single_column_and_key_empty_row(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "rowkey string")
    cells = W.bulk_put(spark.createDataFrame([("a", [("cf", "q", "v")])], "rowkey string, cells array<struct<family:string,qualifier:string,value:string>>"), ts=1)
    got = sorted(tuple(r) for r in P.single_column_and_key(rows, latest_cells(cells)).collect())
    assert got == [("", "b"), ("v", "a")]


@pytest.mark.parametrize("fine", [None, 3, 4, "auto"])
def test_knn_against_brute_force(spark, fine):
    pts = spark.range(3000).select(
        F.col("id").alias("uid"), (((F.col("id") * 7919) % 36000) / 100.0 - 180).alias("lon"),
        (((F.col("id") * 104729) % 18000) / 100.0 - 90).alias("lat")).withColumn("hash", F.col("uid").cast("string"))
    qs = spark.range(40).select(F.col("id").alias("qid"), (((F.col("id") * 3571) % 36000) / 100.0 - 180).alias("lon"),
                                (((F.col("id") * 1013) % 18000) / 100.0 - 90).alias("lat"))
    got = sorted((r.qid, r.rank, r.uid) for r in G.knn_geohash(pts, qs, n=4, precision=2, fine_precision=fine).collect())
    # brute force on the driver for a 3,000-point fixture
    import math
    P_ = [(r.uid, r.lon, r.lat) for r in pts.collect()]
    Q_ = [(r.qid, r.lon, r.lat) for r in qs.collect()]

    def cell(lon, lat):
        def idx(x, lo, span, bits):
            n = 1 << bits
            i = min(max(int(math.floor((x - lo) / span * n)), 0), n - 1)
            if x < lo + i * span / n:
                i -= 1
            if i < n - 1 and x >= lo + (i + 1) * span / n:
                i += 1
            return i
        return idx(lon, -180.0, 360.0, 5), idx(lat, -90.0, 180.0, 5)
    want = []
    for qid, qx, qy in Q_:
        cx, cy = cell(qx, qy)
        block = {((cx + dx) % 32, (cy + dy) % 32) for dx in (-1, 0, 1) for dy in (-1, 0, 1)}
        cand = sorted((math.sqrt((x - qx) ** 2 + (y - qy) ** 2), u) for u, x, y in P_ if cell(x, y) in block)
        want += [(qid, i + 1, u) for i, (_, u) in enumerate(cand[:4])]
    assert got == sorted(want)


def test_delete_latest_version_resurfaces(spark):
    rows = [("r", "cf", "q", 1, 0, "put", b"v1"), ("r", "cf", "q", 2, 0, "put", b"v2")]
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    targets = spark.createDataFrame([("r", "cf", "q")], "rowkey string, family string, qualifier string")
    tomb = W.delete_latest_version(log, targets)
    assert W.apply_batch(log, tomb).first().value == b"v1"
    tomb2 = W.delete_latest_version(log.unionByName(tomb), targets)
    assert W.apply_batch(log, tomb, tomb2).count() == 0


def test_scans(spark):
    data = spark.createDataFrame([(f"{i:03d}", {"cf:a": str(i), "cf:b": "x"}) for i in range(20)],
                                 "rowkey string, cells map<string,string>")
    log = W.upsert_cf_map(data, ts=1)
    assert S.scan_count(log, "005", "010").first().n_rows == 5
    assert [r.rowkey for r in S.scan_keys(log, "018", None).orderBy("rowkey").collect()] == ["018", "019"]
    assert S.prefix_first_row(log, "01", "cf").select("rowkey").distinct().first().rowkey == "010"
    assert S.scan_column_string(log, "cf", "a").count() == 20
    typed = S.scan_column_typed(log, "cf", "zz", "string")
    assert typed.count() == 20 and typed.filter(F.col("value").isNotNull()).count() == 0


def test_cf_map_keys_split_at_first_colon_and_reject_missing_family(spark):
    import pytest as _pytest

    ok = spark.createDataFrame([("k", {"cf:a:b": "v"})], "rowkey string, cells map<string,string>")
    c = W.upsert_cf_map(ok, ts=1).first()
    assert (c.family, c.qualifier) == ("cf", "a:b")
    bad = spark.createDataFrame([("k", {"nofamily": "v"})], "rowkey string, cells map<string,string>")
    with _pytest.raises(Exception, match="family:qualifier"):
        W.upsert_cf_map(bad, ts=1).collect()
    from tessera.model import column_specs, normalize_type
    with _pytest.raises(ValueError):
        normalize_type("Decimal")
    assert [(s.family, s.qualifier) for s in column_specs([("cf:x:y", "String")])] == [("cf", "x:y")]


def test_rowkey_column_info_and_default_bounds(spark):
    data = spark.createDataFrame([("a1", {"cf:q": "1"}), ("été", {"cf:q": "2"}), ("/x", {"cf:q": "3"}),
                                  ("500", {"cf:q": "4"})], "rowkey string, cells map<string,string>")
    log = W.upsert_cf_map(data, ts=1)
    d = P.decode_columns(latest_cells(log), [("", "ROWKEY"), ("q", "String")], family="cf")
    assert d.columns == ["ROWKEY", "q"] and d.count() == 4
    # default bounds "0".."~~~~" of the raw column scan: keys before "0" or after "~~~~" (non-ASCII) are not scanned
    assert sorted(r.rowkey for r in S.scan_column(log, "cf", "q").collect()) == ["500", "a1"]
    # the string scan has no bounds of its own
    assert sorted(r.rowkey for r in S.scan_column_string(log, "cf", "q").collect()) == ["/x", "500", "a1", "été"]
