"""Logs laid out by key: lookups read the parts of their keys, appends and bulk loads keep the layout."""

import pytest
from plan_tools import metric, scans
from pyspark.sql import functions as F

from tessera.functions.keys import key_parts, part_column, part_of
from tessera.operators import mutate as W
from tessera.operators.versions import latest_cells
from tessera.plans import fixtures as fx
from tessera.plans import registry
from tessera.session import scratch_path
from tessera.sources import scan as S
from tessera.table import WideTable

SF = "/root/testdata/sf0.001"
PARTS = 64


@pytest.fixture(scope="module")
def log(spark):
    return fx.stored_by_key(registry.orders_with_tombstones(spark, SF), "keyed-test", PARTS)


def keys_of(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "rowkey string").filter(F.col("rowkey") != "")


def read_parts(df):
    """Folders read by the largest scan of a log that has run."""
    return [metric(s, "numPartitions") for s in scans(df) if "key_part_of" in s.toString()]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_layout(spark, log):
    assert key_parts(log.columns) == PARTS and part_column(PARTS) in log.columns
    assert log.filter(F.col(part_column(PARTS)) != part_of("rowkey", PARTS)).count() == 0
    assert rows(log.select("rowkey", "family", "qualifier", "ts", "seq", "op", "value")) == rows(
        registry.orders_with_tombstones(spark, SF).select("rowkey", "family", "qualifier", "ts", "seq", "op", "value"))
    # every file holds one part in the order of keys
    inside = log.select(F.input_file_name().alias("f"), part_column(PARTS), "rowkey", F.monotonically_increasing_id().alias("i")).collect()
    by = {}
    for r in inside:
        by.setdefault(r.f, []).append((r.i, r[1], r.rowkey))
    for found in by.values():
        found.sort()
        assert len({p for _, p, _ in found}) == 1 and [k for *_, k in found] == sorted(k for *_, k in found)
    with pytest.raises(ValueError):
        part_column(0)


@pytest.mark.parametrize("keys", [["0000000003"], ["0000000003", "0000000021", "nobody"]])
def test_a_lookup_reads_the_parts_of_its_keys(spark, log, keys):
    k = keys_of(spark, *keys)
    wanted = k.select(part_of("rowkey", PARTS)).distinct().count()
    df = S.bulk_get(log, k)
    assert rows(df) == rows(latest_cells(log).filter(F.col("rowkey").isin(*keys)))
    assert len(read_parts(df)) > 0 and all(n <= wanted for n in read_parts(df))
    value = S.get_value(log, k, "cf", "status")
    assert value.count() == len(keys)
    value.collect()
    assert len(read_parts(value)) > 0 and all(n <= wanted for n in read_parts(value))


def test_registered_lookups_read_few_parts(spark):
    for name in ("bulk_get_stored", "get_value_stored"):
        df = registry.queries()[name](spark, SF)
        df.collect()
        wanted = registry._few_keys(spark, SF).select(part_of("rowkey", PARTS)).distinct().count()
        assert read_parts(df) and all(0 < n <= wanted < PARTS for n in read_parts(df))
    one = registry.queries()["scan_row_stored"](spark, SF)
    one.collect()
    assert read_parts(one) and set(read_parts(one)) == {1}


def test_no_keys_and_all_keys(spark, log):
    assert S.bulk_get(log, keys_of(spark, "").limit(0)).count() == 0
    every = log.select("rowkey").distinct()
    assert S.bulk_get(log, every).count() == latest_cells(log).count()
    missing = S.bulk_get(log, keys_of(spark, "nobody"), keep_missing=True).collect()
    assert [(r.rowkey, r.family) for r in missing] == [("nobody", None)]


def test_other_logs_are_read_as_before(spark):
    plain = fx.stored(fx.orders_log(spark, SF), "plain-test")
    assert key_parts(plain.columns) is None and S.bulk_get(plain, keys_of(spark, "0000000003")).count() == 4


def test_appends_and_staged_loads_keep_the_layout(spark):
    t = WideTable(spark, scratch_path(spark, "keyed-table"), key_parts=8)
    t.put_columns(spark.createDataFrame([(f"u{i}", i) for i in range(50)], "uid string, age int"), "uid", "cf", ts=1)
    again = WideTable(spark, t.path)  # the log tells its own layout
    again.put_columns(spark.createDataFrame([("u7", 70)], "uid string, age int"), "uid", "cf", ts=2)
    again.bulk_load(W.upsert_family(spark.createDataFrame([("u8", 80), ("v", 1)], "uid string, age int"), "uid", "cf", ts=3),
                    scratch_path(spark, "keyed-stage"), 2)
    again.delete_rows(spark.createDataFrame([("u9",)], "rowkey string"), ts=4)
    log = again.log()
    assert key_parts(log.columns) == 8 and log.filter(F.col(part_column(8)) != part_of("rowkey", 8)).count() == 0
    got = {r.ROWKEY: r.age for r in again.decode([("age", "int")], family="cf", with_key=True).collect()}
    assert len(got) == 50 and (got["u7"], got["u8"], got["v"], got["u6"]) == (70, 80, 1, 6) and "u9" not in got
    df = again.get(keys_of(spark, "u7"))
    assert [r.ts for r in df.collect()] == [2] and all(n == 1 for n in read_parts(df))


def test_a_hot_row_has_many_files(spark):
    hot = spark.range(40000).select(F.lit("hot").alias("rowkey"), F.lit("cf").alias("family"), F.format_string("q%06d", "id").alias("qualifier"),
                                    F.lit(1).cast("long").alias("ts"), F.lit(0).cast("long").alias("seq"), F.lit("put").alias("op"),
                                    F.lit(b"x").alias("value"))
    path = scratch_path(spark, "keyed-hot")
    W.bulk_load(hot, path, 8, key_parts=4)
    log = spark.read.parquet(path)
    assert log.select(F.input_file_name()).distinct().count() == 8 and S.scan_row(log, "hot").count() == 40000
