"""Filters that resolve their input once: file scans in the executed plans, equal results, hot rows over many tasks."""

import random

import pytest
from plan_tools import nodes, scans
from pyspark.sql import functions as F

from tessera.model import LOG_SCHEMA
from tessera.operators import filters as FL
from tessera.operators import skew
from tessera.operators.versions import latest_cells
from tessera.plans import fixtures as fx
from tessera.plans import registry
from tessera.session import scratch_path
from tessera.sources import scan as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def random_log(spark):
    """Versions, tombstones of every kind and equal ts over few rows and columns."""
    rng = random.Random(11)
    rows = []
    for i in range(4000):
        op = rng.choice(["put"] * 12 + ["del_row", "del_column", "del_version"])
        r, q, ts = f"r{rng.randrange(120):03d}", f"q{rng.randrange(4)}", rng.randrange(9)
        whole = op == "del_row"
        rows.append((r, None if whole else "cf", None if whole else q, ts, i, op, rng.choice([b"a", b"b", b"bad", b""]) if op == "put" else None))
    path = scratch_path(spark, "random-log")
    spark.createDataFrame(rows, LOG_SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted(map(tuple, df.collect()))


def file_scans(df):
    df.collect()
    return len(scans(df))


@pytest.fixture()
def no_broadcast(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize("value", [b"a", b"bad"])
def test_column_value_in_two_scans(random_log, value, exclude):
    df = S.scan_rows_where_column(random_log, "cf", "q1", F.col("value") == F.lit(value), exclude_tested=exclude)
    want = FL.by_single_column_value("cf", "q1", value, exclude_tested=exclude)(latest_cells(random_log))
    assert rows(df) == rows(want) and rows(df)
    assert file_scans(df) == 2


def test_column_value_without_kinds_of_tombstones(random_log):
    for left_out, flags in (("del_version", {"version_deletes": False}), ("del_row", {"row_deletes": False})):
        log = random_log.filter(F.col("op") != left_out)
        df = S.scan_rows_where_column(log, "cf", "q2", F.col("value") == F.lit(b"b"), **flags)
        assert rows(df) == rows(FL.by_single_column_value("cf", "q2", b"b")(latest_cells(log)))


def test_column_value_by_sort_merge_join(random_log, no_broadcast):
    df = S.scan_rows_where_column(random_log, "cf", "q1", FL.find_regex(F.decode("value", "UTF-8"), "^b"))
    assert rows(df) == rows(FL.by_single_column_regex("cf", "q1", "^b")(latest_cells(random_log)))


def test_stored_column_value_query_scans_twice(spark):
    assert file_scans(registry.queries()["filter_column_value_stored"](spark, SF)) == 2


def test_skip_in_one_scan(random_log):
    pred = F.col("value") != F.lit(b"bad")
    df = FL.skip_rows(pred)(latest_cells(random_log))
    bad = {r.rowkey for r in latest_cells(random_log).filter(~pred).collect()}
    assert rows(df) == [r for r in rows(latest_cells(random_log)) if r[0] not in bad] and bad and rows(df)
    # one scan of cells, and one of the row tombstones that resolve them
    assert file_scans(df) == file_scans(latest_cells(random_log)) == 2
    plain = random_log.filter("op = 'put'")
    assert file_scans(FL.skip_rows(pred)(latest_cells(plain, version_deletes=False, row_deletes=False))) == 1


def test_skip_sends_a_hot_row_to_many_tasks(spark):
    cells = spark.range(100_000).select(F.lit("hot").alias("rowkey"), F.lit("cf").alias("family"), F.col("id").cast("string").alias("qualifier"),
                                        F.lit(1).cast("long").alias("ts"), F.lit(0).cast("long").alias("seq"), F.lit(b"v").alias("value"))
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = FL.skip_rows(F.col("value") == F.lit(b"v"))(cells).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in kept) == 100_000 and len(kept) >= 5
        assert FL.skip_rows(F.col("qualifier") != "77")(cells).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)


def test_while_match_in_one_resolution(random_log):
    live = latest_cells(random_log)
    for pred in (F.col("value") != F.lit(b"bad"), F.col("rowkey") < "r050", F.lit(True), F.lit(None).cast("boolean")):
        failing = [r.rowkey for r in live.filter(~F.coalesce(pred, F.lit(False))).collect()]
        df = FL.while_match(pred)(live)
        assert rows(df) == [r for r in rows(live) if not failing or r[0] < min(failing)]
    assert file_scans(FL.while_match(F.col("value") != F.lit(b"bad"))(live)) == file_scans(live) == 2
    plain = latest_cells(random_log.filter("op = 'put'"), version_deletes=False, row_deletes=False)
    assert file_scans(FL.while_match(F.col("value") != F.lit(b"bad"))(plain)) == 1


def test_while_match_by_key_reaches_the_scan(random_log):
    df = FL.while_match(F.col("rowkey") != "r050", by_key=True)(latest_cells(random_log))
    assert rows(df) == [r for r in rows(latest_cells(random_log)) if r[0] < "r050"]


def test_a_log_without_hot_rows_repeats_no_key(random_log):
    assert skew.hot_rows(random_log).count() == 0
    keys = random_log.select("rowkey").distinct()
    df = FL.rows_in(random_log, keys)
    assert df.count() == random_log.count() and df.columns == random_log.columns
    df.collect()
    for made in (n for n in nodes(df) if n.getClass().getSimpleName() == "GenerateExec" and "sequence" in n.toString()):
        assert made.metrics().apply("numOutputRows").value() == keys.count()
    resolved = latest_cells(random_log)
    resolved.collect()
    assert not [n for n in nodes(resolved) if n.getClass().getSimpleName() == "GenerateExec"]


def test_salts_follow_the_count(spark):
    log = spark.range(300_000).selectExpr("if(id < 250000, 'hot', string(id)) AS rowkey", "'cf' AS family", "string(id) AS qualifier",
                                          "1L AS ts", "0L AS seq", "'put' AS op", "binary('v') AS value")
    assert [tuple(r) for r in skew.hot_rows(log).collect()] == [("hot", -(-250_000 // skew.ROWS_PER_SALT))]


def test_row_marks_join_splits_a_hot_row_by_size(spark):
    hot = spark.range(200_000).selectExpr("if(id < 190000, 'hot', concat('r', id)) AS rowkey", "'cf' AS family", "string(id) AS qualifier",
                                          "1L AS ts", "0L AS seq", "'put' AS op", "binary(sha2(string(id), 512)) AS value")
    gone = spark.createDataFrame([("r199999", None, None, 5, 0, "del_row", None), ("hot", None, None, 0, 0, "del_row", None)], LOG_SCHEMA)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = latest_cells(hot.unionByName(gone)).groupBy(F.spark_partition_id()).agg(F.count("ts").alias("n"), F.max("value"))
        counts = [r["n"] for r in df.collect()]
        assert sum(counts) == 199_999 and max(counts) < 60_000
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_registered_filters_still_agree(spark):
    live = latest_cells(fx.customer_log(spark, SF))
    df = FL.skip_rows(~FL.value_matches("mach"))(live)
    assert df.columns == live.columns and df.count() > 0
