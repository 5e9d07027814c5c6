"""F17 over logs (byte comparisons) and the order of text lines."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.codec import decode, encode
from tessera.functions.predicates import compare_bytes
from tessera.plans import fixtures as fx
from tessera.plans import registry
from tessera.session import scratch_path
from tessera.sources import catalog as C
from tessera.sources import text as TX

SF = "/root/testdata/sf0.001"
NUMBERS = {"short": ("smallint", [-32768, -300, -1, 0, 1, 255, 256, 32767]),
           "int": ("int", [-2**31, -70000, -1, 0, 1, 70000, 2**31 - 1]),
           "long": ("bigint", [-2**63, -2**40, -1, 0, 1, 2**40, 2**63 - 1]),
           "float": ("float", [-math.inf, -1.5, -1.0, -1e-45, -0.0, 0.0, 1e-45, 1.0, 1.5, math.inf, math.nan]),
           "double": ("double", [-math.inf, -1e300, -1.5, -5e-324, -0.0, 0.0, 5e-324, 1.5, 1e300, math.inf, math.nan]),
           "string": ("string", ["", "a", "ab", "b", "é", "日本", "\U0001F642"])}


@pytest.mark.parametrize("kind", sorted(NUMBERS))
def test_bytes_compare_as_values(spark, kind):
    spark_type, values = NUMBERS[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"v {spark_type}").withColumn("b", encode("v", kind))
    checks = []
    for literal in values:
        lit = F.lit(literal).cast(spark_type)
        for op, want in (("=", F.col("v") == lit), ("<", F.col("v") < lit), ("<=", F.col("v") <= lit), (">", F.col("v") > lit), (">=", F.col("v") >= lit)):
            got = compare_bytes(F.col("b"), kind, op, literal)
            checks.append(F.coalesce(want, F.lit(False)) == F.coalesce(got, F.lit(False)))
    assert all(all(r) for r in df.select(*[c.alias(f"c{i}") for i, c in enumerate(checks)]).collect())


def test_refused_comparisons():
    for args in (("int", "<>", 1), ("boolean", "<", True), ("nothing", "=", 1)):
        with pytest.raises(ValueError):
            compare_bytes(F.col("b"), *args)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_compound_filter_equals_filter_after_decoding(spark):
    log = registry.orders_with_tombstones(spark, SF)
    decoded = C.read_log_table(fx.ORDERS_CATALOG, log)
    rng = random.Random(3)
    for _ in range(3):
        a = rng.randrange(1000)
        ranges, points = [(f"{a:010d}", f"{a + 400:010d}"), ("0000001400", None)], ["0000000003", "nobody"]
        where = [("status", "=", rng.choice("OFP")), ("totalprice", rng.choice(["<", ">="]), 150000.0), ("custkey", ">", rng.randrange(100))]
        cond = C.key_condition(ranges, points)
        want = decoded.withColumnRenamed("pk", "rowkey").filter(cond).withColumnRenamed("rowkey", "pk")
        for name, op, literal in where:
            want = want.filter(f"{name} {op} {literal!r}")
        assert rows(C.filter_log_table(fx.ORDERS_CATALOG, log, where, ranges=ranges, points=points)) == rows(want)
    assert rows(C.filter_log_table(fx.ORDERS_CATALOG, log)) == rows(decoded)
    with pytest.raises(ValueError):
        C.filter_log_table(fx.ORDERS_CATALOG, log, [("pk", "=", "1")])


def test_keys_reach_the_scan_and_nothing_is_decoded_for_the_test(spark):
    log = fx.stored(fx.orders_log(spark, SF), "compound-log")
    df = C.filter_log_table(fx.ORDERS_CATALOG, log, [("totalprice", ">", 1.0)], ranges=[("0000000100", "0000000200")], points=["0000000500"])
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert plan.count("PushedFilters: [Or(") + plan.count("PushedFilters: [IsNotNull(op), Or(") + plan.count("Or(EqualTo(rowkey,0000000500),And(GreaterThanOrEqual(rowkey,0000000100)") >= 2


def test_the_last_line_wins_over_any_split_size(spark):
    path = scratch_path(spark, "lines")
    lines = spark.range(30_000).selectExpr("concat('k', id % 500, ',q,', lpad(id, 8, '0'))").coalesce(1)
    lines.write.text(path)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("128m", "37k", "5k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1k")
            puts, rejects = TX.load_text_puts(spark, path, "cf", ts=1, seq=0)
            got = {r.rowkey: r.v for r in puts.select("rowkey", decode("value", "string").alias("v")).collect()}
            assert got == {f"k{k}": f"{29_500 + k:08d}" for k in range(500)} and rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was[0])
        spark.conf.set("spark.sql.files.openCostInBytes", was[1])


def test_files_in_order_of_path(spark):
    a, b = scratch_path(spark, "a-lines"), scratch_path(spark, "b-lines")
    for path, text in ((a, "first"), (b, "second")):
        spark.createDataFrame([(f"k,q,{text}",), ("short,line",)], "v string").coalesce(1).write.text(path)
    puts, rejects = TX.load_text_puts(spark, f"{b},{a}", "cf")
    assert [bytes(r.value) for r in puts.collect()] == [b"second"] and rejects.count() == 2


def test_registered(spark):
    assert registry.queries()["load_text_last_line"](spark, SF).count() == 200
