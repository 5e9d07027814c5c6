"""Plan-shape checks on a stored log: pushdown, pruning, partial aggregation, no cross joins."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import filters as FL
from tessera.plans import fixtures as fx
from tessera.session import scratch_path
from tessera.sources import scan as S

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored_log(spark):
    path = scratch_path(spark, "plan-log")
    fx.orders_log(spark, SF).unionByName(fx.orders_tombstones(spark, SF)).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_range_scan_pushes_key_bounds(stored_log):
    p = plan(S.raw_scan(stored_log, "0000001000", "0000002000"))
    assert "GreaterThanOrEqual(rowkey,0000001000), LessThan(rowkey,0000002000)" in p


def test_prefix_filter_after_resolution_reaches_scan(stored_log):
    from tessera.operators.versions import latest_cells

    p = plan(FL.by_row_prefix("00000012")(latest_cells(stored_log)))
    assert "StringStartsWith(rowkey,00000012)" in p


def test_column_scan_prunes_and_aggregates_partially(stored_log):
    p = plan(S.scan_column(stored_log, "cf", "status"))
    assert "EqualTo(qualifier,status)" in p
    assert "partial_max_by" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_while_match_uses_scalar_subquery(stored_log):
    from tessera.operators.versions import latest_cells

    p = plan(FL.while_match(F.col("rowkey") != "0000000100")(latest_cells(stored_log)))
    assert "Subquery" in p and "CartesianProduct" not in p and "NestedLoop" not in p


def test_wide_catalog_table_pushes_compound_filter(spark):
    from tessera.sources import catalog as C

    path = scratch_path(spark, "plan-wide")
    C.write_wide(fx.ORDERS_CATALOG, fx.orders_wide(spark, SF), path, regions=5)
    df = C.read_wide(fx.ORDERS_CATALOG, spark.read.parquet(path))
    pk = F.col("pk")
    q = df.filter(((pk >= "0000000100") & (pk < "0000000200")) & (F.col("status") == "O")).select("pk", "totalprice")
    p = plan(q)
    assert "GreaterThanOrEqual(pk,0000000100)" in p and "EqualTo(status,O)" in p
    assert "ReadSchema: struct<pk:string,status:string,totalprice:double>" in p


def test_long_ids_keep_their_row(spark):
    path = scratch_path(spark, "long-ids")
    ids = [150000, 1500000, 15000000, 7]
    rows = [(i, 1.0, f"c{i}", "S", 3) for i in ids]
    spark.createDataFrame(rows, "c_custkey long, c_acctbal double, c_name string, c_mktsegment string, c_nationkey int").write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(i, f"p{i}", "b") for i in ids], "p_partkey long, p_name string, p_brand string").write.parquet(f"{path}/part.parquet")
    want = {"150000", "1500000", "15000000", "000007"}
    from tessera.operators.versions import latest_cells

    cells = latest_cells(fx.customer_log(spark, path))
    assert {r[0] for r in cells.select("rowkey").collect()} == want and cells.where("qualifier = 'name'").count() == len(ids)
    assert {r[0].split(",")[0] for r in fx.text_put_lines(spark, path).collect()} == want
    long = spark.createDataFrame([(10 ** 10,), (10 ** 11,)], "o long")
    assert {r[0] for r in long.select(fx.order_key("o")).collect()} == {str(10 ** 10), str(10 ** 11)}
