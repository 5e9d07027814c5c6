"""Plan properties of every registered query: no cross products, Python only where asked for."""

import pytest

import __spark_entry__ as entry
from tessera.plans import registry

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroupsInPandas")
PYTHON_ALLOWED = {"scan_mapped_arrow"}


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def plans(spark):
    return {name: formatted(fn(spark, SF)) for name, fn in entry.queries().items() if name in registry.queries()}


def test_no_cross_products(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "NestedLoopJoin" in p]
    assert bad == []


def test_python_only_where_asked(plans):
    with_python = {n for n, p in plans.items() if any(node in p for node in PYTHON_NODES)}
    assert with_python == PYTHON_ALLOWED


def test_latest_cells_is_one_shuffle(plans):
    p = plans["latest_cells"]
    assert p.count("Arguments: hashpartitioning") == 1
    assert "partial_max_by" in p


def test_knn_limits_before_the_shuffle(spark):
    """The shape on tables too large to broadcast: candidates are cut to n a query before they are shuffled."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        p = formatted(entry.queries()["knn_geohash"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "WindowGroupLimit" in p and "Partial" in p
