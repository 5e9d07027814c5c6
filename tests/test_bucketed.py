"""Logs bucketed by cell."""

import uuid

import pytest
from plan_tools import count, nodes
from pyspark.sql import functions as F

from tessera.model import LOG_SCHEMA
from tessera.operators.versions import latest_cells, resolve_cells
from tessera.plans import registry
from tessera.session import scratch_path
from tessera.sources import bucketed as B

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark):
    return registry.orders_with_tombstones(spark, SF)


@pytest.fixture()
def loaded(spark, log, request):
    name, path = f"t_{uuid.uuid4().hex[:8]}", scratch_path(spark, "bucketed-test")
    B.bulk_load_bucketed(log, name, path, 8, **getattr(request, "param", {}))
    yield name, path
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_cells_take_no_exchange(spark, log, loaded):
    cells = resolve_cells(spark.table(loaded[0]))
    assert rows(cells) and count(cells, "ShuffleExchangeExec") == 0
    cells.collect()
    assert count(cells, "ShuffleExchangeExec") == 0 and any("Bucketed: true" in n.toString() for n in nodes(cells))
    assert rows(B.latest_cells_bucketed(spark, *loaded)) == rows(latest_cells(log))


def test_files_of_one_bucket_each_keep_their_order(spark, loaded):
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    try:
        cells = resolve_cells(spark.table(loaded[0]).filter("op = 'put'"), version_deletes=False)
        assert rows(cells)
        cells.collect()
        assert count(cells, "SortExec") == 0 and count(cells, "ShuffleExchangeExec") == 0
    finally:
        spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")


@pytest.mark.parametrize("loaded", [{"hot_versions": 3}], indirect=True)
def test_hot_cells_lie_beside_the_table(spark, loaded):
    versions = spark.range(5000).selectExpr("if(id < 2000, 'hot', string(id)) AS rowkey", "'cf' AS family", "'q' AS qualifier", "id AS ts", "0L AS seq",
                                            "'put' AS op", "binary(string(id)) AS value")
    gone = spark.createDataFrame([("hot", "cf", "q", 1999, 0, "del_version", None), ("4000", None, None, 9000, 0, "del_row", None)], LOG_SCHEMA)
    both = versions.unionByName(gone)
    name, path = f"t_{uuid.uuid4().hex[:8]}", scratch_path(spark, "bucketed-hot")
    B.bulk_load_bucketed(both, name, path, 4, hot_versions=100)
    assert spark.read.parquet(f"{path}/hot").select("rowkey").distinct().collect()[0].rowkey == "hot"
    assert spark.table(name).filter("rowkey = 'hot'").count() == 0
    got = B.latest_cells_bucketed(spark, name, path)
    assert rows(got) == rows(latest_cells(both)) and got.filter("rowkey = 'hot'").first().ts == 1998
    spark.sql(f"DROP TABLE {name}")
    B.attach(spark, name, path, 4)  # another session finds the same files
    assert rows(B.latest_cells_bucketed(spark, name, path)) == rows(latest_cells(both))
    assert count(resolve_cells(spark.table(name)), "ShuffleExchangeExec") == 0
    spark.sql(f"DROP TABLE {name}")


def test_empty_log_and_clashing_names(spark, log):
    name, path = f"t_{uuid.uuid4().hex[:8]}", scratch_path(spark, "bucketed-empty")
    B.bulk_load_bucketed(log.limit(0).withColumn("__cell", F.lit(1)), name, path, 2)
    assert B.latest_cells_bucketed(spark, name, path).count() == 0
    spark.sql(f"DROP TABLE {name}")
