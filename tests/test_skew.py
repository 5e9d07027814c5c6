"""Hot keys: one row holding most cells, one cell holding every point."""

from pyspark.sql import functions as F

from tessera.operators import filters as FL
from tessera.operators import knn as G
from tessera.operators import shape as P
from tessera.operators.versions import latest_cells

N = 120000


def hot_log(spark):
    """Row 'hot' has N cells; 1,000 other rows have 2 cells each."""
    hot = spark.range(N).select(
        F.lit("hot").alias("rowkey"), F.lit("cf").alias("family"),
        F.format_string("q%06d", F.col("id")).alias("qualifier"), F.lit(1).cast("bigint").alias("ts"),
        F.lit(0).cast("bigint").alias("seq"), F.lit("put").alias("op"),
        F.col("id").cast("string").cast("binary").alias("value"))
    cold = spark.range(2000).select(
        F.format_string("r%04d", (F.col("id") / 2).cast("int")).alias("rowkey"), F.lit("cf").alias("family"),
        F.format_string("q%06d", F.col("id") % 2).alias("qualifier"), F.lit(1).cast("bigint").alias("ts"),
        F.lit(0).cast("bigint").alias("seq"), F.lit("put").alias("op"), F.lit(b"x").alias("value"))
    return hot.unionByName(cold)


def test_hot_row_operators(spark):
    cells = latest_cells(hot_log(spark))
    assert cells.count() == N + 2000
    d = P.decode_columns(cells, [("q000000", "string"), ("q000001", "string"), ("q119999", "string")],
                         family="cf", with_key=True)
    hot = d.filter(F.col("ROWKEY") == "hot").first()
    assert (hot.q000000, hot.q000001, hot.q119999) == ("0", "1", "119999")
    assert FL.first_cell(cells).filter(F.col("rowkey") == "hot").first().qualifier == "q000000"
    assert FL.column_count(3)(cells).filter(F.col("rowkey") == "hot").count() == 3
    kept = FL.skip_rows(F.col("value") != F.lit(b"x"))(cells).select("rowkey").distinct().collect()
    assert [r.rowkey for r in kept] == ["hot"]


def test_knn_single_hot_cell(spark):
    # every point in one precision-1 cell; the salted join spreads it over 16 keys
    pts = spark.range(50000).select(
        F.col("id").alias("uid"), (F.lit(10.0) + (F.col("id") % 1000) / 100.0).alias("lon"),
        (F.lit(10.0) + (F.col("id") / 1000).cast("int") / 100.0).alias("lat")).withColumn(
        "hash", F.col("uid").cast("string"))
    qs = spark.range(20).select(F.col("id").alias("qid"), (F.lit(12.0) + F.col("id") / 10.0).alias("lon"),
                                F.lit(10.2).alias("lat"))
    out = G.knn_geohash(pts, qs, n=3, precision=1)
    rows = out.collect()
    assert len(rows) == 60
    best = {r.qid: r for r in rows if r.rank == 1}
    # query 0 sits exactly on point (12.0, 10.2): uid = 20 * 1000 + 200
    assert best[0].uid == 20200 and best[0].distance == 0.0


def test_hot_row_with_row_tombstones(spark):
    from tessera.model import LOG_SCHEMA

    tombs = spark.createDataFrame([("hot", None, None, 0, 0, "del_row", None),    # older than the hot row's puts
                                   ("r0001", None, None, 5, 0, "del_row", None)], LOG_SCHEMA)
    cells = latest_cells(hot_log(spark).unionByName(tombs))
    assert cells.filter(F.col("rowkey") == "hot").count() == N
    assert cells.filter(F.col("rowkey") == "r0001").count() == 0
    assert FL.first_cell(cells).count() == 1000   # hot + 999 cold rows
