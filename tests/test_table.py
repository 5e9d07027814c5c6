"""WideTable: write through a catalog, put, delete, read back."""

from pyspark.sql import functions as F

from tessera.model import Catalog
from tessera.session import scratch_path
from tessera.table import WideTable

CAT = Catalog.from_json('{"table":{"namespace":"default","name":"users"},"rowkey":"key","columns":{'
                        '"uid":{"cf":"rowkey","col":"key","type":"string"},'
                        '"sex":{"cf":"cf","col":"sex","type":"string"},'
                        '"age":{"cf":"cf","col":"age","type":"int"}}}')


def test_table_round_trip(spark):
    t = WideTable(spark, scratch_path(spark, "table"), CAT)
    assert t.read().count() == 0
    t.write(spark.createDataFrame([("lily", "female", 12), ("lucy", "female", 22), ("tom", "male", 30)],
                                  "uid string, sex string, age int"), ts=1)
    t.put_maps(spark.createDataFrame([("lily", {"cf:sex": "f"})], "rowkey string, cells map<string,string>"), ts=2)
    t.delete_rows(spark.createDataFrame([("tom",)], "rowkey string"), ts=3)
    t.delete_columns(spark.createDataFrame([("lucy", ["age"])], "rowkey string, columns array<string>"), "cf", ts=3)
    got = sorted(tuple(r) for r in t.read().collect())
    assert got == [("lily", "f", 12), ("lucy", "female", None)]
    t.delete_latest(spark.createDataFrame([("lily", "cf", "sex")], "rowkey string, family string, qualifier string"))
    assert t.read().filter(F.col("uid") == "lily").first().sex == "female"  # the older version resurfaces
    assert t.get(spark.createDataFrame([("lily",), ("nobody",)], "rowkey string")).select("rowkey").distinct().count() == 1
    cells = t.cells("l", "m")
    assert cells.select("rowkey").distinct().count() == 2


def test_table_schema_on_read(spark):
    t = WideTable(spark, scratch_path(spark, "table2"))
    t.put_columns(spark.createDataFrame([("lily", "female", 12)], "uid string, sex string, age int"), "uid", "cf", ts=1)
    d = t.decode([("", "ROWKEY"), ("sex", "String"), ("age", "Int"), ("missing", "Long")], family="cf")
    assert [tuple(r) for r in d.collect()] == [("lily", "female", 12, 0)]
