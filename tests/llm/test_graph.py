import random

from pyspark.sql import functions as F

from tessera.llm.graph import components, with_least

SPLIT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"}


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for x, y in edges:
        p, q = find(x), find(y)
        root[max(p, q)] = min(p, q)
    return {x: find(x) for x in root}


def test_components_of_paths_stars_and_loose_edges(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(500, 600 + i) for i in range(200)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    edges += [(7, 7), (500, 600), (600, 500), (-5, 3000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in brute([e for e in edges if e[0] != e[1]]).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_star_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    try:
        star = spark.range(1, 400_001, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).cast("long").alias("u"), F.xxhash64("id").alias("v"))
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        out = with_least(star, least)
        n = out.groupBy(F.pmod(F.xxhash64("u", "m", "v"), F.lit(1000)).alias("k")).count()
        assert sum(r["count"] for r in n.collect()) == 400_000
        assert "skew=true" in n._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
