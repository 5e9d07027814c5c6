"""The index of cell counts behind kNN: equal results for every depth and salt, one exchange of points."""

import random

import pytest
from plan_tools import nodes, scans
from pyspark.sql import functions as F

from tessera.operators import knn as G
from tessera.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(7)
    rows = [(i, f"h{i}", rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(300)]
    rows += [(1000 + i, f"h{i}", 10.0 + rng.choice([0, 1e-9, 0.3]), 20.0 + rng.choice([0, 0.2])) for i in range(200)]  # a hot cell, many ties
    rows += [(2000, "edge", 180.0, 90.0), (2001, "edge", -180.0, -90.0), (2002, "none", None, 1.0)]
    return spark.createDataFrame(rows, "uid long, hash string, lon double, lat double")


@pytest.fixture(scope="module")
def queries(spark):
    rng = random.Random(8)
    rows = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(25)]
    rows += [(100, 10.0, 20.0), (101, 180.0, 90.0), (102, -180.0, -90.0), (103, 0.0, 0.0), (104, None, None)]
    return spark.createDataFrame(rows, "qid long, lon double, lat double")


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("n", [1, 5, 400])
def test_every_depth_and_salt_gives_the_same(points, queries, n):
    plain = rows(G.knn_geohash(points, queries, n=n, fine_precision=None))
    assert plain and max(r[1] for r in plain) <= n
    for deep, salt in ((2, 100_000), (4, 7)):
        assert rows(G.knn_geohash(points, queries, n=n, fine_precision=deep, salt_points=salt)) == plain


def test_own_cell_through_the_same_index(points, queries):
    plain = rows(G.cell_candidates(points, queries, 1, 5, fine_precision=None))
    assert plain and rows(G.cell_candidates(points, queries, 1, 5, fine_precision=3, salt_points=9)) == plain


def test_against_all_pairs(points, queries):
    block = {(r.qid, r.cx, r.cy) for r in G.query_blocks(queries.dropna(), 1).collect()}
    pts = [(r.uid, r.cell_x, r.cell_y, r.lon, r.lat) for r in G.with_cells(points.dropna(), 1).collect()]
    want = []
    for q in queries.dropna().collect():
        near = sorted((((p[3] - q.lon) ** 2 + (p[4] - q.lat) ** 2) ** 0.5, p[0]) for p in pts if (q.qid, p[1], p[2]) in block)
        want += [(q.qid, k + 1, uid) for k, (_, uid) in enumerate(near[:7])]
    assert [r[:3] for r in rows(G.knn_geohash(points, queries, n=7, fine_precision=3))] == sorted(want)


def test_points_are_exchanged_once_for_all_levels(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables too large to broadcast; hints of bounded frames stay
    try:
        for deep in (2, 4):
            df = G.knn_geohash(fx.locations(spark, SF), fx.query_points(spark, SF), fine_precision=deep)
            df.collect()
            parts = [s for s in scans(df) if "p_partkey" in s.toString()]
            moved = [n for n in nodes(df) if n.getClass().getSimpleName() == "ShuffleExchangeExec" and "uid" in n.toString().split("plan_id")[0].split("\n")[0]]
            exchanges = [n for n in nodes(df) if n.getClass().getSimpleName() == "ShuffleExchangeExec"
                         and {"uid", "hash", "salt"} <= {a.split("#")[0] for a in _names(n)} and "qid" not in _names(n)]
            assert len(parts) == 2 and len(exchanges) == 1, (len(parts), len(exchanges), len(moved))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def _names(node):
    out = node.output()
    return {out.apply(i).name() for i in range(out.size())}


def test_depth_follows_the_size_of_the_points(points, monkeypatch):
    assert G._finest(points, 1, "auto") == 2 and G._finest(points, 1, None) == 1 and G._finest(points, 2, 20) == 12
    for size, level in ((G.CELL_BYTES * 32 ** 2, 2), (G.CELL_BYTES * 32 ** 2 + G.CELL_BYTES, 3), (1 << 46, 6)):
        monkeypatch.setattr(G, "source_bytes", lambda df, s=size: s)
        assert G._finest(points, 1, "auto") == level


def test_empty_frames(points, queries):
    assert G.knn_geohash(points.limit(0), queries).count() == 0 and G.knn_geohash(points, queries.limit(0)).count() == 0
    assert G.knn_geohash(points.filter(F.col("uid") < 2), queries, n=3).count() > 0


@pytest.mark.parametrize("fine", ["auto", 2])
def test_dense_regions_and_repeated_places_meet_few_points(spark, fine):
    """Thousands of points in a corner of one coarse cell, forty at each place: a query meets tens of them, and the result is exact."""
    rng = random.Random(9)
    places = [(rng.uniform(3.0, 5.0), rng.uniform(3.0, 5.0)) for _ in range(400)]
    pts = [(uid, f"h{uid}", *places[uid % 400]) for uid in range(16_000)]
    asked = [(i, rng.uniform(3.0, 5.0), rng.uniform(3.0, 5.0)) for i in range(100)]
    df = G.knn_geohash(spark.createDataFrame(pts, "uid long, hash string, lon double, lat double"),
                       spark.createDataFrame(asked, "qid long, lon double, lat double"), n=50, fine_precision=fine)
    got = sorted((r.qid, r.rank, r.uid) for r in df.collect())
    want = []
    for qid, x, y in asked:
        near = sorted((((px - x) ** 2 + (py - y) ** 2) ** 0.5, uid) for uid, _, px, py in pts)[:50]
        want += [(qid, k + 1, uid) for k, (_, uid) in enumerate(near)]
    assert got == sorted(want)
    met = [n.metrics().apply("numOutputRows").value() for n in nodes(df) if "Join" in n.getClass().getSimpleName() and {"qid", "uid"} <= _names(n)]
    assert met and max(met) < 100 * 1000, met
