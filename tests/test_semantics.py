"""Results off the tidy path: names, lengths, ties, missing columns, edges of the map, hot rows, replays."""

import math
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.functions.codec import decode, encode
from tessera.functions.keys import time_ordered_key
from tessera.model import LOG_SCHEMA
from tessera.operators import filters as FL
from tessera.operators import knn as G
from tessera.operators import mutate as W
from tessera.operators import shape as P
from tessera.operators.versions import latest_cells
from tessera.plans import fixtures as fx
from tessera.session import scratch_path
from tessera.sources import scan as S
from tessera.sources import text as TX
from tessera.table import WideTable

SF = "/root/testdata/sf0.001"
CELLS = "rowkey string, cells array<struct<family:string,qualifier:string,value:string>>"


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def stored_log(spark):
    return fx.stored(fx.orders_log(spark, SF).unionByName(fx.orders_tombstones(spark, SF)), "semantics-log")


# ------------------------------------------------------------------ values and names
def test_column_names_are_names(spark):
    df = spark.createDataFrame([("k", 1.0, 7.0, "x")], ["rowkey", "a", "a*2", "net price"])
    live = latest_cells(W.upsert_family(df, "rowkey", "cf", ts=1))
    got = P.decode_columns(live, [("a", "double"), ("a*2", "double"), ("net price", "string")], family="cf").first()
    assert tuple(got) == (1.0, 7.0, "x")
    view = P.typed_view(live, {"a": "double", "a*2": "double", "it's": "long"})
    assert sorted((r.qualifier, r.n_val) for r in view.collect()) == [("a", 1.0), ("a*2", 7.0), ("net price", None)]


def test_wrong_length_is_an_error(spark):
    df = spark.createDataFrame([(bytearray(b"\0\0\0\0\0\0\x0c"),), (None,)], "b binary")
    for kind in ("int", "long", "short", "double", "float", "boolean"):
        assert df.filter("b is null").select(decode("b", kind)).first()[0] is None
        with pytest.raises(Exception, match="bytes instead of"):
            df.select(decode("b", kind)).collect()
    with pytest.raises(TypeError):
        encode(F.col("b"), "string")


def test_maps_of_mixed_types(spark):
    data = spark.createDataFrame([("k", {"cf:n": "12", "cf:x": "2.5", "cf:s": "7"})], "rowkey string, cells map<string,string>")
    live = latest_cells(W.upsert_cf_map(data, ts=1, types={"cf:n": "int", "cf:x": "double"}))
    got = P.decode_columns(live, [("n", "int"), ("x", "double"), ("s", "string")], family="cf").first()
    assert tuple(got) == (12, 2.5, "7")


def test_rows_without_the_columns_are_rows_of_defaults(spark):
    data = spark.createDataFrame([("a", {"cf:x": "1"}), ("b", {"cf:y": "2"})], "rowkey string, cells map<string,string>")
    log = W.upsert_cf_map(data, ts=1)
    want = [("a", "1"), ("b", "")]
    assert sorted(map(tuple, P.decode_log(log, [("x", "string")], family="cf", with_key=True).collect())) == want
    assert sorted(map(tuple, P.decode_columns(latest_cells(log), [("x", "string")], family="cf", with_key=True).collect())) == want
    by_map = P.decode_map(P.rows_to_map(latest_cells(log)), [("x", "string")], with_key=True)
    assert sorted(map(tuple, by_map.collect())) == want
    assert S.scan_columns(log, "cf", [("x", "string")]).count() == 1


def test_ordered_keys_tell_rows_apart(spark):
    rows = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "", "b"), ("a1:", "b", None)], "x string, y string, z string")
    keys = rows.select(time_ordered_key(F.lit("2024-01-01").cast("timestamp"), "x", "y", "z").alias("k"))
    assert keys.distinct().count() == 4


# ------------------------------------------------------------------ ties and samples
def test_the_later_batch_wins_at_one_ts(spark):
    table = WideTable(spark, scratch_path(spark, "ties"))
    for text in ("first", "second", "third"):
        data = spark.createDataFrame([(str(i), [("cf", "q", text)]) for i in range(50)], CELLS)
        table.apply(W.bulk_put_with_timestamp(data, 5))
    assert {r.value for r in table.cells().collect()} == {b"third"}


def test_a_text_load_beats_older_puts(spark):
    old = W.bulk_put(spark.createDataFrame([("k", [("cf", "q", "old")])], CELLS), ts=1000)
    puts, _ = TX.parse_text_puts(spark.createDataFrame([("k,q,new",)], "value string"), "cf")
    assert W.apply_batch(old, puts).first().value == b"new"


def test_random_rows(spark):
    cells = spark.range(2000).select(F.col("id").cast("string").alias("rowkey"))
    for exact in (True, False):
        assert FL.random_rows(1.0, deterministic=exact)(cells).count() == 2000
        assert FL.random_rows(0.0, deterministic=exact)(cells).count() == 0
        assert 800 < FL.random_rows(0.5, seed=1, deterministic=exact)(cells).count() < 1200
    pick = lambda f: {r.rowkey for r in f(cells).collect()}
    assert pick(FL.random_rows(0.5, seed=3)) == pick(FL.random_rows(0.5, seed=3))
    assert pick(FL.random_rows(0.5)) != pick(FL.random_rows(0.5))


# ------------------------------------------------------------------ kNN at the edges of the map
@pytest.mark.parametrize("precision,fine", [(1, None), (1, "auto"), (1, 2), (2, "auto"), (2, 5)])
def test_knn_at_the_antimeridian_and_the_poles(spark, precision, fine):
    pts = [(i, (180 - (i % 37) / 40) * (1 if i % 2 else -1), (90 - (i % 23) / 30) * (1 if i % 3 else -1)) for i in range(900)]
    pts += [(900 + i, -180 + i * 36.1 % 360, -90 + i * 17.3 % 180) for i in range(150)]
    queries = [(0, 179.9, 0.5), (1, -179.9, 89.9), (2, 179.95, -89.95), (3, 0.0, 90.0), (4, -180.0, -90.0), (5, 180.0, 90.0), (6, 12.0, 5.0)]
    lon_bits, lat_bits = G.bits_for(precision)

    def cell(lon, lat):
        return (min(int((lon + 180) / 360 * (1 << lon_bits)), (1 << lon_bits) - 1), min(int((lat + 90) / 180 * (1 << lat_bits)), (1 << lat_bits) - 1))

    want = []
    for qid, x, y in queries:
        cx, cy = cell(x, y)
        block = {((cx + a) % (1 << lon_bits), (cy + b) % (1 << lat_bits)) for a in (-1, 0, 1) for b in (-1, 0, 1)}
        near = sorted((math.sqrt((px - x) ** 2 + (py - y) ** 2), u) for u, px, py in pts if cell(px, py) in block)[:5]
        want += [(qid, i + 1, u) for i, (_, u) in enumerate(near)]
    p = spark.createDataFrame(pts, "uid long, lon double, lat double").withColumn("hash", F.col("uid").cast("string"))
    q = spark.createDataFrame(queries, "qid long, lon double, lat double")
    got = G.knn_geohash(p, q, n=5, precision=precision, fine_precision=fine).select("qid", "rank", "uid").collect()
    assert sorted(map(tuple, got)) == want


# ------------------------------------------------------------------ plans
def test_building_a_plan_runs_no_job(spark, stored_log):
    keys = spark.createDataFrame([("0000000001",)], "rowkey string")
    pts, queries = fx.locations(spark, SF), fx.query_points(spark, SF)  # opening a Parquet file reads its schema
    sc = spark.sparkContext
    sc.setJobGroup("building", "building")
    try:
        S.raw_scan(stored_log, "0", "1")
        S.bulk_get(stored_log, keys)
        S.get_value(stored_log, keys, "cf", "status")
        S.scan_rows_where_column(stored_log, "cf", "status", F.col("value") == F.lit(b"F"))
        P.decode_log(stored_log, fx.ORDERS_COLUMNS, family="cf")
        FL.by_row_value("0000000001")(latest_cells(stored_log))
        FL.skip_rows(FL.value_matches("x"))(latest_cells(stored_log))
        W.delete_range(stored_log, "0", "1")
        G.knn_geohash(pts, queries)
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_key_only_reads_no_values(stored_log):
    for df in (S.scan_keys(stored_log), S.scan_count(stored_log), S.scan_key_only(stored_log), W.delete_range(stored_log, "0", "1")):
        assert "value:binary" not in plan(df)
    assert {len(r.value) for r in S.scan_key_only(stored_log).collect()} == {0}


def test_a_hot_row_is_joined_by_many_tasks(spark):
    hot = spark.range(400_000).select(
        F.lit("hot").alias("rowkey"), F.lit("cf").alias("family"), F.col("id").cast("string").alias("qualifier"), F.lit(1).cast("long").alias("ts"),
        F.lit(0).cast("long").alias("seq"), F.lit("put").alias("op"), F.lit(b"v").alias("value"))
    keys = spark.createDataFrame([("hot",), ("cold",)], "rowkey string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = FL.rows_in(hot, keys).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in rows) == 400_000 and len(rows) >= 8 and max(r["count"] for r in rows) < 150_000
        assert S.bulk_get(hot, keys).count() == 400_000
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


# ------------------------------------------------------------------ writes and sessions
def test_a_hot_row_spans_files_and_staging_is_moved(spark):
    stage, target = scratch_path(spark, "hot-stage"), scratch_path(spark, "hot-table")
    rows = spark.range(44_000).select(
        F.when(F.col("id") < 40_000, "hot").otherwise(F.col("id").cast("string")).alias("rowkey"), F.lit("cf").alias("family"),
        F.format_string("q%06d", F.col("id")).alias("qualifier"), F.lit(1).cast("long").alias("ts"), F.lit(0).cast("long").alias("seq"),
        F.lit("put").alias("op"), F.lit(b"v").alias("value"))
    W.bulk_load(rows, stage, 8)
    files = sorted(f for f in os.listdir(stage.removeprefix("file:")) if f.endswith(".parquet"))
    spans = [spark.read.parquet(f"{stage}/{f}").agg(F.min(F.struct("rowkey", "family", "qualifier")), F.max(F.struct("rowkey", "family", "qualifier"))).first() for f in files]
    assert len(files) == 8 and sum(a.rowkey <= "hot" <= b.rowkey for a, b in spans) >= 6
    assert all(tuple(x[1]) < tuple(y[0]) for x, y in zip(spans, spans[1:]))
    W.load_staged(spark, stage, target)
    assert not os.path.exists(stage.removeprefix("file:")) and spark.read.parquet(target).count() == 44_000


class _Session:
    """Just what the folder lookup asks of a session."""

    def __init__(self, master, conf=None, set_already=None):
        outer = self
        self.made = None

        class Option:
            def isDefined(self):
                return set_already is not None

            def get(self):
                return set_already

        class Context:
            def __init__(self):
                self.master = master
                self._jsc = self

            def sc(self):
                return self

            def getCheckpointDir(self):
                return Option()

            def setCheckpointDir(self, d):
                outer.made = d

        class Conf(dict):
            def set(self, k, v):
                self[k] = v

        self.sparkContext, self.conf = Context(), Conf({"spark.checkpoint.dir": conf} if conf else {})


def test_the_checkpoint_folder(tmp_path):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session("yarn"))
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(_Session("local-cluster[2,1,1024]"))
    kept = _Session("yarn", set_already="hdfs://x/own")
    assert session.ensure_checkpoint_dir(kept) == "hdfs://x/own" and kept.made is None
    both = _Session("yarn", conf="hdfs://x/conf", set_already="hdfs://x/own")
    assert session.ensure_checkpoint_dir(both) == "hdfs://x/conf" and both.made is None
    assert session.ensure_checkpoint_dir(_Session("local[4]")).startswith("/")


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    """The sink's own write, run twice for one batch number, as after a failure between write and commit."""
    from tessera.streaming import text_puts as T

    src, log, rejects = (str(tmp_path / d) for d in ("in", "log", "rejects"))
    os.makedirs(src)
    (tmp_path / "in" / "a.txt").write_text("k1,name,v1\nbad\n")
    caught = []
    name = f"replay-{uuid.uuid4().hex}"  # the checkpoint folder may outlive a run of the tests
    writer = T.batch_writer(spark, log, rejects, "cf", T.checkpoint_of(spark, name))

    def twice(batch, batch_id):
        writer(batch, batch_id)
        caught.append(sorted(map(tuple, spark.read.parquet(log).collect())))
        writer(batch, batch_id)

    lines = spark.readStream.text(src)
    q = lines.writeStream.foreachBatch(twice).option("checkpointLocation", T.checkpoint_of(spark, name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.read.parquet(log).collect())) == caught[0] and len(caught[0]) == 1
    assert spark.read.parquet(rejects).count() == 1
