"""The text-put stream ingests a folder of files exactly once per file."""

import os
import tempfile

from tessera.operators.versions import latest_cells
from tessera.streaming.text_puts import start_text_put_stream


def test_text_put_stream(spark):
    base = tempfile.mkdtemp(prefix="tessera-stream-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("k1,name,alpha\nk2,name\nk3,name,gamma,extra\n")
    q = start_text_put_stream(spark, src, os.path.join(base, "log"), os.path.join(base, "rejects"), "cf",
                              name="t1-" + os.path.basename(base), available_now=True)
    q.awaitTermination(120)
    log = spark.read.parquet(os.path.join(base, "log"))
    live = sorted((r.rowkey, r.value.decode()) for r in latest_cells(log).collect())
    assert live == [("k1", "alpha"), ("k3", "gamma")]
    assert [r.line for r in spark.read.parquet(os.path.join(base, "rejects")).collect()] == ["k2,name"]


def test_text_put_stream_restart_is_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="tessera-stream-")
    src, log_path, rej = os.path.join(base, "in"), os.path.join(base, "log"), os.path.join(base, "rejects")
    os.makedirs(src)
    name = "t2-" + os.path.basename(base)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("k1,name,v1\n")
    start_text_put_stream(spark, src, log_path, rej, "cf", name=name, available_now=True).awaitTermination(120)
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("k1,name,v2\nk2,name,w\n")
    # a restarted query with the same checkpoint picks up only the new file
    start_text_put_stream(spark, src, log_path, rej, "cf", name=name, available_now=True).awaitTermination(120)
    log = spark.read.parquet(log_path)
    assert log.count() == 3
    live = sorted((r.rowkey, r.value.decode()) for r in latest_cells(log).collect())
    assert live == [("k1", "v2"), ("k2", "w")]
