"""Session helpers: defaults for local runs, shared checkpoint folder lookup."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  AQE re-plans joins at runtime
# (size-checked broadcast, skew-join splitting, partition coalescing).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The session's setting comes first, then a folder set by
    ``SparkContext.setCheckpointDir``, which stays as it is.  With neither, a
    local session (one JVM, as in tests) gets a scratch folder; on a cluster
    that is an error, because a folder of the driver's machine is not shared.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    set_already = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not current and set_already.isDefined():
        return set_already.get()
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not set_already.isDefined():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for staged writes."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tessera-stage", f"{name}-{uuid.uuid4().hex}")
