"""S14 as a file stream: new ``rowkey,qualifier,value`` files become log appends.

The reference loads text puts in batch only; the same parse runs here on a
Structured Streaming file source, so a folder that keeps receiving files is
ingested incrementally.  ``foreachBatch`` may run a micro-batch again after a
failure, so each one is written to a folder of its own number with mode
``overwrite``, with a ts that is fixed when the batch is first planned: a replay
replaces the same rows and never wins over later writes.  Readers take the
log's folder with its ``batch=`` subfolders as one table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.model import LOG_COLUMNS
from tessera.session import ensure_checkpoint_dir
from tessera.sources.text import parse_text_puts


def batch_time(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Epoch micros of a micro-batch: when the stream recorded its offsets, which a replay does not change."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets/{batch_id}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(path).getModificationTime() * 1000


def checkpoint_of(spark: SparkSession, name: str) -> str:
    """The stream's own folder under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "streams", name)


def batch_writer(spark: SparkSession, log_path: str, rejects_path: str, family: str, checkpoint: str):
    """The ``foreachBatch`` function: one folder per batch number, replaced as a whole by a replay."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        puts, rejects = parse_text_puts(batch, family, ts=batch_time(spark, checkpoint, batch_id), seq=batch_id)
        puts.select(*LOG_COLUMNS).write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/batch={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/batch={batch_id}")
    return write_batch


def start_text_put_stream(spark: SparkSession, input_dir: str, log_path: str, rejects_path: str, family: str,
                          *, name: str = "text-puts", available_now: bool = False,
                          max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start the ingest; each put gets the micro-batch id as ``seq`` and the batch's fixed time as ``ts``."""
    checkpoint = checkpoint_of(spark, name)
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(input_dir)
    write_batch = batch_writer(spark, log_path, rejects_path, family, checkpoint)
    writer = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
