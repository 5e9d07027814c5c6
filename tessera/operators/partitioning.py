"""Partition counts from Catalyst's size estimate of a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

TARGET_BYTES = 128 << 20


def source_bytes(df: DataFrame) -> int:
    """Bytes of the plan's sources as far as the optimizer knows them (file sizes for scans); no job runs.

    A source of unknown size counts as nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 60)


def partitions_for(df: DataFrame, least: int, target_bytes: int = TARGET_BYTES) -> int:
    """At least ``least`` partitions, and enough for about ``target_bytes`` of the plan's sources each."""
    return max(least, -(-source_bytes(df) // target_bytes))
