"""Timestamp and number of a mutation batch."""

from __future__ import annotations

import threading
import time

from pyspark.sql import Column
from pyspark.sql import functions as F

_lock = threading.Lock()
_last = 0


def batch_ts() -> Column:
    """Batch timestamp (epoch micros at query start) for writes without an explicit ts."""
    return F.unix_micros(F.current_timestamp())


def batch_seq() -> int:
    """A number above that of every earlier batch of this writer (epoch micros, made to rise).

    It decides between puts of one cell at the same ts: the later batch wins.
    """
    global _last
    with _lock:
        _last = max(_last + 1, time.time_ns() // 1000)
        return _last


def put_ts(ts) -> Column:
    if ts is None:
        return batch_ts()
    return F.lit(ts).cast("bigint") if isinstance(ts, int) else ts.cast("bigint")


def put_seq(seq) -> Column:
    if seq is None:
        seq = batch_seq()
    return F.lit(seq).cast("bigint") if isinstance(seq, int) else seq.cast("bigint")
