"""Row-key builders as expressions, and the parts of logs that are laid out by key."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def salted_key(uid: Column | str, width: int = 3) -> Column:
    """First ``width`` hex digits of md5(uid) + uid: spreads sequential ids over key ranges."""
    c = F.col(uid) if isinstance(uid, str) else uid
    return F.concat(F.substring(F.md5(c.cast("string")), 1, width), c.cast("string"))


def unique_key() -> Column:
    """A unique key per row for key-less data (random UUID, generated in the executors)."""
    return F.expr("uuid()")


def time_ordered_key(ts: Column | str, *row: Column | str) -> Column:
    """Reproducible, time-ordered key: ``yyyyMMddHHmmssSSS_`` + md5 of the row's values.

    Each value is written as its length and text, NULL as ``-``, so different rows have different digests; rows
    equal in all ``row`` columns share a key (and overwrite each other), so include a unique column where there is one.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    cols = [F.col(c) if isinstance(c, str) else c for c in row]
    return F.concat(F.date_format(t, "yyyyMMddHHmmssSSS"), F.lit("_"), F.md5(F.concat(*[_field(c.cast("string")) for c in cols])))


def _field(text: Column) -> Column:
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


MAX_KEY_PARTS = 1 << 16
_PART = re.compile(r"key_part_of_(\d+)")


def part_column(parts: int) -> str:
    """Name of the partition column of a log laid out by key in ``parts`` parts; the name carries their number."""
    if not 0 < parts <= MAX_KEY_PARTS:
        raise ValueError(f"a log is laid out in 1 to {MAX_KEY_PARTS} key parts, not {parts}")
    return f"key_part_of_{parts}"


def part_of(key: Column | str, parts: int) -> Column:
    """The part of a row key: the residue of its hash."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def key_parts(columns: Iterable[str]) -> int | None:
    """The number of parts of a log with these columns; None where it is not laid out by key."""
    found = [int(m[1]) for m in map(_PART.fullmatch, columns) if m]
    return found[0] if found else None
