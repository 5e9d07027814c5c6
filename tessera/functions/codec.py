"""Byte codecs for cell values as pure Catalyst expressions.

Layouts are the big-endian ones of the wide-column store: String = UTF-8,
Int = 4 bytes, Long = 8 bytes, Short = 2 bytes, Double / Float = IEEE-754
bits, Boolean = one byte (``FF`` / ``00``; any non-zero byte reads as true).

Everything is built from built-in functions (``hex``/``unhex``/``conv``,
shifts, ``pow``/``log2``), so encode and decode stay inside whole-stage
codegen, are deterministic (usable in aggregates and filters) and need no
Python worker.  IEEE bits are derived arithmetically: ``pow(2, k)`` is exact
for integral ``k`` and scaling by a power of two is exact, so the bit
patterns are exact, ``-0.0`` and subnormals included.

The expressions are written as SQL text and parsed once by Spark
(``F.expr``): the same Catalyst tree as chained ``functions`` calls, built
with one call instead of hundreds of Python-to-JVM round trips.  ``encode``
and ``decode`` take column names, always quoted; ``encode_sql`` and
``decode_sql`` take SQL text.  Bytes of the wrong length for a fixed-length
type raise an error instead of becoming another number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.model import SPARK_TYPES, normalize_type


def col_ref(name: str) -> str:
    """SQL reference to the column of exactly this name."""
    if not isinstance(name, str):
        raise TypeError("codec inputs are column names")
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    """SQL literal of a string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sized(b: str, nbytes: int, type_name: str, body: str, spark_type: str) -> str:
    """``body`` for NULL or ``nbytes`` bytes, an error otherwise."""
    message = f"concat('a {type_name} cell holds ', octet_length({b}), ' bytes instead of {nbytes}')"
    return (f"(CASE WHEN {b} IS NULL OR octet_length({b}) = {nbytes} THEN {body} "
            f"ELSE CAST(raise_error({message}) AS {spark_type}) END)")


# ---------------------------------------------------------------- integers
def int_bytes_sql(x: str, nbytes: int) -> str:
    """Two's-complement big-endian bytes of the low ``nbytes`` of a long."""
    return f"unhex(substring(lpad(hex(CAST({x} AS BIGINT)), 16, '0'), {17 - 2 * nbytes}, {2 * nbytes}))"


def bytes_int_sql(b: str, nbytes: int) -> str:
    """Signed big-endian integer (BIGINT) of ``nbytes`` bytes."""
    h = f"lpad(hex({b}), {2 * nbytes}, '0')"
    if nbytes < 8:
        pad = 16 - 2 * nbytes
        h = (f"concat(CASE WHEN substring({h}, 1, 1) IN ('8','9','A','B','C','D','E','F') "
             f"THEN '{'F' * pad}' ELSE '{'0' * pad}' END, {h})")
    return f"CAST(conv({h}, 16, -10) AS BIGINT)"


# ------------------------------------------------------------------ floats
def float_bits_sql(x: str, exp_bits: int, man_bits: int) -> str:
    """IEEE-754 bit pattern (BIGINT) of a double/float value."""
    bias = (1 << (exp_bits - 1)) - 1
    emin = 1 - bias
    exp_all = (1 << exp_bits) - 1
    nan = (exp_all << man_bits) | (1 << (man_bits - 1))
    d = f"CAST({x} AS DOUBLE)"
    a = f"abs({d})"
    e0 = f"floor(log2({a}))"
    e1 = (f"({e0} - CASE WHEN pow(2D, {e0}) > {a} THEN 1 ELSE 0 END "
          f"+ CASE WHEN pow(2D, {e0} + 1) <= {a} THEN 1 ELSE 0 END)")
    body = (f"CASE WHEN {d} IS NULL THEN CAST(NULL AS BIGINT) "
            f"WHEN isnan({d}) THEN {nan}L "
            f"WHEN {a} = CAST('Infinity' AS DOUBLE) THEN {exp_all << man_bits}L "
            f"WHEN {a} = 0D THEN 0L "
            f"WHEN {e1} >= {emin} THEN shiftleft(CAST({e1} + {bias} AS BIGINT), {man_bits}) "
            f"| CAST(({a} / pow(2D, {e1}) - 1D) * {float(1 << man_bits)!r}D AS BIGINT) "
            f"ELSE CAST({a} / pow(2D, {emin - man_bits}) AS BIGINT) END")
    # The sign of -0.0 is only visible in its text form; the cast runs for zeros only.
    negative = f"CASE WHEN {a} = 0D THEN startswith(CAST({d} AS STRING), '-') ELSE {d} < 0 END"
    return f"(CASE WHEN {negative} THEN ({body}) | shiftleft(1L, {exp_bits + man_bits}) ELSE {body} END)"


def bits_float_sql(bits: str, exp_bits: int, man_bits: int) -> str:
    """DOUBLE value of an IEEE-754 bit pattern held in a BIGINT."""
    bias = (1 << (exp_bits - 1)) - 1
    exp_all = (1 << exp_bits) - 1
    e = f"(shiftrightunsigned({bits}, {man_bits}) & {exp_all})"
    m = f"({bits} & {(1 << man_bits) - 1}L)"
    mag = (f"CASE WHEN {e} = {exp_all} THEN CASE WHEN {m} = 0 THEN CAST('Infinity' AS DOUBLE) "
           f"ELSE CAST('NaN' AS DOUBLE) END "
           f"WHEN {e} = 0 THEN CAST({m} AS DOUBLE) * pow(2D, {1 - bias - man_bits}) "
           f"ELSE CAST({m} + {1 << man_bits}L AS DOUBLE) * pow(2D, {e} - {bias + man_bits}) END")
    sign = f"(shiftrightunsigned({bits}, {exp_bits + man_bits}) & 1)"
    return f"(CASE WHEN {sign} = 1 THEN -({mag}) ELSE {mag} END)"


# ------------------------------------------------------------------ public
def encode_sql(x: str, type_name: str) -> str:
    t = normalize_type(type_name)
    if t in ("string", "rowkey"):
        return f"encode(CAST({x} AS STRING), 'UTF-8')"
    if t == "long":
        return int_bytes_sql(x, 8)
    if t == "int":
        return int_bytes_sql(x, 4)
    if t == "short":
        return int_bytes_sql(x, 2)
    if t == "boolean":
        return f"(CASE WHEN {x} IS NULL THEN CAST(NULL AS BINARY) WHEN {x} THEN X'FF' ELSE X'00' END)"
    if t == "double":
        return int_bytes_sql(float_bits_sql(x, 11, 52), 8)
    if t == "float":
        return int_bytes_sql(float_bits_sql(f"CAST(CAST({x} AS FLOAT) AS DOUBLE)", 8, 23), 4)
    raise ValueError(t)


def decode_sql(b: str, type_name: str) -> str:
    t = normalize_type(type_name)
    if t in ("string", "rowkey"):
        return f"decode({b}, 'UTF-8')"
    if t == "long":
        return _sized(b, 8, t, bytes_int_sql(b, 8), "BIGINT")
    if t == "int":
        return _sized(b, 4, t, f"CAST({bytes_int_sql(b, 4)} AS INT)", "INT")
    if t == "short":
        return _sized(b, 2, t, f"CAST({bytes_int_sql(b, 2)} AS SMALLINT)", "SMALLINT")
    if t == "boolean":
        return _sized(b, 1, t, f"(CASE WHEN {b} IS NULL THEN CAST(NULL AS BOOLEAN) ELSE hex({b}) != '00' END)", "BOOLEAN")
    if t == "double":
        return _sized(b, 8, t, bits_float_sql(bytes_int_sql(b, 8), 11, 52), "DOUBLE")
    if t == "float":
        return _sized(b, 4, t, f"CAST({bits_float_sql(f'({bytes_int_sql(b, 4)} & 4294967295L)', 8, 23)} AS FLOAT)", "FLOAT")
    raise ValueError(t)


DEFAULT_SQL = {
    "string": "''", "rowkey": "''", "int": "CAST(0 AS INT)", "long": "CAST(0 AS BIGINT)",
    "short": "CAST(0 AS SMALLINT)", "double": "CAST(0 AS DOUBLE)", "float": "CAST(0 AS FLOAT)", "boolean": "false",
}


def encode(x: str, type_name: str) -> Column:
    """Column of this name -> BINARY cell value in the store's byte layout."""
    return F.expr(encode_sql(col_ref(x), type_name))


def decode(b: str, type_name: str) -> Column:
    """BINARY cell value of the column of this name -> typed column; NULL stays NULL."""
    return F.expr(decode_sql(col_ref(b), type_name))


def default_value(type_name: str) -> Column:
    """Value a decoded column takes when the cell is missing."""
    return F.expr(DEFAULT_SQL[normalize_type(type_name)])


def decode_or_default_sql(b: str, type_name: str) -> str:
    t = normalize_type(type_name)
    return f"CAST(coalesce({decode_sql(b, t)}, {DEFAULT_SQL[t]}) AS {SPARK_TYPES[t].simpleString()})"


def decode_or_default(b: str, type_name: str) -> Column:
    return F.expr(decode_or_default_sql(col_ref(b), type_name))


def value_type_of(dtype) -> str:
    """Catalog type name for a Spark data type (used by schema-driven encoders)."""
    from pyspark.sql import types as T

    for name, t in SPARK_TYPES.items():
        if name != "rowkey" and t == dtype:
            return name
    if isinstance(dtype, T.ByteType):
        return "short"
    return "string"  # any other type is written as its string form
