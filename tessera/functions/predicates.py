"""Comparisons of typed values as comparisons of their stored bytes.

Spark compares binaries as unsigned bytes, first to last.  Within one sign the big-endian layouts keep the order of the numbers (of
negative floats: the opposite order), so every comparison with a literal becomes byte comparisons with the literal's bytes,
and no value is decoded.  As in Spark, NaN equals itself and is above all numbers, and the two zeros are equal.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.model import normalize_type

OPERATORS = ("=", "<", "<=", ">", ">=")
# Struct formats of the big-endian layouts.
_LAYOUT = {"short": ">h", "int": ">i", "long": ">q", "float": ">f", "double": ">d"}
_NEGATIVE = b"\x80"  # the least byte string whose first bit is set


def compare_bytes(value: Column, type_name: str, operator: str, literal) -> Column:
    """``decode(value) operator literal`` over the bytes ``value``; NULL bytes give NULL."""
    kind = normalize_type(type_name)
    if operator not in OPERATORS:
        raise ValueError(f"unknown comparison {operator!r}; use one of {', '.join(OPERATORS)}")
    if kind == "string":
        return _plain(value, operator, str(literal).encode())
    if kind == "boolean":
        if operator != "=":
            raise ValueError("booleans are compared by = only")
        return (value != F.lit(b"\x00")) if literal else (value == F.lit(b"\x00"))
    if kind not in _LAYOUT:
        raise ValueError(f"columns of type {kind} have no byte comparison")
    if operator in ("<=", ">="):
        return compare_bytes(value, kind, "=", literal) | compare_bytes(value, kind, operator[0], literal)
    floating = kind in ("float", "double")
    if floating and math.isnan(literal):
        nan = _is_nan(value, kind)
        return {"=": nan, "<": ~nan, ">": F.isnull(value) & F.lit(False)}[operator]
    bound = struct.pack(_LAYOUT[kind], literal)
    if floating and literal == 0:
        zeros = [struct.pack(_LAYOUT[kind], z) for z in (0.0, -0.0)]
        if operator == "=":
            return value.isin(*[F.lit(z) for z in zeros])
        bound = zeros[operator == "<"]
    if operator == "=":
        return value == F.lit(bound)
    below_zero = (value >= F.lit(_NEGATIVE)) & ~_is_nan(value, kind) if floating else value >= F.lit(_NEGATIVE)
    same_sign = _plain(value, operator if not (floating and bound >= _NEGATIVE) else {"<": ">", ">": "<"}[operator], bound)
    if bound >= _NEGATIVE:  # a negative literal: every number from zero on is above it
        return below_zero & same_sign if operator == "<" else ~below_zero | same_sign
    return below_zero | same_sign if operator == "<" else ~below_zero & (_is_nan(value, kind) | same_sign if floating else same_sign)


def _plain(value: Column, operator: str, bound: bytes) -> Column:
    b = F.lit(bound)
    return {"=": value == b, "<": value < b, "<=": value <= b, ">": value > b, ">=": value >= b}[operator]


def _is_nan(value: Column, kind: str) -> Column:
    """Bits above those of infinity, of either sign."""
    top = [struct.pack(_LAYOUT[kind], x) for x in (math.inf, -math.inf)]
    return ((value > F.lit(top[0])) & (value < F.lit(_NEGATIVE))) | (value > F.lit(top[1]))
