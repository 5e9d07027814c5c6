"""Codec round trips against Python's struct module (big-endian layouts)."""

import math
import random
import struct

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F, types as T

from tessera.functions.codec import decode, decode_or_default, decode_sql, encode, encode_sql

SPECIAL_DOUBLES = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
                   1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 1e7,
                   123456.789, 3.141592653589793, 2.0 ** 52, 2.0 ** -1022, 0.5, 1.5]


def _roundtrip(spark, values, spark_type, type_name, fmt):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType([
        T.StructField("i", T.LongType()), T.StructField("v", spark_type)]))
    out = df.select("i", "v", F.hex(encode("v", type_name)).alias("h"),
                    F.expr(decode_sql(encode_sql("v", type_name), type_name)).alias("back")).orderBy("i").collect()
    for r, v in zip(out, values):
        if v is None:
            assert r.h is None and r.back is None
            continue
        assert r.h == struct.pack(fmt, v).hex().upper(), (v, r.h)
        if isinstance(v, float) and math.isnan(v):
            assert math.isnan(r.back)
        else:
            assert r.back == v and math.copysign(1, r.back) == math.copysign(1, v) if isinstance(v, float) else r.back == v


def test_double_special(spark):
    _roundtrip(spark, SPECIAL_DOUBLES + [None], T.DoubleType(), "double", ">d")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=50, max_size=200))
def test_double_property(spark, values):
    _roundtrip(spark, values, T.DoubleType(), "double", ">d")


def test_double_random_bits(spark):
    rnd = random.Random(7)
    vals = []
    while len(vals) < 2000:
        v = struct.unpack(">d", rnd.getrandbits(64).to_bytes(8, "big"))[0]
        if not math.isnan(v):
            vals.append(v)
    _roundtrip(spark, vals, T.DoubleType(), "double", ">d")


def test_float(spark):
    rnd = random.Random(3)
    vals = [0.0, -0.0, 1.0, -2.5, 1.401298464324817e-45, 3.4028234663852886e38, float("inf")]
    while len(vals) < 500:
        v = struct.unpack(">f", rnd.getrandbits(32).to_bytes(4, "big"))[0]
        if not math.isnan(v):
            vals.append(v)
    _roundtrip(spark, vals, T.FloatType(), "float", ">f")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1), min_size=20, max_size=100))
def test_long(spark, values):
    _roundtrip(spark, values + [-1, 0, -(2 ** 63), 2 ** 63 - 1], T.LongType(), "long", ">q")


def test_int_short(spark):
    ints = [0, 1, -1, 2 ** 31 - 1, -(2 ** 31), 12, -123456]
    _roundtrip(spark, ints, T.IntegerType(), "int", ">i")
    shorts = [0, 1, -1, 32767, -32768, 300]
    _roundtrip(spark, shorts, T.ShortType(), "short", ">h")


def test_string_boolean_defaults(spark):
    df = spark.createDataFrame([("lily", True), ("", False), ("日本", None)], "s string, b boolean").select(
        "*", F.lit(None).cast("binary").alias("none"), F.lit(b"\x07").alias("seven"))
    out = df.select(F.hex(encode("s", "string")).alias("hs"), F.expr(decode_sql(encode_sql("s", "string"), "string")).alias("s2"),
                    F.hex(encode("b", "boolean")).alias("hb"), F.expr(decode_sql(encode_sql("b", "boolean"), "boolean")).alias("b2"),
                    decode_or_default("none", "int").alias("d_int"),
                    decode_or_default("none", "string").alias("d_str"),
                    decode("seven", "boolean").alias("nonzero")).collect()
    assert [r.s2 for r in out] == ["lily", "", "日本"]
    assert [r.hs for r in out] == ["6C696C79", "", "E697A5E69CAC"]
    assert [r.hb for r in out] == ["FF", "00", None]
    assert [r.b2 for r in out] == [True, False, None]
    assert out[0].d_int == 0 and out[0].d_str == "" and out[0].nonzero is True
