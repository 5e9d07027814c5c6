"""Geohash cells as integer grid arithmetic in Catalyst expressions.

At precision ``p`` the hash has ``5p`` bits; longitude gets ``ceil(5p/2)``,
latitude ``floor(5p/2)``.  A coordinate's cell index is the result of the
library's bisection, computed as ``floor((x - lo) / span * 2^bits)`` and then
corrected against the exact cell boundaries ``lo + i * span / 2^bits`` (exact
dyadic numbers), so it equals bisection bit for bit.  Hash characters take
interleaved bits (longitude first, most significant first) five at a time.

:func:`geohash_sql` and its parts state the same formulas as SQL text.  Whole columns are added from that text: a tree of
some hundred nodes is parsed in one step, where building it call by call takes longer than the query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The geohash base-32 alphabet.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
LON_RANGE = (-180.0, 360.0)  # (low edge, span)
LAT_RANGE = (-90.0, 180.0)


def bits_for(precision: int) -> tuple[int, int]:
    nb = 5 * precision
    return (nb + 1) // 2, nb // 2


def cell_index(x: Column, lo: float, span: float, bits: int) -> Column:
    """Bisection cell index of ``x`` on a ``2^bits`` grid over ``[lo, lo + span]``."""
    n = 1 << bits
    step = F.lit(span / n)
    i0 = F.least(
        F.greatest(F.floor((x - F.lit(lo)) / F.lit(span) * F.pow(F.lit(2.0), F.lit(float(bits)))).cast("bigint"),
                   F.lit(0).cast("bigint")),
        F.lit(n - 1).cast("bigint"),
    )
    below = x < F.lit(lo) + i0.cast("double") * step
    above = (i0 < n - 1) & (x >= F.lit(lo) + (i0 + 1).cast("double") * step)
    return i0 - F.when(below, 1).otherwise(0) + F.when(above, 1).otherwise(0)


def cells(lat: Column, lon: Column, precision: int) -> tuple[Column, Column]:
    """``(gx, gy)``: longitude and latitude cell indices at ``precision``."""
    lon_bits, lat_bits = bits_for(precision)
    return cell_index(lon, *LON_RANGE, lon_bits), cell_index(lat, *LAT_RANGE, lat_bits)


def hash_of_cells(gx: Column, gy: Column, precision: int) -> Column:
    """Base-32 text of the cell ``(gx, gy)``."""
    lon_bits, lat_bits = bits_for(precision)
    chars = []
    for k in range(precision):
        v = F.lit(0).cast("bigint")
        for t in range(5):
            j = 5 * k + t
            src, nbits = (gx, lon_bits) if j % 2 == 0 else (gy, lat_bits)
            bit = F.shiftright(src, nbits - 1 - j // 2).bitwiseAND(F.lit(1))
            v = v + bit * (1 << (4 - t))
        chars.append(F.substr(F.lit(BASE32), (v + 1).cast("int"), F.lit(1)))
    return F.concat(*chars)


def geohash(lat: Column, lon: Column, precision: int) -> Column:
    """``GeoHash.withCharacterPrecision(lat, lon, p).toBase32()`` as an expression."""
    gx, gy = cells(lat, lon, precision)
    return hash_of_cells(gx, gy, precision)


def with_geohash(df, lat: str, lon: str, precision: int, out: str = "geohash"):
    """Add column ``out`` = geohash of ``(lat, lon)``.

    The two cell indices are materialised as columns first; each is then a
    plain reference in the bit extraction (Catalyst keeps a non-trivial
    expression that is referenced many times in its own projection), so the
    grid arithmetic runs once per row instead of once per hash bit.
    """
    staged = with_cell_indices(df, precision, lat, lon, "__gx", "__gy")
    return staged.withColumn(out, F.expr(hash_of_cells_sql("__gx", "__gy", precision))).drop("__gx", "__gy")


def with_cell_indices(df, precision: int, lat: str, lon: str, gx: str, gy: str):
    """Add the columns ``gx`` and ``gy``: longitude and latitude cell indices of the columns ``lat`` and ``lon``."""
    lon_bits, lat_bits = bits_for(precision)
    return df.withColumns({gx: F.expr(cell_index_sql(lon, *LON_RANGE, lon_bits)), gy: F.expr(cell_index_sql(lat, *LAT_RANGE, lat_bits))})


def neighbor_cells(gx: str, gy: str, precision: int, *, wrap_lat: bool = True) -> Column:
    """Distinct 3x3 block around the cell of the columns ``gx`` and ``gy`` as ``array<struct<dx, dy, cx, cy>>``.

    Longitude always wraps; latitude wraps too by default (library behaviour)
    or, with ``wrap_lat=False``, rows past a pole are dropped.
    """
    lon_bits, lat_bits = bits_for(precision)
    nx, ny = 1 << lon_bits, 1 << lat_bits
    items = []
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            cy = f"pmod({gy} + {dy}, {ny}L)" if wrap_lat else f"{gy} + {dy}"
            items.append(f"named_struct('dx', {dx}, 'dy', {dy}, 'cx', pmod({gx} + {dx}, {nx}L), 'cy', {cy})")
    block = f"array({', '.join(items)})"
    return F.expr(block if wrap_lat else f"filter({block}, e -> e.cy >= 0 AND e.cy < {ny})")


# ----------------------------------------------------------- SQL text form
def _d(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def cell_index_sql(x: str, lo: float, span: float, bits: int) -> str:
    n = 1 << bits
    i0 = (f"least(greatest(CAST(FLOOR(({x} - {_d(lo)}) / {_d(span)} * POWER(CAST(2 AS DOUBLE), {bits})) AS BIGINT), "
          f"CAST(0 AS BIGINT)), CAST({n - 1} AS BIGINT))")
    step = _d(span / n)
    return (f"({i0} - CASE WHEN {x} < {_d(lo)} + CAST({i0} AS DOUBLE) * {step} THEN 1 ELSE 0 END"
            f" + CASE WHEN {i0} < {n - 1} AND {x} >= {_d(lo)} + CAST({i0} + 1 AS DOUBLE) * {step} THEN 1 ELSE 0 END)")


def hash_of_cells_sql(gx: str, gy: str, precision: int) -> str:
    lon_bits, lat_bits = bits_for(precision)
    chars = []
    for k in range(precision):
        terms = []
        for t in range(5):
            j = 5 * k + t
            src, nbits = (gx, lon_bits) if j % 2 == 0 else (gy, lat_bits)
            terms.append(f"((({src}) >> {nbits - 1 - j // 2}) & 1) * {1 << (4 - t)}")
        chars.append(f"substr('{BASE32}', CAST({' + '.join(terms)} + 1 AS INTEGER), 1)")
    return "concat(" + ", ".join(chars) + ")"


def geohash_sql(lat: str, lon: str, precision: int) -> str:
    lon_bits, lat_bits = bits_for(precision)
    gx = cell_index_sql(lon, *LON_RANGE, lon_bits)
    gy = cell_index_sql(lat, *LAT_RANGE, lat_bits)
    return hash_of_cells_sql(gx, gy, precision)
