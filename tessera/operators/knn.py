"""Nearest neighbours through an index of cell counts, and one distributed join.

The reference answers one point at a time with nine prefix scans on the
driver.  Here a frame of query points descends a tree of geohash cells:

* Every point is keyed once, by the integer cell of the finest level.  One
  partially aggregated exchange counts the points of each occupied cell, and
  coarser levels sum those counts by bit shifts: no point moves for them.
* A query starts with its 3x3 block.  Level by level its cells are replaced
  by their occupied children.  The children nearest by their farthest corner
  that hold ``n`` points together prove a bound on the n-th distance, and
  children whose nearest edge lies beyond it are dropped.  So dense regions are
  searched through small cells and empty ones widen the search by itself.
  The descent ends where the smallest cells hold ``DENSE_BYTES`` of the points' files,
  were they spread evenly, so also in dense regions a cell has a few places, not
  thousands: a query meets tens of points, however many there are.
* Of points at one place only the ``n`` smallest ``uid`` can be among the nearest,
  so each task keeps those before any exchange.  Points outside all cells wanted
  are dropped; the rest meet the queries in one equi-join on the finest cell.  A
  cell of more than ``SALT_POINTS`` points -- a city, or a third of the data -- is
  split over as many join keys as its count asks for; other cells have one.
* A pair farther apart than the query's bound is dropped as it is met.
* The per-query top ``n`` is a ``row_number`` filter that Spark plans as a
  partial ``WindowGroupLimit`` before the shuffle on ``qid``, so each task
  ships at most ``n`` candidates per query.

Results are exact within the 3x3 block (the reference's contract); ties in
distance are broken by ``uid``.  Cell edges are exact dyadic numbers and IEEE
operations are monotone, so no computed distance of a point leaves the range of its
cell's.  Building the plan runs no job; the size of the points' files sets only how fine the index is.

The top ``n`` relies on Spark's window group limit, which applies up to
``spark.sql.optimizer.windowGroupLimitThreshold`` (1,000 by default); beyond it
all candidates of a query meet in its window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.geohash import LAT_RANGE, LON_RANGE, bits_for, cell_index_sql, hash_of_cells_sql, neighbor_cells, with_cell_indices
from tessera.operators.partitioning import partitions_for, source_bytes

CELL_BYTES = 64 << 10  # of the points' files for each cell of the level asked for, were they spread evenly
DENSE_BYTES = 2  # the same for the smallest cells: tens of them for each point of an even spread, so that dense regions have some too
UNSIZED_LEVEL = 5  # of the smallest cells, where the size of the points is not known
QUERY_BYTES = 64 << 10  # of the queries' files for each task that descends: thousands of queries with hundreds of cells each
SALT_POINTS = 100_000
BROADCAST_LEVEL = 4  # up to this level a frame of cells has at most 32 ** 4 rows of a few numbers


def planar_distance(x1, y1, x2, y2):
    """``Point2D.distance``: Euclidean distance in degrees."""
    dx = x2 - x1
    dy = y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def with_cells(points: DataFrame, precision: int, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return with_cell_indices(points, precision, lat, lon, "cell_x", "cell_y")


def query_blocks(queries: DataFrame, precision: int, *, wrap_lat: bool = True) -> DataFrame:
    """Every query point with each cell of its 3x3 block: ``qid, qlon, qlat, dx, dy, cx, cy, cell``."""
    q = with_cells(queries.select("qid", F.col("lon").alias("qlon"), F.col("lat").alias("qlat")), precision, "qlat", "qlon")
    q = q.select("qid", "qlon", "qlat", F.inline(neighbor_cells("cell_x", "cell_y", precision, wrap_lat=wrap_lat)))
    return q.withColumn("cell", F.expr(hash_of_cells_sql("cx", "cy", precision)))


def distance_to_cell_centre(points: DataFrame, precision: int) -> DataFrame:
    """Planar distance of every point to the centre of its geohash cell: ``uid, cell, distance``."""
    lon_bits, lat_bits = bits_for(precision)
    w = LON_RANGE[1] / (1 << lon_bits)
    h = LAT_RANGE[1] / (1 << lat_bits)
    c = with_cells(points, precision)
    cx = F.lit(LON_RANGE[0]) + (F.col("cell_x").cast("double") + 0.5) * F.lit(w)
    cy = F.lit(LAT_RANGE[0]) + (F.col("cell_y").cast("double") + 0.5) * F.lit(h)
    return c.select("uid", F.expr(hash_of_cells_sql("cell_x", "cell_y", precision)).alias("cell"),
                    planar_distance(cx, cy, F.col("lon"), F.col("lat")).alias("distance"))


def cell_distances(qlon: str, qlat: str, cx: str, cy: str, level: int) -> tuple[str, str]:
    """Planar distances from a query to the nearest and the farthest place of a cell's rectangle, as SQL over columns.

    Cell edges are exact dyadic numbers and IEEE operations are monotone, so the computed distance of any point inside the
    cell lies between them.
    """
    lon_bits, lat_bits = bits_for(level)
    near, far = [], []
    for q, c, (low, span), bits in ((qlon, cx, LON_RANGE, lon_bits), (qlat, cy, LAT_RANGE, lat_bits)):
        side = span / (1 << bits)
        a, b = f"({low}D + {c} * {side!r}D)", f"({low}D + ({c} + 1) * {side!r}D)"
        to_edge, across = f"greatest({a} - {q}, {q} - {b}, 0D)", f"greatest({q} - {a}, {b} - {q})"
        near.append(f"{to_edge} * {to_edge}")
        far.append(f"{across} * {across}")
    return f"sqrt({' + '.join(near)})", f"sqrt({' + '.join(far)})"


def _up(level: int, to: int) -> tuple[str, str]:
    """Cell columns ``cell_x, cell_y`` of ``level`` as cells of the coarser level ``to``."""
    (lf, tf), (lc, tc) = bits_for(level), bits_for(to)
    return f"shiftright(cell_x, {lf - lc})", f"shiftright(cell_y, {tf - tc})"


def _step(level: int, finest: int, n: int) -> str:
    """Views that lead from ``at{level - 1}``, the cells around each query, to ``at{level}``, their children that may hold one of its
    ``n`` nearest points, with their counts."""
    x, y = _up(finest, level)
    children = f"(SELECT {x} AS cell_x, {y} AS cell_y, sum(c) AS c FROM counts GROUP BY 1, 2)" if level < finest else "counts"
    px, py = _up(level, level - 1)
    near, far = cell_distances("qlon", "qlat", "cell_x", "cell_y", level)
    return f"""
children{level} AS (SELECT {px} AS px, {py} AS py, cell_x, cell_y, c FROM {children}),
below{level} AS (
  SELECT {_sized("k", level)} qid, qlon, qlat, cell_x AS cx, cell_y AS cy, k.c, {near} AS near, {far} AS far
  FROM at{level - 1} JOIN children{level} k ON cx = px AND cy = py),
reached{level} AS (SELECT *, sum(c) OVER (PARTITION BY qid ORDER BY far, cx, cy ROWS UNBOUNDED PRECEDING) AS reached FROM below{level}),
bound{level} AS (SELECT *, min(CASE WHEN reached >= {n} THEN far END) OVER (PARTITION BY qid) AS bound FROM reached{level}),
at{level} AS (SELECT qid, qlon, qlat, cx, cy, c, bound FROM bound{level} WHERE bound IS NULL OR near <= bound),"""


def _sized(view: str, level: int) -> str:
    """A hint for a view of at most one row a cell of ``level``: broadcast where the grid bounds its size, else as Spark decides."""
    return f"/*+ BROADCAST({view}) */" if level <= BROADCAST_LEVEL else ""


def nearest_in(points: DataFrame, blocks: DataFrame, precision: int, n: int, finest: int, salt_points: int = SALT_POINTS) -> DataFrame:
    """Top ``n`` points of the cells ``cx, cy`` at ``precision`` that ``blocks`` (``qid, qlon, qlat, cx, cy``) lists for each query.

    Points and queries without a coordinate take no part.  One SQL statement, so that Spark analyses the plan once and not after each of its thirty steps.
    """
    lon_bits, lat_bits = bits_for(finest)
    key = f"{cell_index_sql('lon', *LON_RANGE, lon_bits)} AS cell_x, {cell_index_sql('lat', *LAT_RANGE, lat_bits)} AS cell_y"
    text = f"""
WITH keyed AS (SELECT uid, hash, lon, lat, {key} FROM {{points}}),
counts AS (SELECT cell_x, cell_y, count(1) AS c FROM (SELECT {key} FROM {{points}}) GROUP BY cell_x, cell_y),
kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lon, lat ORDER BY uid) AS nth FROM keyed) WHERE nth <= {n}),
at{precision} AS ({"SELECT qid, qlon, qlat, cx, cy" if finest > precision else f"SELECT {_sized('counts', precision)} qid, qlon, qlat, cx, cy, c, CAST(NULL AS DOUBLE) AS bound"}
  FROM {{blocks}} {"" if finest > precision else "JOIN counts ON cx = cell_x AND cy = cell_y"}),
{"".join(_step(level, finest, n) for level in range(precision + 1, finest + 1))}
-- a cell gets salts by its count, most have one; points outside the cells wanted go
wanted AS (SELECT cx, cy, int(ceil(max(c) / {salt_points})) AS salts FROM at{finest} GROUP BY cx, cy),
found AS (
  SELECT {_sized("w", finest)} cx, cy, int(pmod(xxhash64(uid), salts)) AS salt, uid, hash, lon, lat
  FROM kept JOIN wanted w ON cell_x = cx AND cell_y = cy),
spread AS (SELECT qid, qlon, qlat, cx, cy, bound, explode(sequence(0, int(ceil(c / {salt_points})) - 1)) AS salt FROM at{finest}),
met AS (
  SELECT qid, uid, hash, lon, lat, sqrt((lon - qlon) * (lon - qlon) + (lat - qlat) * (lat - qlat)) AS distance, bound
  FROM spread s JOIN found p ON s.cx = p.cx AND s.cy = p.cy AND s.salt = p.salt)
SELECT qid, rank, uid, hash, lon, lat, distance
FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, uid) AS rank FROM met WHERE bound IS NULL OR distance <= bound) WHERE rank <= {n}"""
    placed = points.select("uid", "hash", "lon", "lat").where("lon IS NOT NULL AND lat IS NOT NULL")
    return points.sparkSession.sql(text, points=placed, blocks=blocks.where("qlon IS NOT NULL AND qlat IS NOT NULL"))


def _finest(points: DataFrame, precision: int, fine_precision: int | str | None) -> int:
    if fine_precision is None:
        return precision
    if fine_precision == "auto":
        fine_precision, cells_wanted = precision + 1, source_bytes(points) // CELL_BYTES
        while 32 ** fine_precision < cells_wanted:
            fine_precision += 1
    return min(12, max(precision, fine_precision))


def _depth(points: DataFrame, precision: int, fine_precision: int | str | None) -> int:
    """The level of the smallest cells: at least the one asked for, or ``precision`` where no index is wanted."""
    depth = _finest(points, precision, fine_precision)
    if fine_precision is None:
        return depth
    cells_wanted = source_bytes(points) // DENSE_BYTES or 32 ** UNSIZED_LEVEL
    while 32 ** depth < cells_wanted:
        depth += 1
    return min(12, depth)


def _dealt(queries: DataFrame) -> DataFrame:
    """Queries in tasks of bounded size, a number that adaptive execution does not lower: each grows to hundreds of cells there."""
    least = queries.sparkSession.sparkContext.defaultParallelism
    return queries.repartition(partitions_for(queries, least, QUERY_BYTES), "qid")


def cell_candidates(points: DataFrame, queries: DataFrame, precision: int, n: int, *,
                    fine_precision: int | str | None = "auto", salt_points: int = SALT_POINTS) -> DataFrame:
    """takeN: the ``n`` points of each query's own cell nearest to the query (bounded per query).

    ``points``: ``uid, hash, lon, lat``; ``queries``: ``qid, lon, lat``.
    Output: ``qid, rank, uid, hash, lon, lat, distance``.
    """
    own = query_blocks(_dealt(queries), precision).filter((F.col("dx") == 0) & (F.col("dy") == 0))
    return nearest_in(points, own, precision, n, _depth(points, precision, fine_precision), salt_points)


def knn_geohash(points: DataFrame, queries: DataFrame, n: int = 5, precision: int = 1, *,
                wrap_lat: bool = True, fine_precision: int | str | None = "auto", salt_points: int = SALT_POINTS) -> DataFrame:
    """Top ``n`` points by planar distance over each query's 3x3 geohash block at ``precision``.

    Output: ``qid, rank, uid, hash, lon, lat, distance`` (rank 1 = nearest).
    ``fine_precision`` is the least depth of the index (``None``: no index; ``"auto"``: below ``precision``, and so fine that the
    files of the points hold about ``CELL_BYTES`` a cell), which goes on to cells of ``DENSE_BYTES``.  The result is the same for every choice.
    """
    blocks = query_blocks(_dealt(queries), precision, wrap_lat=wrap_lat)
    return nearest_in(points, blocks, precision, n, _depth(points, precision, fine_precision), salt_points)
