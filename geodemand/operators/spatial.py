"""Points -> nearest place within a radius.

The reference ranks every (postal code, centre) pair. Here no pair list is
built: centres are expanded to the lat/lon cells a point within ``max_km`` can
lie in, points are tagged with their one cell, and the two meet in an
equi-join on the cell. The cell set is exact (a superset of the radius), so
"within radius, then nearest" equals the reference's "nearest, then within
radius". The winner per point is ``min(struct(km, city, state))``: a partial
aggregate, not a window sort.

Where centres are dense (a point would meet more than ``max_per_cell``), the
cells that hold them are split into a tree, and all points walk down it
together, a level per join: a point goes on only into cells that can hold a
centre nearer than the farthest that its best cell's nearest can be. So a point
meets a few cells per level and a few leaves of centres, not all of them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_KM, KM_PER_DEGREE, haversine_km
from ..session import ensure_checkpoint_dir
from .measures import MeasureSpec
from .sizing import MAX_BROADCAST_ROWS

_EPS_DEG = 1e-7
# Depths of the tree of cells: a cell has 4 x 4 children, at the last depth it is a millionth of the radius.
_STEP, _DEEPEST = 2, 20
_NODE = ["_depth", "_i", "_j"]


def stations(df: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    """Distinct (key, lat, lon) of the fact; null coordinates dropped.

    A key with several coordinates yields several candidates.
    """
    return (
        df.select(F.col(key), F.col(lat).cast("double").alias(lat), F.col(lon).cast("double").alias(lon))
        .where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .distinct()
    )


def _grid(max_km: float) -> tuple[float, int, float]:
    """Latitude cell size (deg), number of longitude cells, longitude cell size."""
    lat_deg = max_km / KM_PER_DEGREE + _EPS_DEG
    # Capped so a polar centre expands to a bounded number of cells.
    n_lon = min(3600, max(1, int(math.floor(360.0 / lat_deg))))
    return lat_deg, n_lon, 360.0 / n_lon


def _lat_cell(lat: Column, lat_deg: float, parts: Column | None = None) -> Column:
    """Row of the cell; ``parts`` (a power of two) cuts a cell's side in so many."""
    at = (lat + F.lit(90.0)) / F.lit(lat_deg)
    return F.floor(at if parts is None else at * parts)


def _lon_cell(lon: Column, n_lon: int, lon_deg: float, parts: Column | None = None) -> Column:
    at = (lon + F.lit(180.0)) / F.lit(lon_deg)
    if parts is None:
        return F.pmod(F.floor(at), F.lit(n_lon))
    return F.pmod(F.floor(at * parts), F.lit(n_lon).cast("long") * parts)


def centre_cells(
    centres: DataFrame, lat: str, lon: str, max_km: float
) -> DataFrame:
    """Every centre once per grid cell a point within ``max_km`` can occupy.

    Latitude: a point within ``max_km`` is within one cell row (cells are at
    least the radius tall). Longitude: with ``phi_m`` the largest absolute
    latitude reachable, ``hav(d/R) >= cos(phi_c) cos(phi_m) hav(dlon)`` bounds
    the longitude difference; near a pole the bound covers the full circle.
    """
    lat_deg, n_lon, lon_deg = _grid(max_km)
    c_lat, c_lon = F.col(lat), F.col(lon)
    phi_m = F.least(F.abs(c_lat) + F.lit(max_km / KM_PER_DEGREE), F.lit(90.0))
    denom = F.cos(F.radians(c_lat)) * F.cos(F.radians(phi_m))
    arg = F.lit(math.sin(max_km / (2 * EARTH_RADIUS_KM))) / F.sqrt(F.greatest(denom, F.lit(1e-300)))
    if max_km >= math.pi * EARTH_RADIUS_KM:
        # Beyond half the circumference every point is in range (and the
        # bound below would no longer be monotonic in the radius).
        dlon = F.lit(180.0 + _EPS_DEG)
    else:
        dlon = (
            F.when((denom <= F.lit(1e-12)) | (arg >= F.lit(1.0)), F.lit(180.0))
            .otherwise(F.degrees(2 * F.asin(arg)))
            + F.lit(_EPS_DEG)
        )
    lo = F.floor((c_lon + F.lit(180.0) - dlon) / F.lit(lon_deg))
    hi = F.floor((c_lon + F.lit(180.0) + dlon) / F.lit(lon_deg))
    lon_cells = F.when(
        hi - lo + 1 >= F.lit(n_lon), F.sequence(F.lit(0).cast("long"), F.lit(n_lon - 1).cast("long"))
    ).otherwise(F.transform(F.sequence(lo, hi), lambda x: F.pmod(x, F.lit(n_lon).cast("long"))))
    lc = _lat_cell(c_lat, lat_deg)
    return (
        centres.withColumn("_lat_cell", F.explode(F.sequence(lc - 1, lc + 1)))
        .withColumn("_lon_cell", F.explode(lon_cells))
    )


def _cell_tree(centres: DataFrame, max_km: float, leaf: int) -> tuple[DataFrame, DataFrame]:
    """(tree, leaves) over distinct centres (_c_lat, _c_lon, ...).

    ``tree`` has one row per cell that holds centres and whose parent, if any,
    holds more than ``leaf``: its number of centres, whether it has children,
    and the middle and radius (km) of its centres' bounding box. ``leaves`` are
    the centres with the cell without children that they lie in.
    """
    lat_deg, n_lon, lon_deg = _grid(max_km)
    parts = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_depth"))
    each = centres.withColumn("_depth", F.explode(F.sequence(F.lit(0), F.lit(_DEEPEST), F.lit(_STEP)))).withColumns(
        {"_i": _lat_cell(F.col("_c_lat"), lat_deg, parts), "_j": _lon_cell(F.col("_c_lon"), n_lon, lon_deg, parts)}
    )
    lon = F.pmod(F.col("_c_lon") + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
    boxes = each.groupBy(*_NODE).agg(
        F.count(F.lit(1)).alias("_n"),
        *[f(c).alias(n) for c, lo, hi in ((F.col("_c_lat"), "_s", "_t"), (lon, "_w", "_e")) for f, n in ((F.min, lo), (F.max, hi))],
    )
    # From the middle to a corner: half the height, half the width at the widest parallel of the box.
    widest = F.when((F.col("_s") <= 0) & (F.col("_t") >= 0), F.lit(1.0)).otherwise(
        F.greatest(F.cos(F.radians("_s")), F.cos(F.radians("_t")))
    )
    hav = F.pow(F.sin(F.radians((F.col("_t") - F.col("_s")) / 4)), 2) + F.pow(widest * F.sin(F.radians((F.col("_e") - F.col("_w")) / 4)), 2)
    nodes = boxes.select(
        *_NODE,
        "_n",
        ((F.col("_n") > leaf) & (F.col("_depth") < _DEEPEST)).alias("_open"),
        ((F.col("_s") + F.col("_t")) / 2).alias("_q_lat"),
        ((F.col("_w") + F.col("_e")) / 2).alias("_q_lon"),
        (2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(hav, F.lit(1.0))))).alias("_rho"),
    )
    side = 1 << _STEP
    inside = nodes.where("_open").select((F.col("_depth") + _STEP).alias("_depth"), F.col("_i").alias("_pi"), F.col("_j").alias("_pj"))
    below = nodes.withColumns({"_pi": F.floor(F.col("_i") / side), "_pj": F.floor(F.col("_j") / side)})
    below = below.join(inside, ["_depth", "_pi", "_pj"], "left_semi").drop("_pi", "_pj")
    ensure_checkpoint_dir(centres.sparkSession)
    tree = nodes.where("_depth = 0").unionByName(below).checkpoint()
    return tree, each.join(tree.where("not _open").select(*_NODE), _NODE)


def _may_be_nearest(frontier: DataFrame, point: Sequence[str], max_km: float) -> DataFrame:
    """Rows (point, cell) whose cell can hold the point's nearest centre within ``max_km``."""
    best = Window.partitionBy(*point)
    # Some centre of a cell is no farther than its middle plus its radius, and none nearer than their difference.
    # Near the antipode a distance is known to 0.2 m only.
    slack = F.lit(1e-6) + F.when(F.col("_q_km") > 1e4, F.lit(1e-3)).otherwise(F.lit(0.0))
    return (
        frontier.withColumn("_q_km", haversine_km("_p_lat", "_p_lon", "_q_lat", "_q_lon"))
        .withColumn("_bound", F.least(F.min(F.col("_q_km") + F.col("_rho")).over(best), F.lit(float(max_km))))
        .where(F.col("_q_km") - F.col("_rho") <= F.col("_bound") + slack)
        .drop("_q_km", "_bound")
    )


def dense_candidates(
    pts: DataFrame, centres: DataFrame, point_key: str, max_km: float, leaf: int = 64, max_broadcast_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """(point, centre) rows among which is the nearest centre, ties included, of every point that has one within ``max_km``.

    ``pts`` carries ``point_key, _p_lat, _p_lon, _lat_cell, _lon_cell``;
    ``centres`` ``_c_lat, _c_lon`` and the columns to return, coordinates in
    valid degrees. Repeated points are walked once; of centres at one spot only
    the least can win. The depth of the walk is read from the tree (one row to
    the driver) and grows with the logarithm of the densest cell's centres.
    """
    lat_deg, n_lon, lon_deg = _grid(max_km)
    place = [c for c in centres.columns if c not in ("_c_lat", "_c_lon")]
    spots = centres.groupBy("_c_lat", "_c_lon").agg(F.min(F.struct(*place)).alias("_p")).select("_c_lat", "_c_lon", "_p.*")
    tree, leaves = _cell_tree(spots, max_km, leaf)
    size = tree.agg(F.count(F.lit(1)).alias("rows"), F.max(F.when(F.col("_open"), F.col("_depth"))).alias("deepest")).first()
    small = F.broadcast if size["rows"] <= max_broadcast_rows else (lambda df: df)
    point = [point_key, "_p_lat", "_p_lon"]
    # cells of the first depth, by the cells of the points that they can serve
    own = {"_depth": F.lit(0), "_i": _lat_cell(F.col("_c_lat"), lat_deg), "_j": _lon_cell(F.col("_c_lon"), n_lon, lon_deg)}
    reach = centre_cells(spots.select("_c_lat", "_c_lon").withColumns(own), "_c_lat", "_c_lon", max_km)
    reach = reach.select("_lat_cell", "_lon_cell", *_NODE).distinct().join(tree, _NODE)
    frontier = pts.distinct().join(reach, ["_lat_cell", "_lon_cell"]).drop("_lat_cell", "_lon_cell")
    side, carried = 1 << _STEP, tree.columns
    for depth in range(0, -1 if size["deepest"] is None else size["deepest"] + 1, _STEP):
        below = tree.where(F.col("_depth") == depth + _STEP)
        below = below.select(
            F.lit(depth).alias("_depth"), F.floor(F.col("_i") / side).alias("_i"), F.floor(F.col("_j") / side).alias("_j"),
            F.struct(*carried).alias("_child"),
        )
        # cells without children stay as they are and go on bounding the others
        walked = _may_be_nearest(frontier, point, max_km).join(small(below), _NODE, "left")
        frontier = walked.select(*point, *[F.when(F.col("_child").isNull(), F.col(c)).otherwise(F.col(f"_child.{c}")).alias(c) for c in carried])
    return _may_be_nearest(frontier, point, max_km).select(*point, *_NODE).join(leaves, _NODE).drop(*_NODE)


def nearest_place(
    points: DataFrame,
    centres: DataFrame,
    max_km: float,
    point_key: str = "postal_code",
    point_lat: str = "lat",
    point_lon: str = "lon",
    centre_lat: str = "center_lat",
    centre_lon: str = "center_lon",
    centre_cols: Sequence[str] = ("city", "state"),
    distance_col: str = "distance_km",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_per_cell: int = 64,
) -> DataFrame:
    """Assign each point key to its nearest centre, kept only within ``max_km``.

    Returns one row per point key: ``point_key, *centre_cols, distance_col``.
    Ties go to the smallest ``centre_cols``. Points with null coordinates are
    dropped. Once some cell can meet more than ``max_per_cell`` centres, the
    search goes by :func:`dense_candidates`; the result is the same.
    """
    lat_deg, n_lon, lon_deg = _grid(max_km)
    pts = (
        points.select(point_key, F.col(point_lat).cast("double").alias("_p_lat"), F.col(point_lon).cast("double").alias("_p_lon"))
        .where(F.col("_p_lat").isNotNull() & F.col("_p_lon").isNotNull())
        .withColumn("_lat_cell", _lat_cell(F.col("_p_lat"), lat_deg))
        .withColumn("_lon_cell", _lon_cell(F.col("_p_lon"), n_lon, lon_deg))
    )
    spots = centres.select(
        *centre_cols, F.col(centre_lat).cast("double").alias("_c_lat"), F.col(centre_lon).cast("double").alias("_c_lon")
    ).where(F.col("_c_lat").isNotNull() & F.col("_c_lon").isNotNull())
    cells = centre_cells(spots, "_c_lat", "_c_lon", max_km)
    met = cells.groupBy("_lat_cell", "_lon_cell").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    if (met["most"] or 0) > max_per_cell:
        cand = dense_candidates(pts, spots, point_key, max_km, max_per_cell, max_broadcast_rows)
    else:
        # The centre-cell side is a few rows per centre: broadcast it when its
        # size is checked small, so the (possibly skewed) points never shuffle.
        cand = pts.join(F.broadcast(cells) if (met["rows"] or 0) <= max_broadcast_rows else cells, ["_lat_cell", "_lon_cell"])
    cand = cand.withColumn("_km", haversine_km("_p_lat", "_p_lon", "_c_lat", "_c_lon")).where(F.col("_km") <= F.lit(float(max_km)))
    best = cand.groupBy(point_key).agg(
        F.min(F.struct(F.col("_km"), *[F.col(c) for c in centre_cols])).alias("_best")
    )
    return best.select(
        point_key, *[F.col(f"_best.{c}").alias(c) for c in centre_cols], F.col("_best._km").alias(distance_col)
    )


def _mean_from_parts(m, s: Column, c: Column) -> Column:
    """``sum / count`` typed as ``AVG`` would type it (decimal(p+4, s+4) for
    decimal inputs), so re-aggregated means equal a direct average."""
    q = F.try_divide(s, c)
    t = m.type.replace(" ", "").lower()
    if t.startswith("decimal("):
        p, sc = (int(x) for x in t[len("decimal(") : -1].split(","))
        q = q.cast(f"decimal({min(38, p + 4)},{min(38, sc + 4)})")
    return q


def point_day_parts(
    fact: DataFrame,
    key: str,
    date_col: str,
    measures: MeasureSpec,
    date_name: str = "date",
    where: Column | None = None,
) -> DataFrame:
    """Per (point, day): the sum and non-null count of every measure. A
    partial aggregate, so a point holding a large share of the rows is
    collapsed on the map side before the shuffle."""
    f = fact if where is None else fact.where(where)
    parts = []
    for n, m in measures.items():
        v = m.value(n)
        parts += [F.sum(v).alias(f"_s_{n}"), F.count(v).alias(f"_c_{n}")]
    return f.where(F.col(key).isNotNull()).groupBy(key, F.col(date_col).alias(date_name)).agg(*parts)


def rollup_parts(
    parts: DataFrame,
    mapping: DataFrame,
    key: str,
    measures: MeasureSpec,
    place_cols: Sequence[str] = ("city", "state"),
    date_name: str = "date",
    member_count: str | None = "postal_code_count",
    consts: Mapping[str, object] | None = None,
) -> DataFrame:
    """Join point-day parts to the point -> place map and roll them up to one
    row per place and day: means as sum/count (typed as ``AVG`` would type
    them) and the number of member points.

    ``parts`` holds one row per (point, day) and ``mapping`` one row per
    point, so counting rows counts distinct points without a distinct
    aggregation.
    """
    joined = parts.join(mapping.select(key, *place_cols), key)
    aggs = [F.count(F.lit(1)).alias(member_count)] if member_count else []
    aggs += [
        m.finish(_mean_from_parts(m, F.sum(f"_s_{n}"), F.sum(f"_c_{n}"))).alias(n) for n, m in measures.items()
    ]
    out = joined.groupBy(*place_cols, date_name).agg(*aggs)
    if consts:
        out = out.withColumns({k: F.lit(v) for k, v in consts.items()})
    return out


def place_day_measures(
    fact: DataFrame,
    mapping: DataFrame,
    key: str,
    date_col: str,
    measures: MeasureSpec,
    place_cols: Sequence[str] = ("city", "state"),
    date_name: str = "date",
    member_count: str | None = "postal_code_count",
    where: Column | None = None,
    consts: Mapping[str, object] | None = None,
) -> DataFrame:
    """Point-day facts -> place-day means over member points, with the number
    of distinct member points (one row per place and day).

    The fact is aggregated to (point, day) sums and non-null counts *before*
    the join (:func:`point_day_parts`): the join input is bounded by points x
    days and a hot point never reaches the join as many rows; the place-day
    means are then rolled up as sum/count (:func:`rollup_parts`), equal to the
    direct average. ``mapping`` (point key -> place) is derived from the fact,
    so its size is not checked eagerly; AQE broadcasts it at run time when
    small.
    """
    parts = point_day_parts(fact, key, date_col, measures, date_name=date_name, where=where)
    return rollup_parts(parts, mapping, key, measures, place_cols, date_name, member_count, consts)
