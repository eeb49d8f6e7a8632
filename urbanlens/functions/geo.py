"""Geometry as plain column expressions.

Points are ``struct<x: double, y: double>`` (x = longitude); a polygon is
``array<array<struct<x, y>>>`` (closed rings; holes and parts are just more
rings, combined by the even-odd rule). Nothing here leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def make_point(lon, lat) -> Column:
    """``ST_MakePoint(lon, lat)``: struct(x=lon, y=lat)."""
    return F.struct(_c(lon).cast("double").alias("x"), _c(lat).cast("double").alias("y"))


def ring_edges(rings) -> Column:
    """All edges of all rings: array<struct<x1, y1, x2, y2>>."""
    def ring_to_edges(r):
        return F.transform(
            F.sequence(F.lit(0), F.size(r) - 2),
            lambda k: F.named_struct(F.lit("x1"), r[k]["x"], F.lit("y1"), r[k]["y"],
                                     F.lit("x2"), r[k + 1]["x"], F.lit("y2"), r[k + 1]["y"]))
    return F.flatten(F.transform(_c(rings), ring_to_edges))


def _crosses(e: Column, px: Column, py: Column) -> Column:
    """Half-open ray-cast test for one edge. ``AND`` short-circuits, so the
    division only happens when the edge straddles the ray (y1 != y2)."""
    straddles = (e["y1"] > py) != (e["y2"] > py)
    return straddles & (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])


def raycast_inside(edges, px, py) -> Column:
    """Even-odd ray casting over an edge array (odd number of crossings).
    Points on the left/bottom boundary count as inside, right/top as outside,
    so tiling polygons give exactly one zone per point."""
    px, py = _c(px), _c(py)
    return (F.size(F.filter(_c(edges), lambda e: _crosses(e, px, py))) % 2) == 1


def _on_edge(e: Column, px: Column, py: Column) -> Column:
    cross = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
    return ((cross == 0)
            & (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
            & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"])))


def on_boundary(edges, px, py) -> Column:
    px, py = _c(px), _c(py)
    return F.exists(_c(edges), lambda e: _on_edge(e, px, py))


def within(edges, px, py) -> Column:
    """``ST_Within``: strictly inside, boundary excluded."""
    return raycast_inside(edges, px, py) & ~on_boundary(edges, px, py)


def intersects(edges, px, py) -> Column:
    """``ST_Intersects`` for a point: inside or on the boundary."""
    return raycast_inside(edges, px, py) | on_boundary(edges, px, py)


def ring_bbox(rings) -> tuple[Column, Column, Column, Column]:
    pts = F.flatten(_c(rings))
    xs = F.transform(pts, lambda p: p["x"])
    ys = F.transform(pts, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def polygon_centroid(rings) -> Column:
    """Area-weighted centroid (shoelace) over all rings of a polygon.

    Returns struct(x, y, area) with signed-area weighting, so holes wound the
    opposite way subtract as they should.
    """
    edges = ring_edges(rings)

    def acc(field):
        def f(a, e):
            cr = e["x1"] * e["y2"] - e["x2"] * e["y1"]
            if field == "a":
                return a + cr
            if field == "x":
                return a + (e["x1"] + e["x2"]) * cr
            return a + (e["y1"] + e["y2"]) * cr
        return F.aggregate(edges, F.lit(0.0), f)

    a2 = acc("a")
    return F.struct((acc("x") / (F.lit(3.0) * a2)).alias("x"),
                    (acc("y") / (F.lit(3.0) * a2)).alias("y"),
                    (a2 / F.lit(2.0)).alias("area"))


# --- State Plane (Lambert conformal conic, 2 standard parallels) inverse ---
# Fixed values of the source projection (NAD83 / New York Long Island, US feet).
LCC_A = 6378137.0                     # GRS80 semi-major axis, metres
LCC_INV_F = 298.257222101             # GRS80 inverse flattening
LCC_LAT1 = 41.03333333333333          # first standard parallel, degrees
LCC_LAT2 = 40.66666666666666          # second standard parallel, degrees
LCC_LAT0 = 40.16666666666666          # latitude of origin, degrees
LCC_LON0 = -74.0                      # central meridian, degrees
LCC_FALSE_EASTING_FT = 984250.0
LCC_FALSE_NORTHING_FT = 0.0
US_FOOT_M = 1200.0 / 3937.0


def _lcc_constants():
    e2 = (2 - 1 / LCC_INV_F) / LCC_INV_F
    e = math.sqrt(e2)

    def m(phi):
        return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)

    def t(phi):
        s = math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * s) / (1 + e * s)) ** (e / 2)

    p1, p2, p0 = (math.radians(v) for v in (LCC_LAT1, LCC_LAT2, LCC_LAT0))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    big_f = m(p1) / (n * t(p1) ** n)
    rho0 = LCC_A * big_f * t(p0) ** n
    return e, n, big_f, rho0


def lcc_to_lonlat(x_ft, y_ft, iterations: int = 6) -> Column:
    """Inverse Lambert conformal conic (Snyder 1987, eqs. 14-1, 15-9, 7-9).

    Returns struct(lon, lat) in degrees; the datum shift to WGS84 is taken as
    zero. Latitude is solved by an unrolled fixed-point iteration.
    """
    e, n, big_f, rho0 = _lcc_constants()
    x = (_c(x_ft) - F.lit(LCC_FALSE_EASTING_FT)) * F.lit(US_FOOT_M)
    y = (_c(y_ft) - F.lit(LCC_FALSE_NORTHING_FT)) * F.lit(US_FOOT_M)
    dy = F.lit(rho0) - y
    rho = F.sqrt(x * x + dy * dy)
    theta = F.atan2(x, dy)
    t = F.pow(rho / F.lit(LCC_A * big_f), F.lit(1.0 / n))
    lat0 = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)

    def step(lat, _):
        es = F.lit(e) * F.sin(lat)
        return F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t * F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2)))

    # A fold keeps the expression linear in the number of rounds.
    lat = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), lat0, step)
    lon = theta / F.lit(n) + F.lit(math.radians(LCC_LON0))
    return F.struct(F.degrees(lon).alias("lon"), F.degrees(lat).alias("lat"))


def metres_per_degree_lon(lat_deg) -> Column:
    """Length of one degree of longitude at a latitude (spherical, 111194.9 m/deg)."""
    return F.lit(111194.9) * F.cos(F.radians(_c(lat_deg)))
