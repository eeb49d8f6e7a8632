"""Spatial joins as cell-keyed equi-joins.

Catalyst has no spatial index, so polygons are indexed by a regular grid of
cells: each cell row carries the (few) candidate polygons whose bounding box
touches it. A point looks up exactly one cell with an equi-join, and the exact
test (ray casting, after a cheap bounding-box test) runs as a projection over
that cell's candidates. One cell row per point means no duplicates, so no row
key and no dedup shuffle are needed; "first match" is the smallest LocationID.

A cell that lies wholly inside a polygon stores the answer; a border cell
stores only the edges that a ray from inside it can meet.

Scale: the cell table grows with the polygon layer, not with the points. It
is broadcast if the bound on its bytes, taken from the layer in one aggregate,
is small enough. A layer for which the bound is large gets a quadtree
(``quadtree.py``), whose cells follow the detail of each polygon. Tables too
large to broadcast are joined with a shuffle on the cell key (where AQE splits dense
cells, and rows that need no lookup are spread over keys of their own). The
cell size defaults to half the mean polygon bounding-box side, so a point sees
only a few candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.functions import geo
from urbanlens.operators.quadtree import QuadIndex, quad_index

DEFAULT_CELL = None   # None: half the mean polygon bounding-box side
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A layer gets a quadtree if cells of one size could take more than this.
MAX_GRID_BYTES = 4 * MAX_BROADCAST_BYTES
# Bytes of one stored edge (four doubles and their array slot), rounded up.
EDGE_BYTES = 48


@dataclass(frozen=True)
class ZoneIndex:
    """A polygon layer cut into cells; pass it to several lookups to build it once."""

    cells: DataFrame
    cell: float
    max_bytes: float

    def attach(self, points: DataFrame, lon: str, lat: str, active: Column | None = None) -> DataFrame:
        """Left-join each point to its grid cell. Inactive rows, and rows without
        coordinates, have no key, or in a shuffle spread keys of no cell."""
        small = self.max_bytes <= MAX_BROADCAST_BYTES
        cells = self.cells.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), "candidates")
        cx = F.floor(F.col(lon) / F.lit(self.cell))
        cy = F.floor(F.col(lat) / F.lit(self.cell))
        known = cx.isNotNull() & cy.isNotNull() if active is None else active & cx.isNotNull() & cy.isNotNull()
        apart = F.lit(None).cast("bigint") if small else F.lit(-(1 << 40)) - F.pmod(
            F.xxhash64(lon, lat, F.monotonically_increasing_id()), F.lit(1 << 16))
        p = points.withColumn("_cx", F.when(known, cx).otherwise(apart)).withColumn("_cy", F.when(known, cy).otherwise(F.lit(0)))
        return p.join(F.broadcast(cells) if small else cells, ["_cx", "_cy"], "left").drop("_cx", "_cy")

    @staticmethod
    def holds(z: Column, px: Column, py: Column, mode: str) -> Column:
        """A cheap bounding-box test first, the exact edge test only for candidates that pass it."""
        pred = {"raycast": geo.raycast_inside, "within": geo.within, "intersects": geo.intersects}[mode]
        in_box = (px >= z["minx"]) & (px <= z["maxx"]) & (py >= z["miny"]) & (py <= z["maxy"])
        return in_box & (z["whole"] | pred(z["edges"], px, py))


def zone_index(zones: DataFrame | ZoneIndex | QuadIndex, cell: float | None = DEFAULT_CELL, id_col: str = "LocationID",
               rings_col: str = "rings") -> ZoneIndex | QuadIndex:
    """Index a polygon layer. One aggregate row of the layer reaches the
    driver: the default cell size and sums that bound the cell table's bytes
    (a polygon touches at most ``(w/c + 2) * (h/c + 2)`` cells). A layer whose
    cells of one size could take ``MAX_GRID_BYTES``, such as one with large
    detailed polygons among small ones, gets a quadtree, unless a cell size is given."""
    if isinstance(zones, (ZoneIndex, QuadIndex)):
        return zones
    minx, miny, maxx, maxy = geo.ring_bbox(F.col(rings_col))
    shape = zones.select((maxx - minx).alias("w"), (maxy - miny).alias("h"), F.size(F.flatten(rings_col)).alias("e"))
    e, w, h = F.col("e") + 2, F.col("w"), F.col("h")
    r = shape.agg(F.avg(F.least(w, h)).alias("side"), F.sum(w * h * e).alias("whe"), F.sum((w + h) * e).alias("we"),
                  F.sum(e).alias("e")).first()
    given, cell = cell, cell or max((r["side"] or 0.1) / 2.0, 1e-6)
    bound = ((r["whe"] or 0.0) / cell**2 + 2 * (r["we"] or 0.0) / cell + 4 * (r["e"] or 0)) * EDGE_BYTES
    if given is None and bound > MAX_GRID_BYTES:
        return quad_index(zones, id_col, rings_col, broadcast_bytes=MAX_BROADCAST_BYTES)
    return ZoneIndex(zone_cells(zones, cell, id_col, rings_col), cell, bound)


def zone_cells(zones: DataFrame, cell: float, id_col: str = "LocationID", rings_col: str = "rings") -> DataFrame:
    """(cx, cy, candidates array<struct<id, bbox, whole, edges>>): one row per grid cell.

    ``whole``: no edge comes near the cell and its centre is inside, so every
    point of it is. A cell that no edge comes near and whose centre is outside
    has no such candidate. Else ``edges`` are those that reach the cell's rows
    and do not end left of it.
    """
    minx, miny, maxx, maxy = geo.ring_bbox(F.col(rings_col))
    c = F.lit(cell)
    z = zones.select(
        F.col(id_col).alias("zid"),
        geo.ring_edges(F.col(rings_col)).alias("all_edges"),
        minx.alias("minx"), miny.alias("miny"), maxx.alias("maxx"), maxy.alias("maxy"),
        F.explode(F.sequence(F.floor(minx / c), F.floor(maxx / c))).alias("cx"),
        F.sequence(F.floor(miny / c), F.floor(maxy / c)).alias("cys"),
    ).select("zid", "all_edges", "minx", "miny", "maxx", "maxy", "cx", F.explode("cys").alias("cy"))
    # A margin keeps points whose cell was rounded to the neighbour.
    eps = c * F.lit(1e-6)
    x0, x1 = F.col("cx") * c - eps, (F.col("cx") + 1) * c + eps
    y0, y1 = F.col("cy") * c - eps, (F.col("cy") + 1) * c + eps
    right = F.filter("all_edges", lambda e: (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1)
                     & (F.greatest(e["x1"], e["x2"]) >= x0))
    z = z.withColumn("right", right).withColumn("near", F.exists("right", lambda e: F.least(e["x1"], e["x2"]) <= x1))
    centre = geo.raycast_inside(F.col("right"), (F.col("cx") + 0.5) * c, (F.col("cy") + 0.5) * c)
    z = z.withColumn("whole", ~F.col("near") & centre).where(F.col("near") | F.col("whole"))
    z = z.withColumn("edges", F.when(F.col("whole"), F.slice("right", 1, 0)).otherwise(F.col("right")))
    cand = F.struct(F.col("zid").alias("id"), "minx", "miny", "maxx", "maxy", "whole", "edges")
    return z.groupBy("cx", "cy").agg(F.array_sort(F.collect_list(cand)).alias("candidates")).withColumn(
        "cell", F.lit(cell))


def _match_ids(index: ZoneIndex | QuadIndex, lon: str, lat: str, mode: str) -> Column:
    """Ids of the candidates that hold the point."""
    px, py = F.col(lon), F.col(lat)
    hits = F.filter(F.coalesce(F.col("candidates"), F.array()), lambda z: index.holds(z, px, py, mode))
    return F.transform(hits, lambda z: z["id"])


def lookup_zone(points: DataFrame, zones: DataFrame | ZoneIndex, lon: str, lat: str, out_col: str,
                cell: float | None = DEFAULT_CELL, mode: str = "raycast", active: Column | None = None) -> DataFrame:
    """Add ``out_col`` = smallest LocationID whose polygon contains the point.

    ``mode``: ``raycast`` (half-open, one zone per point on a tiling),
    ``within`` (boundary excluded) or ``intersects`` (boundary included).
    """
    index = zone_index(zones, cell)
    j = index.attach(points, lon, lat, active)
    return j.withColumn(out_col, F.array_min(_match_ids(index, lon, lat, mode)).cast("int")).drop("candidates")


def lookup_zone_inner(points: DataFrame, zones: DataFrame, lon: str, lat: str, out_col: str,
                      cell: float | None = DEFAULT_CELL, mode: str = "raycast") -> DataFrame:
    """Like ``lookup_zone`` but keeps only points inside some polygon.

    Implemented as a generator over a zero-or-one element array rather than a
    filter on the result: Catalyst would push such a filter below the
    projection and run the polygon test twice.
    """
    index = zone_index(zones, cell)
    j = index.attach(points, lon, lat)
    first = F.array_min(_match_ids(index, lon, lat, mode))
    one = F.filter(F.array(first), lambda v: v.isNotNull())
    return (j.select(*points.columns, F.explode(one).alias(out_col))
            .withColumn(out_col, F.col(out_col).cast("int")))


def spatial_join(points: DataFrame, zones: DataFrame, lon: str, lat: str, out_col: str = "LocationID",
                 how: str = "left", mode: str = "within", cell: float | None = DEFAULT_CELL) -> DataFrame:
    """``sjoin(points, zones, how, op)``: one output row per (point, containing zone);
    ``how='left'`` keeps unmatched points with a null id."""
    index = zone_index(zones, cell)
    j = index.attach(points, lon, lat)
    ids = _match_ids(index, lon, lat, mode)
    gen = F.explode_outer(ids) if how == "left" else F.explode(ids)
    cols = [c for c in points.columns]
    return j.select(*cols, gen.alias(out_col)).withColumn(out_col, F.col(out_col).cast("int"))


def assign_zones(df: DataFrame, zones: DataFrame, lon: str, lat: str, id_col: str,
                 cell: float | None = DEFAULT_CELL) -> DataFrame:
    """Fill missing zone ids from coordinates (the reference's ingest rule).

    Null lon/lat count as 0. Only rows with a null id and non-zero
    coordinates are looked up; existing ids are kept; a point in no zone
    stays null; on multiple matches the smallest LocationID wins.
    """
    lonv = F.coalesce(F.col(lon), F.lit(0.0))
    latv = F.coalesce(F.col(lat), F.lit(0.0))
    needy = F.col(id_col).isNull() & (lonv != 0.0) & (latv != 0.0)
    tmp_lon, tmp_lat, found = "_al_lon", "_al_lat", "_al_zone"
    p = df.withColumn(tmp_lon, lonv).withColumn(tmp_lat, latv)
    p = lookup_zone(p, zones, tmp_lon, tmp_lat, found, cell, "raycast", active=needy)
    # ``needy`` is evaluated on the original columns, which are unchanged here.
    return (p.withColumn(id_col, F.when(needy, F.col(found)).otherwise(F.col(id_col)).cast("int"))
            .drop(tmp_lon, tmp_lat, found))


def radius_pairs(left: DataFrame, right: DataFrame, l_lat: str, l_lon: str, r_lat: str, r_lon: str,
                 radius: float, how: str = "inner") -> DataFrame:
    """All (left, right) pairs within ``radius`` (Euclidean in degrees, inclusive).

    Cell size = radius, so partners sit in the 3x3 neighbourhood. The right
    side is replicated to its 9 neighbour cells; the left side is keyed by its
    own cell; the distance test is the join's residual condition. Every pair in
    a neighbourhood is compared, so this is for point lists whose spacing is
    of the order of the radius (stations), not for raw trips.
    """
    r = F.lit(radius)
    off = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    rr = (right.withColumn("_rcx", F.floor(F.col(r_lon) / r)).withColumn("_rcy", F.floor(F.col(r_lat) / r))
          .withColumn("_dx", F.explode(off)).withColumn("_dy", F.explode(off))
          .withColumn("_cx", F.col("_rcx") + F.col("_dx")).withColumn("_cy", F.col("_rcy") + F.col("_dy"))
          .drop("_rcx", "_rcy", "_dx", "_dy"))
    ll = left.withColumn("_cx", F.floor(F.col(l_lon) / r)).withColumn("_cy", F.floor(F.col(l_lat) / r))
    d_lat = ll[l_lat] - rr[r_lat]
    d_lon = ll[l_lon] - rr[r_lon]
    cond = ((ll["_cx"] == rr["_cx"]) & (ll["_cy"] == rr["_cy"])
            & (d_lat * d_lat + d_lon * d_lon <= F.lit(radius * radius)))
    out = ll.join(rr, cond, how)
    return out.drop(ll["_cx"]).drop(ll["_cy"]).drop(rr["_cx"]).drop(rr["_cy"])
