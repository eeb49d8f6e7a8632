"""An adaptive quadtree over polygon layers of uneven detail.

The layer's square is halved again and again. A cell that no edge of a polygon
comes near is either outside of it (dropped) or wholly inside (kept at that
coarse size). A border cell is split until it holds few edges, so a polygon
costs about as many rows as it has edges, whatever the others look like.

What a ray to the right of a cell meets further off is not stored as edges.
Along a ring, the crossings of edges to the right of the cell cancel but for
the ends of each chain of such edges. A cell keeps the heights of the chain
ends beside it, and one bit for those above it: at most two heights an edge
that it holds. The half-open crossing rule then gives, number for number, what
testing all edges would give.

A point has one Morton code at the finest level; its cell at a coarser level is
that code shifted. Cells of a level join on the code, one equi-join for each
level in use (as many as the layer's detail spans), none of which repeats a
row. Building is one pass over the layer, cut in two so that a polygon of very
many edges is spread over tasks once its large cells are split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.functions import geo
from urbanlens.session import reliable_checkpoint

#: A border cell is split while it holds more edges than this.
FEW_EDGES = 8
#: Cells of the finest level are 2^-26 of the layer's side.
MAX_LEVEL = 26
#: Cells are kept at every second level, which halves the joins of a lookup.
STEP = 2
#: The first pass leaves cells with at most this many edges to the second.
FIRST_PASS_EDGES = 4096
#: A polygon's cells start at its own size and are halved at least so often.
OWN_LEVELS = 3

_EDGE = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])
_CELL_FIELDS = [("zid", pa.int64()), ("level", pa.int32()), ("cx", pa.int64()), ("cy", pa.int64()), ("least", pa.int32()), ("odd", pa.int32()),
                ("heights", pa.list_(pa.float64())), ("edges", pa.list_(_EDGE))]
CELL_SCHEMA = ("zid long, level int, cx long, cy long, least int, odd int, heights array<double>, "
               "edges array<struct<x1: double, y1: double, x2: double, y2: double>>")


@dataclass(frozen=True)
class Square:
    """The square that is halved: its lower corner and its side."""

    x: float
    y: float
    side: float

    def size(self, level: int) -> float:
        return self.side / (1 << level)


class Border:
    """Edges of one polygon near one cell, with what lies to its right."""

    __slots__ = ("level", "cx", "cy", "odd", "heights", "edges")

    def __init__(self, level: int, cx: int, cy: int, odd: int, heights: np.ndarray, edges: np.ndarray):
        self.level, self.cx, self.cy, self.odd, self.heights, self.edges = level, cx, cy, odd, heights, edges

    def cell(self, square: Square, level: int, cx: int, cy: int) -> Border:
        """The part of this border that a cell inside it has."""
        size = square.size(level)
        # A margin keeps points whose cell or crossing was rounded.
        eps = size * 1e-6
        x0, x1 = square.x + cx * size - eps, square.x + (cx + 1) * size + eps
        y0, y1 = square.y + cy * size - eps, square.y + (cy + 1) * size + eps
        e = self.edges
        beside = (np.maximum(e[:, 1], e[:, 3]) >= y0) & (np.minimum(e[:, 1], e[:, 3]) <= y1)
        right = beside & (np.minimum(e[:, 0], e[:, 2]) > x1)
        near = beside & ~right & (np.maximum(e[:, 0], e[:, 2]) >= x0)
        heights = np.concatenate([self.heights, e[right, 1], e[right, 3]])
        odd = (self.odd + int((heights > y1).sum())) % 2
        values, times = np.unique(heights[(heights >= y0) & (heights <= y1)], return_counts=True)
        return Border(level, cx, cy, odd, values[times % 2 == 1], e[near])

    def children(self, square: Square) -> list[Border]:
        return [self.cell(square, self.level + 1, 2 * self.cx + i, 2 * self.cy + j) for j in (0, 1) for i in (0, 1)]

    def empty(self) -> bool:
        """Wholly outside."""
        return not len(self.edges) and not len(self.heights) and not self.odd


def start_cells(square: Square, edges: np.ndarray) -> tuple[list[Border], int]:
    """The cells of about a polygon's own size that it touches, and the level its cells are split to at least."""
    x, y = edges[:, [0, 2]], edges[:, [1, 3]]
    reach = max(float(np.ptp(x)), float(np.ptp(y)))
    own = MAX_LEVEL if reach <= 0 else min(max(int(np.floor(np.log2(square.side / reach))), 0), MAX_LEVEL)
    size, top = square.size(own), (1 << own) - 1
    span = lambda lo, hi, at: range(min(max(int((lo - at) // size), 0), top), min(max(int((hi - at) // size), 0), top) + 1)
    whole = Border(own, 0, 0, 0, np.zeros(0), edges)
    out = [whole.cell(square, own, i, j) for i in span(x.min(), x.max(), square.x) for j in span(y.min(), y.max(), square.y)]
    return [c for c in out if not c.empty()], min(own + OWN_LEVELS, MAX_LEVEL)


def split(square: Square, cells: list[Border], least: int, few: int, leave: int = 0) -> Iterator[Border]:
    """Cells that need no more splitting; with ``leave``, also those of at most so many edges that do."""
    stack = list(cells)
    while stack:
        c = stack.pop()
        n = len(c.edges)
        done = c.level >= MAX_LEVEL or c.level % STEP == 0 and (not n or n <= few and c.level >= least)
        if done or leave and n <= leave and c.level >= least:
            yield c
        else:
            stack += [d for d in c.children(square) if not d.empty()]


def _batch(rows: list[tuple[int, Border, int]]) -> pa.RecordBatch:
    cells = [c for _, c, _ in rows]
    edges = np.concatenate([c.edges for c in cells]) if cells else np.zeros((0, 4))
    ends = lambda sizes: pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    heights = np.concatenate([c.heights for c in cells]) if cells else np.zeros(0)
    structs = pa.StructArray.from_arrays([pa.array(edges[:, i]) for i in range(4)], names=["x1", "y1", "x2", "y2"])
    cols = [pa.array([z for z, _, _ in rows], pa.int64()), pa.array([c.level for c in cells], pa.int32()), pa.array([c.cx for c in cells], pa.int64()),
            pa.array([c.cy for c in cells], pa.int64()), pa.array([m for _, _, m in rows], pa.int32()), pa.array([c.odd for c in cells], pa.int32()),
            pa.ListArray.from_arrays(ends([len(c.heights) for c in cells]), pa.array(heights)),
            pa.ListArray.from_arrays(ends([len(c.edges) for c in cells]), structs)]
    return pa.RecordBatch.from_arrays(cols, schema=pa.schema(_CELL_FIELDS))


def _edges_of(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten()
    table = np.stack([flat.field(i).to_numpy(zero_copy_only=False) for i in range(4)], 1) if len(flat) else np.zeros((0, 4))
    at = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(int)
    return [table[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _grouped(cells: Iterator[tuple[int, Border, int]]) -> Iterator[pa.RecordBatch]:
    rows, edges = [], 0
    for row in cells:
        rows.append(row)
        edges += len(row[1].edges)
        if edges >= 200_000 or len(rows) >= 20_000:
            yield _batch(rows)
            rows, edges = [], 0
    if rows:
        yield _batch(rows)


def _first_pass(square: Square, leave: int):
    def cells(batches) -> Iterator[tuple[int, Border, int]]:
        for batch in batches:
            for zid, edges in zip(batch.column("zid").to_pylist(), _edges_of(batch.column("edges")), strict=True):
                edges = edges[np.isfinite(edges).all(1)]
                if zid is not None and len(edges):
                    start, least = start_cells(square, edges)
                    for c in split(square, start, least, 0, leave):
                        yield zid, c, least

    return lambda batches: _grouped(cells(batches))


def _second_pass(square: Square, few: int):
    def cells(batches) -> Iterator[tuple[int, Border, int]]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("zid", "level", "cx", "cy", "least", "odd", "heights")]
            for (zid, level, cx, cy, least, odd, heights), edges in zip(zip(*cols, strict=True), _edges_of(batch.column("edges")), strict=True):
                for c in split(square, [Border(level, cx, cy, odd, np.array(heights, float), edges)], least, few):
                    yield zid, c, least

    return lambda batches: _grouped(cells(batches))


def morton(cx: Column, cy: Column) -> Column:
    """The bits of two whole numbers below 2^31 in turn, cx's lowest first."""
    def spread(v: Column) -> Column:
        v = v.cast("bigint")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(cx).bitwiseOR(F.shiftleft(spread(cy), 1))


@dataclass(frozen=True)
class QuadIndex:
    """The cells of a layer by level; ``small`` says which levels may be broadcast."""

    cells: DataFrame
    square: Square
    levels: dict[int, bool]

    def attach(self, points: DataFrame, lon: str, lat: str, active: Column | None = None) -> DataFrame:
        """``points`` with ``candidates``: what the cells of each point, one a level, hold of polygons."""
        finest = max(self.levels, default=0)
        size, top = self.square.size(finest), (1 << finest) - 1
        at = lambda c, low: F.floor((F.col(c) - F.lit(low)) / F.lit(size))
        inside = (F.col(lon) >= self.square.x) & (F.col(lon) <= self.square.x + self.square.side) & (
            F.col(lat) >= self.square.y) & (F.col(lat) <= self.square.y + self.square.side)
        known = inside if active is None else active & inside
        code = morton(F.least(at(lon, self.square.x), F.lit(top)), F.least(at(lat, self.square.y), F.lit(top)))
        p = points.withColumn("_code", F.when(known, code))
        found = []
        for level, small in sorted(self.levels.items()):
            name, key = f"_found_{level}", f"_key_{level}"
            side = self.cells.where(F.col("level") == level).select(F.col("key").alias(key), F.col("candidates").alias(name))
            here = F.shiftright("_code", 2 * (finest - level))
            if not small:
                # Rows of no cell, spread over keys of their own.
                here = F.coalesce(here, -1 - F.pmod(F.xxhash64(lon, lat, F.monotonically_increasing_id()), F.lit(1 << 16)))
            p = p.withColumn(key, here).join(F.broadcast(side) if small else side, key, "left").drop(key)
            found.append(name)
        none = F.array().cast(self.cells.schema["candidates"].dataType)
        merged = F.concat(*[F.coalesce(F.col(f), none) for f in found]) if found else none
        return p.withColumn("candidates", merged).drop("_code", *found)

    @staticmethod
    def holds(z: Column, px: Column, py: Column, mode: str) -> Column:
        """Whether a candidate's polygon holds the point, under ``mode`` (see ``spatial.lookup_zone``)."""
        crossings = (F.size(F.filter(z["edges"], lambda e: geo._crosses(e, px, py))) + F.size(F.filter(z["heights"], lambda h: h > py)) + z["odd"])
        inside = crossings % 2 == 1
        if mode == "raycast":
            return inside
        border = geo.on_boundary(z["edges"], px, py)
        return inside & ~border if mode == "within" else inside | border


def quad_index(zones: DataFrame, id_col: str = "LocationID", rings_col: str = "rings", few: int = FEW_EDGES,
               broadcast_bytes: int = 64 * 1024 * 1024) -> QuadIndex:
    """Index a layer of polygons (closed rings). The driver gets the layer's box and one row a level.

    Polygons without an id or without points are left out; an empty layer
    holds no point. The cells are written to the shared checkpoint folder once.
    """
    edges = zones.select(F.col(id_col).cast("long").alias("zid"), geo.ring_edges(F.col(rings_col)).alias("edges"))
    minx, miny, maxx, maxy = geo.ring_bbox(F.col(rings_col))
    box = zones.agg(F.min(minx).alias("x0"), F.min(miny).alias("y0"), F.max(maxx).alias("x1"), F.max(maxy).alias("y1")).first()
    if box["x0"] is None:
        square = Square(0.0, 0.0, 1.0)
    else:
        square = Square(box["x0"], box["y0"], max(box["x1"] - box["x0"], box["y1"] - box["y0"]) or 1.0)
    coarse = edges.mapInArrow(_first_pass(square, FIRST_PASS_EDGES), CELL_SCHEMA)
    width = int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fine = coarse.repartition(width, "zid", "level", "cx", "cy").mapInArrow(_second_pass(square, few), CELL_SCHEMA)
    candidate = F.struct(F.col("zid").alias("id"), "odd", "heights", "edges")
    cells = fine.withColumn("key", morton(F.col("cx"), F.col("cy"))).groupBy("level", "key").agg(F.collect_list(candidate).alias("candidates"))
    cells = reliable_checkpoint(cells)
    stored = F.aggregate("candidates", F.lit(0).cast("bigint"), lambda a, c: a + 32 + 8 * F.size(c["heights"]) + 48 * F.size(c["edges"]))
    sizes = cells.groupBy("level").agg(F.sum(stored + 64).alias("bytes")).collect()   # one row a level
    return QuadIndex(cells, square, {r["level"]: r["bytes"] <= broadcast_bytes for r in sizes})
