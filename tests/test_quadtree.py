"""The quadtree over polygon layers, against a test of every edge."""

from __future__ import annotations

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanlens.functions import geo
from urbanlens.operators import quadtree as Q
from urbanlens.operators import spatial as SP

SCHEMA = "LocationID int, rings array<array<struct<x:double,y:double>>>"


def star(n, cx, cy, r, spikes=9, depth=0.3):
    pts = [(cx + r * (1 + depth * math.sin(spikes * a)) * math.cos(a), cy + r * (1 + depth * math.cos(spikes * a)) * math.sin(a))
           for a in (2 * math.pi * i / n for i in range(n))]
    return pts + pts[:1]


def layer(spark, polygons):
    return spark.createDataFrame([(i, [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]) for i, rings in polygons], SCHEMA)


def inside(rings, x, y):
    """Half-open ray casting over all edges, in numpy."""
    odd = np.zeros(len(x), bool)
    for r in rings:
        for (x1, y1), (x2, y2) in zip(r[:-1], r[1:], strict=True):
            across = (y1 > y) != (y2 > y)
            if across.any():
                odd[across] ^= x[across] < (x2 - x1) * (y[across] - y1) / (y2 - y1) + x1
    return odd


def test_uneven_layer(spark):
    """From 4 to 40,000 edges in one layer; holes, overlaps and islands."""
    polygons = [(1, [star(40_000, 0, 0, 1.0, 40)]), (2, [star(3000, 1.5, 0.2, 0.9), star(500, 1.5, 0.2, 0.4)]), (3, [star(10, 3, 1, 0.01)]),
                (4, [[(2, -1), (3, -1), (3, 0), (2, 0), (2, -1)]]), (5, [star(12, 0.3, 0.1, 0.02), star(11, -2, -1, 0.3)]), (6, [star(2000, 0, 0, 2.5)])]
    index = Q.quad_index(layer(spark, polygons))
    rng = np.random.default_rng(5)
    x, y = rng.uniform(-3, 4, 4000), rng.uniform(-3, 3, 4000)
    # Near the most detailed border, where a wrong edge would show.
    a = rng.uniform(0, 2 * np.pi, 3000)
    r = rng.normal(1, 1e-4, 3000)
    x = np.concatenate([x, r * (1 + 0.3 * np.sin(40 * a)) * np.cos(a)])
    y = np.concatenate([y, r * (1 + 0.3 * np.cos(40 * a)) * np.sin(a)])
    pts = spark.createDataFrame([(i, float(u), float(v)) for i, (u, v) in enumerate(zip(x, y, strict=True))], "pid int, x double, y double")
    got = {r.pid: sorted(r.ids) for r in pts.transform(lambda p: index.attach(p, "x", "y")).select(
        "pid", SP._match_ids(index, "x", "y", "raycast").alias("ids")).collect()}
    hits = {z: inside(rings, x, y) for z, rings in polygons}
    assert got == {i: [z for z, _ in polygons if hits[z][i]] for i in range(len(x))}


def test_work_follows_the_edges(spark):
    """Rows and stored edges stay a small multiple of the edges, for smooth and for spiky borders."""
    for n, spikes in ((100, 3), (10_000, 3), (100_000, 200)):
        index = Q.quad_index(layer(spark, [(1, [star(n, 0, 0, 1, spikes)])]))
        c = index.cells.select(F.explode("candidates").alias("c")).select(F.size("c.edges").alias("e"), F.size("c.heights").alias("h")).agg(
            F.count("*").alias("cells"), F.sum("e").alias("e"), F.sum("h").alias("h"), F.max("h").alias("most"), F.max("e").alias("few")).first()
        assert c.cells < 5 * n + 400 and c.e < 6 * n + 600 and c.h < c.e and c.few <= Q.FEW_EDGES and c.most <= 2 * Q.FEW_EDGES


@pytest.mark.parametrize("small", [True, False])
def test_points_on_vertices_and_edges(spark, small):
    """On a grid where points meet corners, edges and horizontal sides; broadcast or shuffled."""
    rnd = random.Random(2)
    polygons = []
    for i in range(25):
        x, y, w, h = rnd.randrange(8), rnd.randrange(8), rnd.randrange(1, 4), rnd.randrange(1, 4)
        polygons.append((i, [[(x, y), (x + w, y), (x + w, y + h / 2), (x + w / 2, y + h), (x, y + h), (x, y)]]))
    zones = layer(spark, polygons)
    pts = spark.createDataFrame([(i * 100 + j, i / 4, j / 4) for i in range(-3, 50) for j in range(-3, 50)] + [(-9, None, 1.0), (-8, 2.0, None)], "pid int, x double, y double")
    index = Q.quad_index(zones, few=2)
    if not small:
        index = replace(index, levels=dict.fromkeys(index.levels, False))
    edges = zones.select("LocationID", geo.ring_edges("rings").alias("edges"))
    for mode, pred in (("raycast", geo.raycast_inside), ("within", geo.within), ("intersects", geo.intersects)):
        want = pts.join(F.broadcast(edges), pred(F.col("edges"), F.col("x"), F.col("y"))).select("pid", "LocationID").collect()
        got = SP.spatial_join(pts, index, "x", "y", how="inner", mode=mode).select("pid", "LocationID").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 300
        # Every point comes back once.
        assert SP.lookup_zone(pts, index, "x", "y", "z", mode=mode).count() == pts.count()


def test_morton_codes(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 5), (2**26 - 1, 2**25 + 12345)], "a long, b long")
    want = [sum(((a >> k & 1) << 2 * k) | ((b >> k & 1) << 2 * k + 1) for k in range(31)) for a, b in df.collect()]
    assert [r[0] for r in df.select(Q.morton(F.col("a"), F.col("b"))).collect()] == want


def test_odd_layers(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, None, None)], "pid int, x double, y double")
    for polygons in ([], [(1, [])], [(None, [star(5, 0, 0, 1)])]):
        assert SP.spatial_join(pts, Q.quad_index(layer(spark, polygons)), "x", "y", how="inner").count() == 0
    dot = Q.quad_index(layer(spark, [(1, [[(0.5, 0.5)] * 4]), (2, [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]])]))
    assert [r.z for r in SP.lookup_zone(pts, dot, "x", "y", "z").orderBy("pid").collect()] == [2, None]
    assert sorted(r.LocationID for r in SP.spatial_join(pts, dot, "x", "y", how="inner", mode="intersects").collect()) == [1, 2]


def test_layer_chooses_its_index(spark):
    """A layer that would make too many cells of one size gets a quadtree."""
    even = layer(spark, [(i, [star(8, i % 5, i // 5, 0.4)]) for i in range(25)])
    uneven = even.unionByName(layer(spark, [(99, [star(20_000, 60, 60, 55)])]))
    assert isinstance(SP.zone_index(even), SP.ZoneIndex) and isinstance(SP.zone_index(uneven), Q.QuadIndex)
