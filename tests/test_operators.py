"""Operators against brute force on small inputs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql import Window

from urbanlens.functions.geo import ring_edges
from urbanlens.operators import histogram as H
from urbanlens.operators import joins as J
from urbanlens.operators import spatial as SP
from urbanlens.operators import windows as W
from urbanlens.sources import fixtures as fx
from urbanlens.sources import readers as RD


def test_dense_ids_match_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, tie int").repartition(5)
    got = W.dense_ids(df, ["k", "tie"], "rid", num_partitions=7)
    ref = df.withColumn("rid", F.row_number().over(Window.orderBy("k", "tie")).cast("bigint"))
    assert sorted(got.collect()) == sorted(ref.collect())


def test_counter_delta_hot_key_spans_buckets(spark):
    """A key with most of the rows is cut into buckets; gaps of several buckets, nulls and a null time are stitched."""
    rows = [("hot", t, t * 3) for t in range(5000)] + [("cold", t, t) for t in range(10)] + [("gaps", t, t) for t in (0, 1, 950, 951, 30_000)]
    rows += [("gaps", None, -7), (None, 1, 1), (None, 2, 1), ("one", 5, 5), ("null", 1, 4), ("null", 150, None), ("null", 151, 9), ("null", 152, 10)]
    df = spark.createDataFrame(rows, "k string, t int, c bigint").repartition(6)
    d = W.counter_delta(df, ["k"], ["t"], ["c"], bucket=F.floor(F.col("t") / 100))
    w = Window.partitionBy("k").orderBy("t")
    ref = df.where("k IS NOT NULL").select("k", "t", (F.col("c") - F.lag("c").over(w)).alias("c"), F.row_number().over(w).alias("n")).where("n > 1").drop("n")
    key = lambda r: (r.k, r.t is not None, r.t or 0)
    assert sorted(d.collect(), key=key) == sorted(ref.collect(), key=key) and d.count() == 4999 + 9 + 5 + 3
    plan = d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "rangepartitioning" not in plan and "CheckpointRDD" not in plan


def test_counter_delta_shuffles_rows_once(spark):
    """The rows lie by (key, bucket) for the windows, the bucket ends and the join alike."""
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("t"), F.col("id").alias("c"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = W.counter_delta(df, ["k"], ["t"], ["c"], bucket=F.floor(F.col("t") / 100))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # Once for the rows, once for the ends by key, once for them by (key, bucket); the second use of the rows is the first's.
    assert plan.count("ReusedExchange") == 1
    assert sum(line.lstrip(" :+-").startswith("Exchange hashpartitioning") for line in plan.splitlines()) == 3


def _pip(x, y, edges):
    inside = False
    for x1, y1, x2, y2 in edges:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def test_lookup_zone_matches_brute_force(spark):
    zones = fx.zones(spark)
    edges = {r.LocationID: [(e.x1, e.y1, e.x2, e.y2) for e in r.edges]
             for r in zones.select("LocationID", ring_edges("rings").alias("edges")).collect()}
    rnd = random.Random(3)
    pts = [(i, -74.3 + rnd.random() * 0.6, 40.45 + rnd.random() * 0.55) for i in range(2000)]
    df = spark.createDataFrame(pts, "pid int, x double, y double")
    got = {r.pid: r.z for r in SP.lookup_zone(df, zones, "x", "y", "z").collect()}
    for pid, x, y in pts:
        hits = [z for z, e in edges.items() if _pip(x, y, e)]
        assert got[pid] == (min(hits) if hits else None)


def test_radius_pairs_match_cross_product(spark):
    rnd = random.Random(11)
    a = [(i, 40.7 + rnd.random() * 0.01, -74.0 + rnd.random() * 0.01) for i in range(400)]
    b = [(j, 40.7 + rnd.random() * 0.01, -74.0 + rnd.random() * 0.01) for j in range(300)]
    r = 0.0005
    left = spark.createDataFrame(a, "id int, lat double, lon double")
    right = spark.createDataFrame(b, "sid int, la double, lo double")
    got = {(x.id, x.sid) for x in SP.radius_pairs(left, right, "lat", "lon", "la", "lo", r).collect()}
    want = {(i, j) for i, la, lo in a for j, lb, lob in b if (la - lb) ** 2 + (lo - lob) ** 2 <= r * r}
    assert got == want and len(want) > 0


def test_joins_run_nothing_and_keep_names(spark):
    t = spark.range(10)
    a = J.join_left_keys(t.select(F.col("id").alias("k")), t.select((F.col("id") * 2).alias("x")), "k", "x")
    b = J.semi_join(t.select(F.col("id").alias("k")), t.select((F.col("id") * 2).alias("y")), "k", "y")
    assert a.columns == ["k"] and b.columns == ["k"] and b.count() == 5
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_fixed_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.49,), (0.5,), (6.99,), (7.0,), (7.01,), (-0.1,)], "x double")
    h = {r.bin: r.n for r in H.fixed_histogram(df, "x", 0.0, 0.5, 14).collect()}
    assert h == {0: 2, 1: 1, 13: 2}


def test_url_catalog(spark):
    lines = spark.createDataFrame([
        ("https://x/trip+data/yellow_tripdata_2015-03.csv",),
        ("https://x/tripdata/201307-citibike-tripdata.zip",),
        ("https://x/uber-raw-data-apr14.csv",),
        ("",)], "value string")
    got = sorted((r.kind, r.year, r.month) for r in RD.url_catalog(lines).collect())
    assert got == [("citibike", 2013, 7), ("uber", 2014, 4), ("yellow", 2015, 3)]


def test_link_manifest_skips_present(spark):
    pages = spark.createDataFrame([
        (1, '<a href="data/turnstile_170422.txt">Saturday, April 22, 2017</a>'
            '<a href="data/turnstile_170415.txt">Saturday, April 15, 2017</a><a href="/x">About</a>')],
        "page_id bigint, html string")
    present = spark.createDataFrame([("turnstile_170415.txt.gz",)], "name string")
    got = [(r.file_name, str(r.file_date)) for r in RD.link_manifest(pages, present).collect()]
    assert got == [("turnstile_170422.txt", "2017-04-22")]


def test_lookup_zone_shuffle_fallback_matches_broadcast(spark, monkeypatch):
    """Over the broadcast bound the cell table is joined with a shuffle on the
    cell key; the answer must not change."""
    zones = fx.zones(spark)
    rnd = random.Random(5)
    pts = spark.createDataFrame([(i, -74.3 + rnd.random() * 0.6, 40.45 + rnd.random() * 0.55) for i in range(3000)],
                                "pid int, x double, y double")
    fast = {r.pid: r.z for r in SP.lookup_zone(pts, zones, "x", "y", "z").collect()}
    monkeypatch.setattr(SP, "MAX_BROADCAST_BYTES", 1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        slow_df = SP.lookup_zone(pts, zones, "x", "y", "z")
        plan = slow_df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        slow = {r.pid: r.z for r in slow_df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert slow == fast


def test_running_sums_hot_key(spark):
    """Block-wise running sums equal a per-key window, with one key holding
    most rows and blocks much smaller than that key."""
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 20)}", i, rnd.randint(0, 9)) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = W.running_sums(df, ["k"], ["t"], {"cs": "v", "rn": F.lit(1)}, block_rows=377)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("k", "t", "v", F.sum("v").over(w).alias("cs"), F.count(F.lit(1)).over(w).alias("rn"))
    key = ("k", "t", "v", "cs", "rn")
    assert sorted(tuple(r[c] for c in key) for r in got.collect()) == sorted(tuple(r[c] for c in key) for r in ref.collect())


def _ring(n, cx, cy, rx, ry):
    import math

    pts = [(cx + rx * (1 + 0.15 * math.sin(9 * a)) * math.cos(a), cy + ry * (1 + 0.15 * math.sin(7 * a)) * math.sin(a))
           for a in (2 * math.pi * i / n for i in range(n))]
    return pts + pts[:1]


def test_many_edged_polygons_match_full_edge_test(spark):
    """Clipped edges and whole cells give the answers of all edges, for every mode."""
    from urbanlens.functions import geo

    rings = [[_ring(400, 0.0, 0.0, 1.0, 0.8), _ring(60, 0.1, 0.1, 0.3, 0.2)], [_ring(350, 0.6, 0.3, 0.9, 0.9)], [[(2.0, 0.0), (3.0, 0.0), (3.0, 1.0), (2.0, 1.0), (2.0, 0.0)]]]
    zones = spark.createDataFrame([(i + 1, [[{"x": x, "y": y} for x, y in r] for r in z]) for i, z in enumerate(rings)],
                                  "LocationID int, rings array<array<struct<x:double,y:double>>>")
    rnd = random.Random(9)
    pts = [(i, rnd.uniform(-1.5, 3.5), rnd.uniform(-1.5, 1.5)) for i in range(1500)] + [(5000 + i, 2.0 + i / 8, j) for i in range(9) for j in (0.0, 1.0)]
    pts = spark.createDataFrame([(i, x, y) for i, (_, x, y) in enumerate(pts)], "pid int, x double, y double")
    edges = zones.select("LocationID", geo.ring_edges("rings").alias("edges"))
    for mode, pred in (("raycast", geo.raycast_inside), ("within", geo.within), ("intersects", geo.intersects)):
        want = pts.join(F.broadcast(edges), pred(F.col("edges"), F.col("x"), F.col("y"))).groupBy("pid").agg(F.min("LocationID").alias("z"))
        want = {r.pid: r.z for r in want.collect()}
        for cell in (None, 0.07, 0.5):
            got = {r.pid: r.z for r in SP.lookup_zone(pts, zones, "x", "y", "z", cell, mode).collect() if r.z is not None}
            assert got == want


def test_inactive_rows_do_not_share_a_key(spark):
    """In a shuffle they are spread; with a broadcast they have no key and no column but the coordinates is read."""
    from dataclasses import replace

    pts = spark.range(1000).select("id", F.lit(None).cast("double").alias("x"), F.lit(1.0).alias("y"))
    index = SP.zone_index(fx.zones(spark))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = replace(index, max_bytes=1e18).attach(pts, "x", "y").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == 8 and max(r["count"] for r in rows) < 250
    assert "xxhash64" not in index.attach(pts, "x", "y")._jdf.queryExecution().executedPlan().toString()


def test_dense_square_keeps_the_total(spark):
    from urbanlens.operators import aggregate as A

    counts = spark.createDataFrame([(1, 2, 5), (300, 2, 7), (-1, 0, 1)], "i int, j int, n bigint")
    out = A.dense_square(counts, "i", "j", "n", 268)
    assert out.agg(F.sum("n")).first()[0] == 13 and out.count() == 268 * 268 + 2


def test_map_partitions_sees_whole_partitions(spark):
    from urbanlens.operators.partitions import map_batches, map_partitions

    def count(batches):
        import pandas as pd

        yield pd.DataFrame({"n": [sum(len(b) for b in batches)]})

    df = spark.range(0, 5000, 1, 2)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("100", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert [r.n for r in map_partitions(df, count, "n long").collect()] == [2500, 2500]
            assert map_batches(df, lambda b: b.assign(id=b.id + 1), "id long").agg(F.sum("id")).first()[0] == sum(range(1, 5001))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_times_without_seconds_and_with_fractions(spark):
    from urbanlens.functions import timeparts as T

    df = spark.createDataFrame([("1/1/2015 0:01",), ("2016-01-01 00:00:41.0",), ("2016-01-01 00:00:41.250",), ("2/30/2015 1:00",), ("x",), ("",), (None,)], "s string")
    t = T.parse_datetime_flexible("s", ("MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss"))
    got = [(str(r.t) if r.t else None, r.bad) for r in df.select(t.alias("t"), T.unparsed("s", t).alias("bad")).collect()]
    assert got == [("2015-01-01 00:01:00", False), ("2016-01-01 00:00:41", False), ("2016-01-01 00:00:41.250000", False),
                   (None, True), (None, True), (None, False), (None, None)]


def test_defunct_trips_drop_duplicate_rows(spark, sf):
    from urbanlens.operators import stations as S

    cb = fx.citibike(spark, sf)
    defunct = S.defunct_stations(S.trip_points(cb), fx.stations(spark, sf))
    once = S.defunct_trips(cb, defunct).count()
    assert S.defunct_trips(cb.unionAll(cb), defunct).count() == once > 0


def test_station_list_grows_with_part(spark, sf):
    parts = spark.read.parquet(f"{sf}/part.parquet").where("p_partkey % 4 <> 0").count()
    assert fx.stations(spark, sf).count() == parts


def test_layout_orders(spark, sf):
    """What the row-set oracles cannot see: the order inside and across partitions."""
    from urbanlens.operators import layout as L

    t = fx.trips(spark, sf).select("trip_id", "pickup_datetime")
    ranged = L.range_index(t, "pickup_datetime", 6, tiebreak="trip_id").withColumn("p", F.spark_partition_id()).collect()
    keys = [(r.p, r.pickup_datetime, r.trip_id) for r in ranged]
    assert keys == sorted(keys) and [k[1:] for k in keys] == sorted(k[1:] for k in keys) and len({k[0] for k in keys}) > 1
    inside = t.repartition(5).sortWithinPartitions("pickup_datetime").withColumn("p", F.spark_partition_id()).collect()
    assert all(a.p != b.p or a.pickup_datetime <= b.pickup_datetime for a, b in zip(inside, inside[1:]))


def test_kmeans_labels_feed_the_rollup(spark, sf):
    from urbanlens.operators import clusters as CL
    from urbanlens.plans import q_aggregate as QA, q_stats as QS

    points, centers = QS.zone_clusters(spark, sf, rounds=3)
    labels = points.select("LocationID", CL.nearest(F.col("x"), F.col("y"), centers).alias("labels"))
    out = QA.od_cluster_rollup(spark, sf, labels)
    plain = QA.od_cluster_rollup(spark, sf)
    assert len(centers) == 45 and out.agg(F.sum("n_trips")).first()[0] == plain.agg(F.sum("n_trips")).first()[0] > 0


def test_key_sample_ignores_the_layout(spark):
    from urbanlens.operators import stats as ST

    df = spark.range(20000)
    a = {r.id for r in ST.sample_by_key(df, "id", 0.1, 42).collect()}
    b = {r.id for r in ST.sample_by_key(df.repartition(13), "id", 0.1, 42).collect()}
    assert a == b and 1800 < len(a) < 2200 and a != {r.id for r in ST.sample_by_key(df, "id", 0.1, 7).collect()}


def test_layout_follows_the_file_name():
    from urbanlens.sources import eras as E, raw as R

    names = [(e, n) for e, group in enumerate(R.ERA_FILES) for n in group] + [(None, "fhv_tripdata_2016-01.csv"), (7, "uber-raw-data-sep14.csv")]
    assert all(E.layout_of(f"s3://data/x/{n}") == e for e, n in names)
    assert len(R.ERA_FILES) == len(E.LAYOUTS) == 9


def test_unknown_trip_files_are_returned(spark, tmp_path):
    from urbanlens.sources import eras as E

    (tmp_path / "fhv_tripdata_2016-01.csv").write_text("a,b\n1,2\n")
    (tmp_path / "uber-raw-data-janjune-15.csv").write_text("x,Pickup_date,y,locationID\nB1,5/17/2015 9:47,B2,141\nB1,bad,B2,65\n")
    known, unknown = E.read_trip_files(spark, str(tmp_path))
    assert [r.c0 for r in unknown.collect()] == ["1"]
    assert sorted((str(r.pickup_datetime), r.pickup_taxizone_id, r.vendor_id) for r in known.collect()) == [("2015-05-17 09:47:00", 141, None), ("None", 65, None)]
    (tmp_path / "none").mkdir()
    assert [f.count() for f in E.read_trip_files(spark, str(tmp_path / "none"))] == [0, 0]
