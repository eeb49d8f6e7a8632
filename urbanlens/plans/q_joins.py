"""Section 2.4: joins, spatial joins and radius matching."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from urbanlens.operators import joins as J
from urbanlens.operators import spatial as SP
from urbanlens.operators import stations as S
from urbanlens.operators.layout import save_bucketed_table
from urbanlens.operators.quadtree import quad_index
from urbanlens.plans.registry import query
from urbanlens.plans.sqlbits import pip_pairs_sql, pip_sql
from urbanlens.session import scratch_path
from urbanlens.sources import fixtures as fx

SEC = "2.4"

_OD = """od AS (SELECT coalesce(pickup_taxizone_id, 266) AS pickup_taxizone_id,
  coalesce(dropoff_taxizone_id, 266) AS dropoff_taxizone_id, count(*) AS n_trips
  FROM trips WHERE trip_type IS DISTINCT FROM 'uber' GROUP BY 1, 2)"""


@query("join_left_equi", section=SEC, sql=f"""
WITH {_OD}
SELECT od.*, z.borough FROM od LEFT JOIN zones z ON od.pickup_taxizone_id = z.LocationID""")
def join_left_equi(spark, sf):
    """Left merge on differently named keys, right key dropped."""
    from urbanlens.operators.aggregate import od_counts

    od = od_counts(fx.trips(spark, sf), "pickup_taxizone_id", "dropoff_taxizone_id", count_col="trip_id")
    z = fx.zones(spark).select("LocationID", "borough")
    return J.join_left_keys(od, z, "pickup_taxizone_id", "LocationID")


@query("join_inner_equi", section=SEC, sql="""
SELECT t.trip_id, z.zone, z.borough FROM trips t JOIN zones z ON t.pickup_taxizone_id = z.LocationID""")
def join_inner_equi(spark, sf):
    t = fx.trips(spark, sf).select("trip_id", "pickup_taxizone_id")
    z = F.broadcast(fx.zones(spark).select("LocationID", "zone", "borough"))   # 260 zones by construction
    return t.join(z, t["pickup_taxizone_id"] == z["LocationID"], "inner").select("trip_id", "zone", "borough")


@query("join_inner_composite", section=SEC, sql="""
WITH c AS (SELECT ride_id, start_station_id, trim(start_station_name, '"') AS sn, end_station_id, trim(end_station_name, '"') AS en FROM bike)
SELECT c.ride_id, s.latitude AS start_lat_current, e.latitude AS end_lat_current
FROM c JOIN stations s ON c.start_station_id = s.id AND c.sn = s.stationName
JOIN stations e ON c.end_station_id = e.id AND c.en = e.stationName""")
def join_inner_composite(spark, sf):
    """Two-key (id, name) inner merges on the start and the end side."""
    c = fx.citibike(spark, sf).select("ride_id", "start_station_id", "start_station_name",
                                      "end_station_id", "end_station_name")
    st = fx.stations(spark, sf)
    s = st.select(F.col("id").alias("start_station_id"), F.col("stationName").alias("start_station_name"),
                  F.col("latitude").alias("start_lat_current"))
    e = st.select(F.col("id").alias("end_station_id"), F.col("stationName").alias("end_station_name"),
                  F.col("latitude").alias("end_lat_current"))
    return (c.join(s, ["start_station_id", "start_station_name"], "inner")
            .join(e, ["end_station_id", "end_station_name"], "inner")
            .select("ride_id", "start_lat_current", "end_lat_current"))


@query("join_left_index", section=SEC, sql="""
WITH c AS (SELECT dropoff_taxizone_id, count(*) AS n FROM trips WHERE dropoff_taxizone_id IS NOT NULL GROUP BY 1)
SELECT z.LocationID, c.n FROM zones z LEFT JOIN c ON z.LocationID = c.dropoff_taxizone_id""")
def join_left_index(spark, sf):
    """Every polygon (the index) left-joined to its counts; no trips gives null."""
    t = fx.trips(spark, sf).where(F.col("dropoff_taxizone_id").isNotNull())
    c = t.groupBy(F.col("dropoff_taxizone_id").alias("LocationID")).agg(F.count(F.lit(1)).alias("n"))
    return fx.zones(spark).select("LocationID").join(c, "LocationID", "left")


@query("join_left_filtered", section=SEC, sql=f"""
WITH pts AS (SELECT trip_id, pickup_longitude AS lon, pickup_latitude AS lat FROM trips),
loc AS {pip_sql('pts', 'trip_id', 'lon', 'lat')}
SELECT t.trip_id, t.pickup_datetime, loc.zid AS pickup_zone FROM trips t LEFT JOIN loc ON t.trip_id = loc.trip_id
WHERE t.trip_type = 'uber'""")
def join_left_filtered(spark, sf):
    """Ride-hail trips left-joined by trip id to the per-trip location table."""
    t = fx.trips(spark, sf)
    loc = SP.lookup_zone(t.select("trip_id", "pickup_longitude", "pickup_latitude"), fx.zones(spark),
                         "pickup_longitude", "pickup_latitude", "pickup_zone").select("trip_id", "pickup_zone")
    return (t.join(loc, "trip_id", "left").where(F.col("trip_type") == "uber")
            .select("trip_id", "pickup_datetime", "pickup_zone"))


@query("join_outer_equi", section=SEC, sql="""
WITH g AS (SELECT pickup_taxizone_id AS z, count(*) AS n_green FROM trips WHERE trip_type = 'green' GROUP BY 1),
y AS (SELECT dropoff_taxizone_id AS z, count(*) AS n_yellow FROM trips WHERE trip_type = 'yellow' GROUP BY 1)
SELECT coalesce(g.z, y.z) AS taxizone_id, g.n_green, y.n_yellow FROM g FULL OUTER JOIN y ON g.z = y.z""")
def join_outer_equi(spark, sf):
    """Outer merge of per-source counts keyed by zone: green pickups and
    yellow drop-offs. Null zones never match, so each side keeps its own
    null-zone row."""
    t = fx.trips(spark, sf)
    g = (t.where(F.col("trip_type") == "green").groupBy(F.col("pickup_taxizone_id").alias("zg"))
         .agg(F.count(F.lit(1)).alias("n_green")))
    y = (t.where(F.col("trip_type") == "yellow").groupBy(F.col("dropoff_taxizone_id").alias("zy"))
         .agg(F.count(F.lit(1)).alias("n_yellow")))
    return g.join(y, F.col("zg") == F.col("zy"), "full").select(
        F.coalesce("zg", "zy").alias("taxizone_id"), "n_green", "n_yellow")


def _layer_sql(end: str, layer: str) -> str:
    edges = "zone_edges" if layer == "zone" else "tract_edges"
    pts = f"(SELECT trip_id, {end}_longitude AS lon, {end}_latitude AS lat FROM trips WHERE {end}_longitude IS NOT NULL)"
    return f"(SELECT trip_id, zid AS {end}_{layer} FROM {pip_sql(pts, 'trip_id', 'lon', 'lat', edges)})"


@query("join_full_outer_using", section=SEC, sql=f"""
SELECT * FROM {_layer_sql('pickup', 'zone')} a
FULL OUTER JOIN {_layer_sql('dropoff', 'zone')} b USING (trip_id)
FULL OUTER JOIN {_layer_sql('pickup', 'tract')} c USING (trip_id)
FULL OUTER JOIN {_layer_sql('dropoff', 'tract')} d USING (trip_id)""")
def join_full_outer_using(spark, sf):
    """Four per-end location tables (inner spatial matches) recombined as with
    ``FULL OUTER JOIN ... USING (trip_id)``. They are saved in buckets of the trip
    id, like the list of trips, so that putting them together shuffles nothing."""
    t = fx.trips(spark, sf)
    tag = uuid.uuid4().hex[:8]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def saved(df, name):
        name = f"{name}_{tag}"
        save_bucketed_table(df, name, "trip_id", buckets, scratch_path(spark, name))
        return spark.table(name)

    layers = [("zone", SP.zone_index(fx.zones(spark))), ("tract", SP.zone_index(fx.tracts(spark)))]
    parts = {}
    for end in ("pickup", "dropoff"):
        pts = t.select("trip_id", f"{end}_longitude", f"{end}_latitude").where(F.col(f"{end}_longitude").isNotNull())
        for layer, poly in layers:
            m = SP.lookup_zone_inner(pts, poly, f"{end}_longitude", f"{end}_latitude", f"{end}_{layer}")
            parts[f"{end}_{layer}"] = saved(m.select("trip_id", f"{end}_{layer}"), f"trip_{end}_{layer}")
    order = ["pickup_zone", "dropoff_zone", "pickup_tract", "dropoff_tract"]
    return J.join_all_using(saved(t.select("trip_id"), "trip_ids"), [parts[k] for k in order], "trip_id")


@query("semi_join", section=SEC, sql="""
WITH busy AS (SELECT start_station_id FROM bike WHERE (dayofweek(start_time) + 6) % 7 < 5
              GROUP BY start_station_id HAVING count(*) > 100)
SELECT ride_id, start_station_id FROM bike WHERE start_station_id IN (SELECT start_station_id FROM busy)""")
def semi_join(spark, sf, threshold: int = 100):
    """Trips starting at a busy station (more than ``threshold`` business-day
    starts); the busy set stays distributed (left-semi join)."""
    from urbanlens.functions.timeparts import is_business_day

    b = fx.bike(spark, sf)
    busy = (b.where(is_business_day("start_time")).groupBy("start_station_id")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > threshold).select("start_station_id"))
    return J.semi_join(b.select("ride_id", "start_station_id"), busy, "start_station_id", "start_station_id")


@query("anti_join", section=SEC, sql="""
SELECT ride_id, start_station_id, end_station_id FROM bike
WHERE start_station_id NOT IN (SELECT id FROM stations) AND end_station_id NOT IN (SELECT id FROM stations)""")
def anti_join(spark, sf):
    """Rows with no partner on either side: two left-anti joins."""
    b = fx.bike(spark, sf).select("ride_id", "start_station_id", "end_station_id")
    ids = fx.stations(spark, sf).select("id")
    return J.anti_join(J.anti_join(b, ids, "start_station_id", "id"), ids, "end_station_id", "id")


def _pts_with_vertices(spark, sf):
    """Trip pickup points plus one polygon corner per used zone (boundary cases)."""
    t = fx.trips(spark, sf).select(F.col("trip_id").alias("pid"), F.col("pickup_longitude").alias("lon"),
                                   F.col("pickup_latitude").alias("lat"))
    z = fx.zones(spark)
    used = fx.trips(spark, sf).select(F.col("pickup_taxizone_id").alias("LocationID")).distinct()
    v = z.join(used, "LocationID", "left_semi").select(
        (-F.col("LocationID").cast("bigint")).alias("pid"), F.col("rings")[0][0]["x"].alias("lon"),
        F.col("rings")[0][0]["y"].alias("lat"))
    return t.unionByName(v)


_PTS_V_SQL = """pts AS (SELECT trip_id AS pid, pickup_longitude AS lon, pickup_latitude AS lat FROM trips
  UNION ALL SELECT -CAST(e.LocationID AS BIGINT), e.x1, e.y1 FROM zone_edges e
  WHERE e.k = 0 AND e.LocationID IN (SELECT pickup_taxizone_id FROM trips))"""


@query("spatial_within", section=SEC, sql=f"""
WITH {_PTS_V_SQL}, hit AS {pip_pairs_sql('pts', 'pid', 'lon', 'lat', 'within')}
SELECT pts.pid, CAST(hit.zid AS INTEGER) AS LocationID FROM pts LEFT JOIN hit ON pts.pid = hit.pid""")
def spatial_within(spark, sf):
    """``sjoin(points, zones, how='left', op='within')``: boundary points match nothing."""
    return SP.spatial_join(_pts_with_vertices(spark, sf), fx.zones(spark), "lon", "lat", how="left",
                           mode="within").select("pid", "LocationID")


@query("spatial_intersects", section=SEC, sql=f"""
WITH {_PTS_V_SQL}, hit AS {pip_pairs_sql('pts', 'pid', 'lon', 'lat', 'intersects')}
SELECT pts.pid, CAST(hit.zid AS INTEGER) AS LocationID FROM pts LEFT JOIN hit ON pts.pid = hit.pid""")
def spatial_intersects(spark, sf):
    """Same with the boundary included: a shared corner matches every zone around it."""
    return SP.spatial_join(_pts_with_vertices(spark, sf), fx.zones(spark), "lon", "lat", how="left",
                           mode="intersects").select("pid", "LocationID")


@query("assign_zones", section=SEC, sql=f"""
WITH pu AS (SELECT trip_id, coalesce(pickup_longitude, 0.0::DOUBLE) AS lon, coalesce(pickup_latitude, 0.0::DOUBLE) AS lat FROM trips
            WHERE pickup_taxizone_id IS NULL AND coalesce(pickup_longitude, 0.0::DOUBLE) <> 0 AND coalesce(pickup_latitude, 0.0::DOUBLE) <> 0),
dof AS (SELECT trip_id, coalesce(dropoff_longitude, 0.0::DOUBLE) AS lon, coalesce(dropoff_latitude, 0.0::DOUBLE) AS lat FROM trips
            WHERE dropoff_taxizone_id IS NULL AND coalesce(dropoff_longitude, 0.0::DOUBLE) <> 0 AND coalesce(dropoff_latitude, 0.0::DOUBLE) <> 0),
hp AS {pip_sql('pu', 'trip_id', 'lon', 'lat')},
hd AS {pip_sql('dof', 'trip_id', 'lon', 'lat')}
SELECT t.trip_id, CAST(coalesce(t.pickup_taxizone_id, hp.zid) AS INTEGER) AS pickup_taxizone_id,
  CAST(coalesce(t.dropoff_taxizone_id, hd.zid) AS INTEGER) AS dropoff_taxizone_id
FROM trips t LEFT JOIN hp ON t.trip_id = hp.trip_id LEFT JOIN hd ON t.trip_id = hd.trip_id""")
def assign_zones(spark, sf):
    """Fill missing pickup and drop-off zone ids from coordinates."""
    t = fx.trips(spark, sf).select("trip_id", "pickup_longitude", "pickup_latitude", "pickup_taxizone_id",
                                   "dropoff_longitude", "dropoff_latitude", "dropoff_taxizone_id")
    z = fx.zones(spark)
    t = SP.assign_zones(t, z, "pickup_longitude", "pickup_latitude", "pickup_taxizone_id")
    t = SP.assign_zones(t, z, "dropoff_longitude", "dropoff_latitude", "dropoff_taxizone_id")
    return t.select("trip_id", "pickup_taxizone_id", "dropoff_taxizone_id")


@query("spatial_multi_layer", section=SEC, sql=f"""
WITH pp AS (SELECT trip_id, pickup_longitude AS lon, pickup_latitude AS lat FROM trips),
dd AS (SELECT trip_id, dropoff_longitude AS lon, dropoff_latitude AS lat FROM trips WHERE dropoff_longitude IS NOT NULL),
a AS {pip_sql('pp', 'trip_id', 'lon', 'lat')}, b AS {pip_sql('dd', 'trip_id', 'lon', 'lat')},
c AS {pip_sql('pp', 'trip_id', 'lon', 'lat', 'tract_edges')}, d AS {pip_sql('dd', 'trip_id', 'lon', 'lat', 'tract_edges')}
SELECT t.trip_id, CAST(a.zid AS INTEGER) AS pickup_zone, CAST(b.zid AS INTEGER) AS dropoff_zone,
  CAST(c.zid AS INTEGER) AS pickup_tract, CAST(d.zid AS INTEGER) AS dropoff_tract
FROM trips t LEFT JOIN a USING (trip_id) LEFT JOIN b USING (trip_id) LEFT JOIN c USING (trip_id) LEFT JOIN d USING (trip_id)""")
def spatial_multi_layer(spark, sf):
    """Zones and tracts for both trip ends. Each lookup is a broadcast hash
    join on the grid cell, so the four layers chain without any shuffle of
    the trips (no unpivot/re-pivot needed)."""
    t = fx.trips(spark, sf).select("trip_id", "pickup_longitude", "pickup_latitude",
                                   "dropoff_longitude", "dropoff_latitude")
    layers = [("zone", SP.zone_index(fx.zones(spark))), ("tract", SP.zone_index(fx.tracts(spark)))]
    for end in ("pickup", "dropoff"):
        for layer, poly in layers:
            t = SP.lookup_zone(t, poly, f"{end}_longitude", f"{end}_latitude", f"{end}_{layer}")
    return t.select("trip_id", "pickup_zone", "dropoff_zone", "pickup_tract", "dropoff_tract")


@query("spatial_uneven_layer", section=SEC, sql=f"""
WITH pp AS (SELECT trip_id, pickup_longitude AS lon, pickup_latitude AS lat FROM trips),
w AS {pip_pairs_sql('pp', 'trip_id', 'lon', 'lat', 'within', 'detail_edges')}, a AS {pip_sql('pp', 'trip_id', 'lon', 'lat', 'detail_edges')},
n AS (SELECT trip_id, count(*) AS n_within FROM w GROUP BY trip_id)
SELECT t.trip_id, CAST(a.zid AS INTEGER) AS zone, CAST(coalesce(n.n_within, 0) AS BIGINT) AS n_within
FROM trips t LEFT JOIN a ON t.trip_id = a.trip_id LEFT JOIN n ON t.trip_id = n.trip_id""")
def spatial_uneven_layer(spark, sf):
    """Trips against a layer whose polygons have from 4 to 256 edges, by a quadtree:
    the first zone that holds the pickup, and how many hold it strictly."""
    index = quad_index(fx.detailed_zones(spark))
    t = fx.trips(spark, sf).select("trip_id", "pickup_longitude", "pickup_latitude")
    t = SP.lookup_zone(t, index, "pickup_longitude", "pickup_latitude", "zone")
    hits = SP.spatial_join(t, index, "pickup_longitude", "pickup_latitude", how="left", mode="within")
    # A trip is one row of the orders, so its zones stand in one task already; only counts are moved.
    return hits.groupBy("trip_id", "zone").agg(F.count("LocationID").alias("n_within"))


_CB_PTS = """citibike AS (SELECT trip_duration, start_station_id, trim(start_station_name, '"') AS start_station_name,
  start_station_latitude, start_station_longitude, end_station_id, trim(end_station_name, '"') AS end_station_name,
  end_station_latitude, end_station_longitude FROM bike),
pts AS (SELECT DISTINCT * FROM (
  SELECT start_station_id AS id, start_station_name AS name, avg(start_station_latitude) AS lat, avg(start_station_longitude) AS lon
  FROM citibike WHERE start_station_latitude > 40.0 AND start_station_latitude < 41.0
    AND start_station_longitude + 74.0 > -0.25 AND start_station_longitude + 74.0 < 0.25 GROUP BY 1, 2
  UNION ALL
  SELECT end_station_id, end_station_name, avg(end_station_latitude), avg(end_station_longitude)
  FROM citibike WHERE end_station_latitude > 40.0 AND end_station_latitude < 41.0
    AND end_station_longitude + 74.0 > -0.25 AND end_station_longitude + 74.0 < 0.25 GROUP BY 1, 2))"""


def _pair_sql(r: str) -> str:
    return (f"(p.lat - s.latitude) * (p.lat - s.latitude) + (p.lon - s.longitude) * (p.lon - s.longitude) "
            f"<= CAST({r} AS DOUBLE) * CAST({r} AS DOUBLE)")


@query("radius_join", section=SEC, sql=f"""
WITH {_CB_PTS}
SELECT p.id, p.name, s.id AS match_id, 0.000225::DOUBLE AS radius FROM pts p JOIN stations s ON {_pair_sql('0.000225')}
UNION ALL
SELECT p.id, p.name, s.id, 0.0005::DOUBLE FROM pts p JOIN stations s ON {_pair_sql('0.0005')}""")
def radius_join(spark, sf):
    """All (historical point, current station) pairs within 25 m and 55 m
    (Euclidean degrees, inclusive) via 3x3 grid-cell equi-joins."""
    pts = S.trip_points(fx.citibike(spark, sf))
    cur = fx.stations(spark, sf).select(F.col("id").alias("match_id"), "latitude", "longitude")
    out = None
    for r in (0.000225, 0.0005):
        p = SP.radius_pairs(pts, cur, "lat", "lon", "latitude", "longitude", r).select(
            "id", "name", "match_id", F.lit(r).alias("radius"))
        out = p if out is None else out.unionByName(p)
    return out


@query("radius_match_nullable", section=SEC, sql=f"""
WITH {_CB_PTS}
SELECT p.id, p.name, round(p.lat, 12) AS lat, round(p.lon, 12) AS lon, s.id AS match_id, s.stationName, s.latitude, s.longitude
FROM pts p LEFT JOIN stations s ON {_pair_sql('0.000225')}""")
def radius_match_nullable(spark, sf):
    """Each historical point with its current station or nulls."""
    pts = S.trip_points(fx.citibike(spark, sf))
    m = S.match_points(pts, fx.stations(spark, sf))
    return m.select("id", "name", F.round("lat", 12).alias("lat"), F.round("lon", 12).alias("lon"), "match_id",
                    "stationName", "latitude", "longitude")


@query("radius_match_stats", section=SEC, sql=f"""
WITH {_CB_PTS},
c AS (SELECT p.id, p.name, p.lat, p.lon, 0.000225::DOUBLE AS radius, count(s.id) AS n FROM pts p LEFT JOIN stations s ON {_pair_sql('0.000225')} GROUP BY 1, 2, 3, 4
      UNION ALL
      SELECT p.id, p.name, p.lat, p.lon, 0.0005::DOUBLE, count(s.id) FROM pts p LEFT JOIN stations s ON {_pair_sql('0.0005')} GROUP BY 1, 2, 3, 4)
SELECT radius, max(n) AS max_matches, min(n) AS min_matches, count(*) AS n_points FROM c GROUP BY radius""")
def radius_match_stats(spark, sf):
    """Largest and smallest number of current stations per historical point."""
    pts = S.trip_points(fx.citibike(spark, sf))
    out = None
    for r in (0.000225, 0.0005):
        m = S.match_points(pts, fx.stations(spark, sf), r)
        c = m.groupBy("id", "name", "lat", "lon").agg(F.count("match_id").alias("n"))
        s = c.agg(F.lit(r).alias("radius"), F.max("n").alias("max_matches"), F.min("n").alias("min_matches"),
                  F.count(F.lit(1)).alias("n_points"))
        out = s if out is None else out.unionByName(s)
    return out


@query("join_theta_implicit", section=SEC, sql=f"""
WITH pts AS (SELECT trip_id, pickup_longitude AS lon, pickup_latitude AS lat FROM trips
             WHERE abs(pickup_longitude + 73.95) < 1 AND abs(pickup_latitude - 40.75) < 1),
hit AS {pip_pairs_sql('pts', 'trip_id', 'lon', 'lat', 'within')}
SELECT trip_id, CAST(zid AS INTEGER) AS LocationID FROM hit""")
def join_theta_implicit(spark, sf):
    """Comma join with the predicate in ``WHERE``, in Spark SQL. The cell
    equality in the predicate makes it an equi-join (no nested loop); the
    polygon test is the residual."""
    from urbanlens.functions import geo

    index = SP.zone_index(fx.zones(spark))
    j = spark.sql(f"""
        SELECT t.trip_id, t.pickup_longitude, t.pickup_latitude, z.candidates
        FROM {{trips}} t, {{cells}} z
        WHERE abs(t.pickup_longitude + 73.95) < 1 AND abs(t.pickup_latitude - 40.75) < 1
          AND z.cx = floor(t.pickup_longitude / {index.cell}) AND z.cy = floor(t.pickup_latitude / {index.cell})""",
                  trips=fx.trips(spark, sf), cells=index.cells)
    hits = F.filter("candidates", lambda c: c["whole"] | geo.within(c["edges"], F.col("pickup_longitude"), F.col("pickup_latitude")))
    return (j.select("trip_id", F.explode(F.transform(hits, lambda c: c["id"])).alias("LocationID"))
            .select("trip_id", F.col("LocationID").cast("int").alias("LocationID")))
