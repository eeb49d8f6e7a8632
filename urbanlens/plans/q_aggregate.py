"""Section 2.5: aggregations (counts, OD matrices, station chain, histograms)."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanlens.functions import timeparts as T
from urbanlens.operators import aggregate as A
from urbanlens.operators import histogram as H
from urbanlens.operators import quantiles as Q
from urbanlens.operators import stations as S
from urbanlens.operators.spatial import lookup_zone_inner
from urbanlens.plans.registry import query
from urbanlens.plans.sqlbits import floor_ts, pip_sql, utc_from_local
from urbanlens.session import reliable_checkpoint
from urbanlens.sources import fixtures as fx

SEC = "2.5"


@query("agg_count_nonnull", section=SEC, sql="""
SELECT pickup_taxizone_id, count(pickup_datetime) AS pickup_datetime, count(dropoff_datetime) AS dropoff_datetime,
  count(dropoff_taxizone_id) AS dropoff_taxizone_id, count(trip_type) AS trip_type, count(fare_amount) AS fare_amount
FROM trips WHERE pickup_taxizone_id IS NOT NULL GROUP BY pickup_taxizone_id""")
def agg_count_nonnull(spark, sf):
    t = fx.trips(spark, sf).select("pickup_taxizone_id", "pickup_datetime", "dropoff_datetime",
                                   "dropoff_taxizone_id", "trip_type", "fare_amount")
    return A.count_nonnull_by(t, ["pickup_taxizone_id"])


@query("agg_count_star", section=SEC, sql="""
SELECT pickup_taxizone_id, count(*) AS count FROM trips GROUP BY pickup_taxizone_id""")
def agg_count_star(spark, sf):
    return fx.trips(spark, sf).groupBy("pickup_taxizone_id").count()


@query("agg_count_composite", section=SEC, sql="""
SELECT ca, unit, scp, count(*) AS count FROM turnstile GROUP BY ca, unit, scp""")
def agg_count_composite(spark, sf):
    return fx.turnstile_readings(spark, sf).groupBy("ca", "unit", "scp").count()


@query("agg_row_count", section=SEC, sql="SELECT count(*) AS n_rows FROM bike")
def agg_row_count(spark, sf):
    return fx.bike(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"))


@query("agg_count_per_column", section=SEC, sql="""
UNPIVOT (SELECT count(trip_id) AS trip_id, count(pickup_datetime) AS pickup_datetime,
  count(dropoff_datetime) AS dropoff_datetime, count(pickup_taxizone_id) AS pickup_taxizone_id,
  count(dropoff_taxizone_id) AS dropoff_taxizone_id, count(trip_type) AS trip_type,
  count(dropoff_longitude) AS dropoff_longitude FROM trips)
ON trip_id, pickup_datetime, dropoff_datetime, pickup_taxizone_id, dropoff_taxizone_id, trip_type, dropoff_longitude
INTO NAME column_name VALUE n_nonnull""")
def agg_count_per_column(spark, sf):
    t = fx.trips(spark, sf).select("trip_id", "pickup_datetime", "dropoff_datetime", "pickup_taxizone_id",
                                   "dropoff_taxizone_id", "trip_type", "dropoff_longitude")
    return A.count_per_column(t)


@query("agg_mean", section=SEC, sql="""
SELECT start_station_id AS id, start_station_name AS name,
  round(avg(start_station_latitude), 12) AS lat, round(avg(start_station_longitude), 12) AS lon
FROM bike GROUP BY start_station_id, start_station_name""")
def agg_mean(spark, sf):
    b = fx.bike(spark, sf)
    return (b.groupBy(F.col("start_station_id").alias("id"), F.col("start_station_name").alias("name"))
            .agg(F.round(F.avg("start_station_latitude"), 12).alias("lat"),
                 F.round(F.avg("start_station_longitude"), 12).alias("lon")))


@query("agg_sum", section=SEC, sql="""
SELECT pickup_taxizone_id, round(sum(fare_amount), 6) AS fare_sum FROM trips GROUP BY pickup_taxizone_id""")
def agg_sum(spark, sf):
    return fx.trips(spark, sf).groupBy("pickup_taxizone_id").agg(F.round(F.sum("fare_amount"), 6).alias("fare_sum"))


@query("agg_max", section=SEC, sql="SELECT max(trip_id) AS max_trip_id FROM trips")
def agg_max(spark, sf):
    return fx.trips(spark, sf).agg(F.max("trip_id").alias("max_trip_id"))


@query("agg_partial_merge", section=SEC, sql="""
SELECT pickup_taxizone_id, CAST(sum(n) AS BIGINT) AS N FROM (
  SELECT trip_type, pickup_taxizone_id, count(pickup_datetime) AS n FROM trips
  WHERE pickup_datetime < TIMESTAMP '2000-07-01 00:00:00' AND pickup_taxizone_id IS NOT NULL
  GROUP BY trip_type, pickup_taxizone_id) GROUP BY pickup_taxizone_id""")
def agg_partial_merge(spark, sf):
    """Per-source counts merged by key; Catalyst runs it as partial + final
    aggregation, so the per-source step never materialises on its own."""
    t = (fx.trips(spark, sf).where(F.col("pickup_datetime") < F.lit("2000-07-01 00:00:00").cast("timestamp_ntz"))
         .where(F.col("pickup_taxizone_id").isNotNull()))
    per_source = t.groupBy("trip_type", "pickup_taxizone_id").agg(F.count("pickup_datetime").alias("n"))
    return per_source.groupBy("pickup_taxizone_id").agg(F.sum("n").cast("bigint").alias("N"))


@query("agg_distinct", section=SEC, sql="SELECT DISTINCT start_station_id, start_station_name FROM bike")
def agg_distinct(spark, sf):
    return fx.bike(spark, sf).select("start_station_id", "start_station_name").distinct()


@query("drop_duplicates", section=SEC, sql="""
SELECT DISTINCT * FROM (SELECT start_station_id AS id, start_station_name AS name FROM bike
  UNION ALL SELECT end_station_id, end_station_name FROM bike)""")
def drop_duplicates(spark, sf):
    b = fx.bike(spark, sf)
    s = b.select(F.col("start_station_id").alias("id"), F.col("start_station_name").alias("name"))
    e = b.select(F.col("end_station_id").alias("id"), F.col("end_station_name").alias("name"))
    return s.unionByName(e).dropDuplicates()


@query("distinct_on_mean", section=SEC, sql="""
SELECT start_station_id AS id, round(avg(start_station_latitude), 12) AS lat, round(avg(start_station_longitude), 12) AS lon
FROM bike WHERE abs(start_station_longitude + 73.95) < 1 AND abs(start_station_latitude - 40.75) < 1
GROUP BY start_station_id""")
def distinct_on_mean(spark, sf):
    b = fx.bike(spark, sf).where((F.abs(F.col("start_station_longitude") + 73.95) < 1)
                                 & (F.abs(F.col("start_station_latitude") - 40.75) < 1))
    return b.groupBy(F.col("start_station_id").alias("id")).agg(
        F.round(F.avg("start_station_latitude"), 12).alias("lat"),
        F.round(F.avg("start_station_longitude"), 12).alias("lon"))


@query("station_multi_names", section=SEC, sql="""
WITH names AS (SELECT DISTINCT start_station_id AS id, start_station_name AS name FROM bike
  UNION SELECT DISTINCT end_station_id, trim(end_station_name, '"') FROM bike),
multi AS (SELECT id, count(*) AS n_names FROM names GROUP BY id HAVING count(*) > 1)
SELECT n.id, n.name, m.n_names FROM names n JOIN multi m ON n.id = m.id""")
def station_multi_names(spark, sf):
    """Ids recorded under more than one name (raw start names vs cleaned end
    names here), joined back to list the names."""
    from urbanlens.functions.strings import strip_quotes

    b = fx.bike(spark, sf)
    names = (b.select(F.col("start_station_id").alias("id"), F.col("start_station_name").alias("name"))
             .unionByName(b.select(F.col("end_station_id").alias("id"),
                                   strip_quotes("end_station_name").alias("name"))).distinct())
    multi = names.groupBy("id").agg(F.count(F.lit(1)).alias("n_names")).where(F.col("n_names") > 1)
    return names.join(multi, "id")


_OD_SQL = """
SELECT coalesce(pickup_taxizone_id, 266) AS pickup_taxizone_id, coalesce(dropoff_taxizone_id, 266) AS dropoff_taxizone_id,
  count(pickup_datetime) AS n_trips
FROM trips WHERE trip_type IS DISTINCT FROM 'uber' GROUP BY 1, 2"""


@query("od_matrix_counts", section=SEC, sql=_OD_SQL + " ORDER BY n_trips DESC")
def od_matrix_counts(spark, sf):
    return A.od_counts(fx.trips(spark, sf), "pickup_taxizone_id", "dropoff_taxizone_id").orderBy(F.desc("n_trips"))


@query("od_matrix_dense_log", section=SEC, sql=f"""
WITH od AS ({_OD_SQL})
SELECT CAST(c.i AS INTEGER) AS pickup_taxizone_id, CAST(c.j AS INTEGER) AS dropoff_taxizone_id,
  CAST(coalesce(od.n_trips, 0) AS BIGINT) AS n_trips, round(log10(coalesce(od.n_trips, 0) + 1), 9) AS log_n
FROM (SELECT id // 268 AS i, id % 268 AS j FROM range(268 * 268) t(id)) c
LEFT JOIN od ON od.pickup_taxizone_id = c.i AND od.dropoff_taxizone_id = c.j""")
def od_matrix_dense_log(spark, sf):
    od = A.od_counts(fx.trips(spark, sf), "pickup_taxizone_id", "dropoff_taxizone_id")
    return A.dense_square(od, "pickup_taxizone_id", "dropoff_taxizone_id", "n_trips", 268)


def zone_labels(spark):
    """Zone -> cluster label table with labels 0..44, in the layout of
    ``q_stats.zone_clusters`` (LocationID, labels), fixed so that SQL can repeat it."""
    return fx.zones(spark).select("LocationID", ((F.col("LocationID") * 7) % 45).alias("labels"))


@query("od_cluster_rollup", section=SEC, sql=f"""
WITH od AS ({_OD_SQL}),
lab AS (SELECT LocationID, (LocationID * 7) % 45 AS labels FROM zones),
cl AS (SELECT coalesce(a.labels, 45) AS pickup_cluster_id, coalesce(b.labels, 45) AS dropoff_cluster_id,
         CAST(sum(od.n_trips) AS BIGINT) AS n_trips
       FROM od LEFT JOIN lab a ON od.pickup_taxizone_id = a.LocationID
       LEFT JOIN lab b ON od.dropoff_taxizone_id = b.LocationID GROUP BY 1, 2)
SELECT CAST(c.i AS INTEGER) AS pickup_cluster_id, CAST(c.j AS INTEGER) AS dropoff_cluster_id,
  CAST(coalesce(cl.n_trips, 0) AS BIGINT) AS n_trips, round(log10(coalesce(cl.n_trips, 0) + 1), 9) AS log_n
FROM (SELECT id // 46 AS i, id % 46 AS j FROM range(46 * 46) t(id)) c
LEFT JOIN cl ON cl.pickup_cluster_id = c.i AND cl.dropoff_cluster_id = c.j""")
def od_cluster_rollup(spark, sf, labels=None):
    """Trips between zone clusters; ``labels`` (LocationID, labels) may come from k-means."""
    od = A.od_counts(fx.trips(spark, sf), "pickup_taxizone_id", "dropoff_taxizone_id")
    lab = F.broadcast((zone_labels(spark) if labels is None else labels).select("LocationID", "labels"))   # 260 zones by construction
    m = (od.join(lab.withColumnsRenamed({"LocationID": "pickup_taxizone_id", "labels": "pickup_cluster_id"}),
                 "pickup_taxizone_id", "left")
         .join(lab.withColumnsRenamed({"LocationID": "dropoff_taxizone_id", "labels": "dropoff_cluster_id"}),
               "dropoff_taxizone_id", "left")
         .fillna(45, ["pickup_cluster_id", "dropoff_cluster_id"]))
    cl = m.groupBy("pickup_cluster_id", "dropoff_cluster_id").agg(F.sum("n_trips").alias("n_trips"))
    return A.dense_square(cl, "pickup_cluster_id", "dropoff_cluster_id", "n_trips", 46)


@query("zone_trip_counts_log", section=SEC, sql="""
SELECT pickup_taxizone_id, count(pickup_datetime) AS N, round(log10(count(pickup_datetime)), 9) AS logN
FROM trips WHERE pickup_datetime < TIMESTAMP '2000-07-01 00:00:00' AND pickup_taxizone_id IS NOT NULL
GROUP BY pickup_taxizone_id""")
def zone_trip_counts_log(spark, sf):
    t = fx.trips(spark, sf).where(F.col("pickup_datetime") < F.lit("2000-07-01 00:00:00").cast("timestamp_ntz"))
    c = A.count_nonnull_by(t.select("pickup_taxizone_id", "pickup_datetime"), ["pickup_taxizone_id"])
    return c.select("pickup_taxizone_id", F.col("pickup_datetime").alias("N"),
                    F.round(F.when(F.col("pickup_datetime") > 0, F.log10("pickup_datetime")), 9).alias("logN"))


@query("choropleth_table", section=SEC, sql="""
WITH zz AS (SELECT pickup_taxizone_id, count(pickup_datetime) AS N FROM trips
            WHERE pickup_taxizone_id IS NOT NULL GROUP BY pickup_taxizone_id)
SELECT z.LocationID, z.zone, z.borough, zz.N, round(log10(zz.N), 9) AS logN
FROM zones z JOIN zz ON z.LocationID = zz.pickup_taxizone_id
WHERE z.borough IS DISTINCT FROM 'Staten Island' AND z.borough IS DISTINCT FROM 'EWR'""")
def choropleth_table(spark, sf):
    zz = A.count_nonnull_by(fx.trips(spark, sf).select("pickup_taxizone_id", "pickup_datetime"),
                            ["pickup_taxizone_id"]).withColumnRenamed("pickup_datetime", "N")
    z = F.broadcast(fx.zones(spark).drop("rings"))   # 260 zones by construction
    j = z.join(zz, z["LocationID"] == zz["pickup_taxizone_id"], "inner").drop("pickup_taxizone_id")
    j = j.where(~F.col("borough").eqNullSafe("Staten Island") & ~F.col("borough").eqNullSafe("EWR"))
    return j.select("LocationID", "zone", "borough", "N", F.round(F.log10("N"), 9).alias("logN"))


@query("tract_counts_log", section=SEC, sql=f"""
WITH pts AS (SELECT ride_id, start_station_longitude AS lon, start_station_latitude AS lat FROM bike),
hit AS {pip_sql('pts', 'ride_id', 'lon', 'lat', 'tract_edges')},
zz AS (SELECT zid, count(*) AS n FROM hit GROUP BY zid)
SELECT z.LocationID, round(ln(coalesce(zz.n, 1)), 9) AS biketrip_count
FROM tracts z LEFT JOIN zz ON z.LocationID = zz.zid""")
def tract_counts_log(spark, sf):
    """Bike trips per tract polygon (start point in polygon), left-joined to
    every tract, ``ln`` of the count with missing as 1."""
    b = fx.bike(spark, sf).select("ride_id", "start_station_longitude", "start_station_latitude")
    tracts = fx.tracts(spark)
    hit = lookup_zone_inner(b, tracts, "start_station_longitude", "start_station_latitude", "start_ct_id")
    zz = hit.groupBy("start_ct_id").agg(F.count("ride_id").alias("ride_id"))
    j = tracts.select("LocationID").join(zz, tracts["LocationID"] == zz["start_ct_id"], "left")
    return j.select("LocationID", F.round(F.log(F.coalesce(F.col("ride_id"), F.lit(1))), 9).alias("biketrip_count"))


@query("trips_per_day", section=SEC, sql=f"""
SELECT CAST({floor_ts('start_time', 86400)} AS TIMESTAMP) AS year_month_day, 'all' AS user_type, count(trip_duration) AS n
FROM bike GROUP BY 1
UNION ALL
SELECT {floor_ts('start_time', 86400)}, user_type, count(trip_duration) FROM bike GROUP BY 1, 2""")
def trips_per_day(spark, sf):
    b = fx.bike(spark, sf).withColumn("year_month_day", T.trunc_day("start_time"))
    return _all_and_by_type(b, "year_month_day")


def _all_and_by_type(b, period: str):
    """Counts per period overall and per user type in one pass (grouping sets:
    one scan, one shuffle) instead of two aggregations and a union."""
    g = b.groupingSets([[period], [period, "user_type"]], period, "user_type").agg(
        F.count("trip_duration").alias("n"), F.grouping("user_type").alias("_all"))
    return g.select(period, F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col("user_type")).alias("user_type"),
                    "n")


@query("trips_per_week", section=SEC, sql=f"""
SELECT {floor_ts('start_time', 7 * 86400)} AS year_month_week, 'all' AS user_type, count(trip_duration) AS n,
  count(trip_duration) / 7.0 AS per_day
FROM bike GROUP BY 1
UNION ALL
SELECT {floor_ts('start_time', 7 * 86400)}, user_type, count(trip_duration), count(trip_duration) / 7.0 FROM bike GROUP BY 1, 2""")
def trips_per_week(spark, sf):
    """Weekly counts on numpy's Thursday-anchored weeks, and the per-day average."""
    b = fx.bike(spark, sf).withColumn("year_month_week", T.trunc_week_epoch("start_time"))
    return _all_and_by_type(b, "year_month_week").withColumn("per_day", F.col("n") / 7.0)


_SIXMIN_SQL = f"""
SELECT pickup_taxizone_id,
  strftime({floor_ts(utc_from_local('pickup_datetime'), 360)}, '%Y-%m-%d %H:%M:00') AS pickup_dt_group,
  count(*) AS count
FROM trips GROUP BY 1, 2"""


@query("sixmin_counts", section=SEC, sql=_SIXMIN_SQL)
def sixmin_counts(spark, sf):
    """Trips per pickup zone per 6-minute bin, New York time shifted to UTC."""
    # UTC first, in its own projection: the bin arithmetic reads it several
    # times and should not re-run the zone conversion for each read.
    u = fx.trips(spark, sf).select("pickup_taxizone_id", T.local_to_utc("pickup_datetime").alias("utc"))
    t = u.select("pickup_taxizone_id", T.bin_minutes("utc", 6).alias("bin"))
    # Group on the 8-byte bin and format the label once per group, not per row.
    c = t.groupBy("pickup_taxizone_id", "bin").count()
    return c.select("pickup_taxizone_id", T.six_minute_label("bin").alias("pickup_dt_group"), "count")


@query("timeseries_dense_6min", section=SEC, sql=f"""
WITH u AS (SELECT pickup_taxizone_id AS z, epoch_us({utc_from_local('pickup_datetime')}) // 360000000 AS bin FROM trips),
c AS (SELECT z, bin // 240 AS d, bin % 240 AS s, count(*) AS n FROM u GROUP BY ALL),
k AS (SELECT z, min(d * 240 + s) AS lo, max(d * 240 + s) AS hi FROM c GROUP BY z),
days AS (SELECT z, lo, hi, unnest(range(lo // 240, hi // 240 + 1)) AS d FROM k),
b AS (SELECT z, d, list(s ORDER BY s) AS ss, list(n ORDER BY s) AS ns FROM c GROUP BY z, d),
f AS (SELECT days.z, days.d, greatest(lo - days.d * 240, 0) AS a, least(hi - days.d * 240, 239) AS e, ss, ns
  FROM days LEFT JOIN b ON days.z IS NOT DISTINCT FROM b.z AND days.d = b.d)
SELECT z AS pickup_taxizone_id, make_timestamp(d * 86400000000) AS day, make_timestamp((d * 240 + a) * 360000000) AS first_bin,
  CAST(e - a + 1 AS INTEGER) AS n_bins, CAST(coalesce(list_sum(ns), 0) AS BIGINT) AS n_trips,
  md5(array_to_string(list_transform(range(a, e + 1), lambda i: coalesce(ns[list_position(ss, i)], 0)), ',')) AS counts_md5 FROM f""")
def timeseries_dense_6min(spark, sf):
    """One dense 6-minute series per pickup zone, from its first trip to its last.

    A row is a zone's day: the number of bins (240 but for the first and last
    day), the trips, and a digest of all counts, zeros included.
    ``timeseries.series_rows`` gives the series bin by bin.
    """
    from urbanlens.operators.timeseries import dense_series

    u = fx.trips(spark, sf).select("pickup_taxizone_id", T.local_to_utc("pickup_datetime").alias("utc"))
    d = dense_series(u, "pickup_taxizone_id", "utc", 6 * T.MICROS_PER_MINUTE)
    # A day without trips needs no look at its counts.
    zeros = F.concat(F.repeat(F.lit("0,"), F.size("counts") - 1), F.lit("0"))
    text = F.when(F.col("n") == 0, zeros).otherwise(F.array_join(F.col("counts").cast("array<string>"), ","))
    return d.select("pickup_taxizone_id", F.col("block").alias("day"), "first_bin", F.size("counts").alias("n_bins"),
                    F.col("n").alias("n_trips"), F.md5(text).alias("counts_md5"))


@query("station_rank_bizday", section=SEC, sql="""
SELECT start_station_id, count(*) AS is_bus_day FROM bike
WHERE (dayofweek(start_time) + 6) % 7 < 5 GROUP BY start_station_id ORDER BY is_bus_day DESC""")
def station_rank_bizday(spark, sf):
    b = fx.bike(spark, sf).where(T.is_business_day("start_time"))
    return b.groupBy("start_station_id").agg(F.count(F.lit(1)).alias("is_bus_day")).orderBy(F.desc("is_bus_day"))


# --- station quality chain -------------------------------------------------
_CB = """citibike AS (SELECT ride_id, trip_duration, start_time, start_station_id, trim(start_station_name, '"') AS start_station_name,
  start_station_latitude, start_station_longitude, end_station_id, trim(end_station_name, '"') AS end_station_name,
  end_station_latitude, end_station_longitude, user_type FROM bike)"""
_PTS = """pts AS (SELECT DISTINCT * FROM (
  SELECT start_station_id AS id, start_station_name AS name, avg(start_station_latitude) AS lat, avg(start_station_longitude) AS lon
  FROM citibike WHERE start_station_latitude > 40.0 AND start_station_latitude < 41.0
    AND start_station_longitude + 74.0 > -0.25 AND start_station_longitude + 74.0 < 0.25 GROUP BY 1, 2
  UNION ALL
  SELECT end_station_id, end_station_name, avg(end_station_latitude), avg(end_station_longitude)
  FROM citibike WHERE end_station_latitude > 40.0 AND end_station_latitude < 41.0
    AND end_station_longitude + 74.0 > -0.25 AND end_station_longitude + 74.0 < 0.25 GROUP BY 1, 2))"""
_MATCH = """m AS (SELECT p.*, s.id AS match_id FROM pts p LEFT JOIN stations s
  ON (p.lat - s.latitude) * (p.lat - s.latitude) + (p.lon - s.longitude) * (p.lon - s.longitude)
     <= CAST(0.000225 AS DOUBLE) * CAST(0.000225 AS DOUBLE))"""
_DEFUNCT = "defunct AS (SELECT DISTINCT id, name FROM m WHERE match_id IS NULL)"
_DTRIPS = """dtrips AS (SELECT DISTINCT * FROM (
  SELECT c.* FROM citibike c SEMI JOIN defunct d ON c.start_station_id = d.id AND c.start_station_name = d.name
  UNION ALL
  SELECT c.* FROM citibike c SEMI JOIN defunct d ON c.end_station_id = d.id AND c.end_station_name = d.name))"""
_BAD = """bad AS (
  SELECT start_station_id AS id FROM dtrips GROUP BY start_station_id, start_station_name HAVING count(trip_duration) < 50
  UNION
  SELECT end_station_id FROM dtrips GROUP BY end_station_id, end_station_name HAVING count(trip_duration) < 50)"""
_BAD_DEFUNCT = """bad AS (
  SELECT start_station_id AS id FROM dtrips t SEMI JOIN defunct d ON t.start_station_id = d.id AND t.start_station_name = d.name
  GROUP BY start_station_id, start_station_name HAVING count(trip_duration) < 50
  UNION
  SELECT end_station_id FROM dtrips t SEMI JOIN defunct d ON t.end_station_id = d.id AND t.end_station_name = d.name
  GROUP BY end_station_id, end_station_name HAVING count(trip_duration) < 50)"""


def _chain(spark, sf):
    cb = fx.citibike(spark, sf)
    pts = S.trip_points(cb)
    defunct = S.defunct_stations(pts, fx.stations(spark, sf))
    return cb, pts, defunct


@query("defunct_stations", section=SEC, sql=f"WITH {_CB}, {_PTS}, {_MATCH}, {_DEFUNCT} SELECT * FROM defunct")
def defunct_stations(spark, sf):
    return _chain(spark, sf)[2]


@query("defunct_trips", section=SEC, sql=f"""
WITH {_CB}, {_PTS}, {_MATCH}, {_DEFUNCT}, {_DTRIPS}
SELECT ride_id, start_station_id, start_station_name, end_station_id, end_station_name, trip_duration FROM dtrips""")
def defunct_trips(spark, sf):
    cb, _, defunct = _chain(spark, sf)
    return S.defunct_trips(cb, defunct).select("ride_id", "start_station_id", "start_station_name",
                                               "end_station_id", "end_station_name", "trip_duration")


@query("low_freq_stations", section=SEC, sql=f"""
WITH {_CB}, {_PTS}, {_MATCH}, {_DEFUNCT}, {_DTRIPS}, {_BAD} SELECT id FROM bad ORDER BY id""")
def low_freq_stations(spark, sf):
    cb, _, defunct = _chain(spark, sf)
    return S.low_freq_stations(S.defunct_trips(cb, defunct)).orderBy("id")


@query("low_freq_defunct_stations", section=SEC, sql=f"""
WITH {_CB}, {_PTS}, {_MATCH}, {_DEFUNCT}, {_DTRIPS}, {_BAD_DEFUNCT} SELECT id FROM bad""")
def low_freq_defunct_stations(spark, sf):
    """The narrower scope: only stations of the defunct set count."""
    cb, _, defunct = _chain(spark, sf)
    defunct = reliable_checkpoint(defunct)   # a station list, used three times
    return S.low_freq_stations(S.defunct_trips(cb, defunct), defunct)


@query("clean_trips", section=SEC, sql=f"""
WITH {_CB}, {_PTS}, {_MATCH}, {_DEFUNCT}, {_DTRIPS}, {_BAD}
SELECT ride_id, start_station_id, end_station_id FROM citibike c
WHERE c.start_station_id NOT IN (SELECT id FROM bad) AND c.end_station_id NOT IN (SELECT id FROM bad)""")
def clean_trips(spark, sf):
    cb, _, defunct = _chain(spark, sf)
    bad = reliable_checkpoint(S.low_freq_stations(S.defunct_trips(cb, defunct)))   # a station list, used for both ends
    return S.clean_trips(cb, bad).select("ride_id", "start_station_id", "end_station_id")


# --- histograms -------------------------------------------------------------
@query("hist_fixed", section=SEC, sql="""
WITH v AS (SELECT 'minute' AS hist, CAST(minute(start_time) AS DOUBLE) AS x, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS w, 61 AS nb FROM bike
  UNION ALL SELECT 'hour_of_week', ((dayofweek(start_time) + 6) % 7) + hour(start_time) / 24.0 + minute(start_time) / 60.0 / 24.0,
    0.0::DOUBLE, 1.0::DOUBLE / 24.0::DOUBLE, 168 FROM bike),
b AS (SELECT hist, CASE WHEN x = lo + nb * w THEN nb - 1 ELSE CAST(floor((x - lo) / w) AS BIGINT) END AS bin, lo, w, nb FROM v
      WHERE x >= lo AND x <= lo + nb * w)
SELECT hist, CAST(bin AS INTEGER) AS bin, round(lo + bin * w, 9) AS left_edge, count(*) AS n FROM b
WHERE bin >= 0 AND bin < nb GROUP BY hist, bin, lo, w""")
def hist_fixed(spark, sf):
    """Fixed-edge histograms: minute (0..61 step 1) and hour-of-week (step 1/24)."""
    b = fx.bike(spark, sf)
    m = H.fixed_histogram(b.select(F.minute("start_time").cast("double").alias("x")), "x", 0.0, 1.0, 61)
    h = H.fixed_histogram(b.select(T.position_in_week("start_time").alias("x")), "x", 0.0, 1.0 / 24.0, 168)
    return (m.withColumn("hist", F.lit("minute"))
            .unionByName(h.withColumn("hist", F.lit("hour_of_week"))).drop("_width"))


@query("hist_density", section=SEC, sql="""
WITH zz AS (SELECT start_station_id, count(*) AS N FROM bike WHERE start_station_id IS NOT NULL GROUP BY 1),
v AS (SELECT coalesce(log10(N), 0.0::DOUBLE) AS x FROM zz),
b AS (SELECT CASE WHEN x = 6.5::DOUBLE THEN 12 ELSE CAST(floor((x - 0.0::DOUBLE) / 0.5::DOUBLE) AS BIGINT) END AS bin FROM v WHERE x >= 0.0::DOUBLE AND x <= 6.5::DOUBLE),
c AS (SELECT bin, count(*) AS n FROM b WHERE bin >= 0 AND bin < 13 GROUP BY bin)
SELECT CAST(bin AS INTEGER) AS bin, round(0.0::DOUBLE + bin * 0.5::DOUBLE, 9) AS left_edge, n,
  round(n / ((SELECT sum(n) FROM c) * 0.5::DOUBLE), 9) AS density FROM c""")
def hist_density(spark, sf):
    """Normalised histogram of log10 trip counts per start station, busy and rare ones; edges
    ``np.arange(0, 7, 0.5)``, i.e. 0..6.5, 13 bins, the last edge inclusive."""
    zz = A.count_nonnull_by(fx.bike(spark, sf).select("start_station_id", "ride_id"), ["start_station_id"])
    v = zz.select(F.coalesce(F.when(F.col("ride_id") > 0, F.log10("ride_id")), F.lit(0.0)).alias("x"))
    return H.density(H.fixed_histogram(v, "x", 0.0, 0.5, 13))


@query("hist_auto_bins", section=SEC, sql="""
WITH v AS (SELECT hour(start_time) / 24.0 + minute(start_time) / 60.0 / 24.0 AS x FROM bike),
s AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n,
        quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM v),
p AS (SELECT lo, hi, CASE WHEN iqr > 0 THEN least(50, CAST(ceil((hi - lo) / (2 * iqr / pow(n, 1.0::DOUBLE / 3))) AS BIGINT))
        ELSE least(50, CAST(floor(sqrt(n)) AS BIGINT)) END AS nb FROM s),
q AS (SELECT lo, (hi - lo) / nb AS w, nb FROM p),
b AS (SELECT CASE WHEN x >= lo + nb * w THEN nb - 1 ELSE CAST(floor((x - lo) / w) AS BIGINT) END AS bin FROM v, q)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n FROM b GROUP BY bin""")
def hist_auto_bins(spark, sf):
    """Histogram with a Freedman-Diaconis bin count (capped at 50) of the
    fraction of the day."""
    v = fx.bike(spark, sf).select(T.frac_of_day("start_time").alias("x"))
    return H.auto_histogram(v, "x", max_bins=50).select("bin", "n")


_PARTS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@query("quantiles_exact", section=SEC, sql=" UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS p, round(quantile_cont(fare_amount, {p}), 9) AS fare_amount, round(quantile_cont(pickup_longitude, {p}), 9) AS pickup_longitude FROM trips"
    for p in _PARTS))
def quantiles_exact(spark, sf):
    """Interpolated quantiles of two continuous columns, exact at any number of distinct values."""
    t = fx.trips(spark, sf).select("fare_amount", "pickup_longitude")
    rows = zip(_PARTS, *[Q.quantiles(t, c, _PARTS) for c in t.columns], strict=True)
    return spark.createDataFrame(list(rows), "p double, fare_amount double, pickup_longitude double").select(
        "p", F.round("fare_amount", 9).alias("fare_amount"), F.round("pickup_longitude", 9).alias("pickup_longitude"))
