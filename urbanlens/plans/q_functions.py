"""Section 2.9: scalar functions (strings, time parts, business hours, math,
geometry). Each query applies the function to a whole fixture table."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from urbanlens.functions import geo as G
from urbanlens.functions import strings as ST
from urbanlens.functions import timeparts as T
from urbanlens.plans.registry import query
from urbanlens.plans.sqlbits import bh_add_sql, bh_sub_sql, floor_ts, hours_between, utc_from_local
from urbanlens.sources import fixtures as fx
from urbanlens.sources.tables import read_table

SEC = "2.9"


@query("str_strip_quotes", section=SEC, sql="""
SELECT ride_id, trim(start_station_name, '"') AS start_station_name, trim(end_station_name, '"') AS end_station_name,
  trim(user_type, '"') AS user_type FROM bike""")
def str_strip_quotes(spark, sf):
    b = fx.bike(spark, sf).select("ride_id", "start_station_name", "end_station_name", "user_type")
    return ST.strip_quotes_all(b)


@query("str_trim", section=SEC, sql="""
SELECT c_custkey, regexp_replace(' ' || chr(9) || c_name || ' ' || chr(10), '^\\s+|\\s+$', '', 'g') AS name FROM customer""")
def str_trim(spark, sf):
    """Python ``strip()``: spaces, tabs and newlines at both ends."""
    c = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    padded = F.concat(F.lit(" \t"), F.col("c_name"), F.lit(" \n"))
    return c.select("c_custkey", ST.strip_ws(padded).alias("name"))


def _chunk_lines(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select("o_orderkey", F.concat_ws(
        ",", k.cast("string"), c.cast("string"), "o_orderstatus",
        "o_orderpriority", (k % 7).cast("string"), (k % 11).cast("string"), (k % 13).cast("string"),
        (c % 3).cast("string"), (c % 5).cast("string"), "o_orderstatus", (k % 17).cast("string"),
        (c % 19).cast("string"), (k % 23).cast("string")).alias("line"))


@query("str_split_chunk", section=SEC, sql="""
WITH l AS (SELECT o_orderkey, string_split(concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
    o_orderkey % 7, o_orderkey % 11, o_orderkey % 13, o_custkey % 3, o_custkey % 5, o_orderstatus,
    o_orderkey % 17, o_custkey % 19, o_orderkey % 23), ',') AS f FROM orders)
SELECT o_orderkey, CAST(i AS INTEGER) AS chunk, array_to_string(f[4 + 5 * i : 8 + 5 * i], '|') AS fields
FROM l, range(2) r(i)""")
def str_split_chunk(spark, sf):
    """Split on commas, then fixed chunks of 5 after the 3 leading ids."""
    f = ST.split_fields(F.col("line"))
    return _chunk_lines(spark, sf).select(
        "o_orderkey", F.posexplode(ST.chunks(f, 3, 5)).alias("chunk", "c")).select(
        "o_orderkey", F.col("chunk").cast("int").alias("chunk"), F.array_join("c", "|").alias("fields"))


_ANCHORS_SQL = """a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s+href="([^"]*)"[^>]*>([^<]*)</a>', 2)) AS text
  FROM (SELECT page_id, html FROM pages UNION ALL SELECT page_id, html FROM html_links))"""


def _anchors(spark, sf):
    from urbanlens.sources.readers import extract_links

    pages = read_table(spark, sf, "pages", ["page_id", "html"]).unionByName(fx.html_links(spark, sf))
    return extract_links(pages)


@query("str_regex_match", section=SEC, sql=f"""
WITH {_ANCHORS_SQL} SELECT text, regexp_matches(text, '^.*day.*20..') AS is_dated, count(*) AS n FROM a GROUP BY 1, 2""")
def str_regex_match(spark, sf):
    """``re.match('.*day.*20..', text)`` on every link text (anchored at the start)."""
    a = _anchors(spark, sf)
    return a.groupBy("text", F.col("text").rlike(r"^.*day.*20..").alias("is_dated")).agg(F.count(F.lit(1)).alias("n"))


@query("str_concat_format", section=SEC, sql="""
SELECT trip_id, strftime(pickup_datetime, '%Y-%m-%d %H:') || printf('%02d:00', CAST(6 * floor(minute(pickup_datetime) / 6.0) AS INTEGER)) AS pickup_dt_group
FROM trips""")
def str_concat_format(spark, sf):
    return fx.trips(spark, sf).select("trip_id", T.six_minute_label("pickup_datetime").alias("pickup_dt_group"))


@query("cast_string", section=SEC, sql="""
SELECT CAST(trip_id AS VARCHAR) AS trip_key, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_text FROM trips""")
def cast_string(spark, sf):
    t = fx.trips(spark, sf)
    return t.select(F.col("trip_id").cast("string").alias("trip_key"),
                    T.format_ntz("pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_text"))


@query("parse_datetime_flexible", section=SEC, sql="""
SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE date_trunc('second', ts) END AS parsed FROM events""")
def parse_datetime_flexible(spark, sf):
    """Dates in two layouts (``MM/dd/yyyy`` and ``MM-dd-yy``) plus junk;
    the first layout that parses wins, junk is null."""
    e = read_table(spark, sf, "events", ["event_id", "ts"])
    text = (F.when(F.col("event_id") % 97 == 0, F.lit("13/45/2024 99:00:00"))
            .when(F.col("event_id") % 2 == 0, T.format_ntz("ts", "MM/dd/yyyy HH:mm:ss"))
            .otherwise(T.format_ntz("ts", "MM-dd-yy HH:mm:ss")))
    return e.select("event_id", T.parse_datetime_flexible(text).alias("parsed"))


@query("parse_date_compact", section=SEC, sql="SELECT DATE, CAST(strptime(DATE, '%Y%m%d') AS DATE) AS day FROM weather")
def parse_date_compact(spark, sf):
    return fx.weather(spark, sf).select("DATE", T.parse_date_compact("DATE").alias("day"))


@query("parse_long_date", section=SEC, sql="""
SELECT page_id, CAST(strptime(regexp_replace(regexp_extract(html, '>([^<]*)</a>', 1), '^\\s*[A-Za-z]+,\\s*', ''), '%B %d, %Y') AS DATE) AS day
FROM html_links""")
def parse_long_date(spark, sf):
    h = fx.html_links(spark, sf)
    return h.select("page_id", T.parse_long_date(F.regexp_extract("html", ">([^<]*)</a>", 1)).alias("day"))


@query("epoch_micros_to_ts", section=SEC, sql="""
SELECT event_id, epoch_us(ts) AS us, make_timestamp(epoch_us(ts) - epoch_us(ts) % 1000000) AS ts_s FROM events""")
def epoch_micros_to_ts(spark, sf):
    """int64 microseconds since the epoch back to a timestamp, truncated to
    seconds (the Parquet int64 layout of the ingest step)."""
    e = read_table(spark, sf, "events", ["event_id", "ts"]).select("event_id", T.epoch_micros("ts").alias("us"))
    return e.select("event_id", "us", T.epoch_micros_to_ts("us").alias("ts_s"))


@query("local_to_utc", section=SEC, sql=f"""
SELECT trip_id, {utc_from_local('pickup_datetime')} AS pickup_utc FROM trips""")
def local_to_utc(spark, sf):
    return fx.trips(spark, sf).select("trip_id", T.local_to_utc("pickup_datetime").alias("pickup_utc"))


@query("bin_6min", section=SEC, sql=f"SELECT trip_id, {floor_ts('pickup_datetime', 360)} AS bin FROM trips")
def bin_6min(spark, sf):
    return fx.trips(spark, sf).select("trip_id", T.bin_minutes("pickup_datetime", 6).alias("bin"))


@query("trunc_minute", section=SEC, sql="SELECT event_id, date_trunc('minute', ts) AS minute_ts FROM events")
def trunc_minute(spark, sf):
    return read_table(spark, sf, "events", ["event_id", "ts"]).select(
        "event_id", T.trunc_minute("ts").alias("minute_ts"))


@query("trunc_day", section=SEC, sql="SELECT ride_id, date_trunc('day', start_time) AS day FROM bike")
def trunc_day(spark, sf):
    return fx.bike(spark, sf).select("ride_id", T.trunc_day("start_time").alias("day"))


@query("trunc_week_epoch", section=SEC, sql=f"SELECT ride_id, {floor_ts('start_time', 7 * 86400)} AS week FROM bike")
def trunc_week_epoch(spark, sf):
    """Weeks counted from 1970-01-01 (a Thursday), as numpy ``M8[W]``."""
    return fx.bike(spark, sf).select("ride_id", T.trunc_week_epoch("start_time").alias("week"))


@query("is_business_day", section=SEC, sql="SELECT ride_id, (dayofweek(start_time) + 6) % 7 < 5 AS is_bus_day FROM bike")
def is_business_day(spark, sf):
    return fx.bike(spark, sf).select("ride_id", T.is_business_day("start_time").alias("is_bus_day"))


@query("weekday_name", section=SEC, sql="SELECT ride_id, dayname(start_time) AS weekday_name FROM bike")
def weekday_name(spark, sf):
    return fx.bike(spark, sf).select("ride_id", T.weekday_name("start_time").alias("weekday_name"))


@query("iso_week", section=SEC, sql="SELECT ride_id, CAST(weekofyear(start_time) AS INTEGER) AS week_of_year FROM bike")
def iso_week(spark, sf):
    return fx.bike(spark, sf).select("ride_id", T.iso_week("start_time").alias("week_of_year"))


_H, _M, _D = "hour(start_time)", "minute(start_time)", "dayofyear(start_time)"


@query("frac_of_year", section=SEC, sql=f"""
SELECT ride_id, {_D} / 365.0 + {_H} / 24.0 / 365.0 + {_M} / 60.0 / 24.0 / 365.0 AS frac_of_year FROM bike""")
def frac_of_year(spark, sf):
    return fx.bike(spark, sf).select("ride_id", T.frac_of_year("start_time").alias("frac_of_year"))


@query("frac_of_day", section=SEC, sql=f"SELECT ride_id, {_H} / 24.0 + {_M} / 60.0 / 24.0 AS frac_of_day FROM bike")
def frac_of_day(spark, sf):
    return fx.bike(spark, sf).select("ride_id", T.frac_of_day("start_time").alias("frac_of_day"))


@query("frac_of_hour", section=SEC, sql=f"SELECT ride_id, {_M} / 60.0 AS frac_of_hour FROM bike")
def frac_of_hour(spark, sf):
    return fx.bike(spark, sf).select("ride_id", T.frac_of_hour("start_time").alias("frac_of_hour"))


@query("position_in_week", section=SEC, sql=f"""
SELECT ride_id, (dayofweek(start_time) + 6) % 7 + {_H} / 24.0 + {_M} / 60.0 / 24.0 AS position_in_week FROM bike""")
def position_in_week(spark, sf):
    return fx.bike(spark, sf).select("ride_id", T.position_in_week("start_time").alias("position_in_week"))


@query("business_hour_fwd", section=SEC, sql=f"""
SELECT ride_id, {hours_between('start_time', bh_add_sql('start_time'))} - 1.0 AS hours_till_next_business_hour FROM bike""")
def business_hour_fwd(spark, sf):
    return fx.bike(spark, sf).select(
        "ride_id", T.business_hour_fwd("start_time").alias("hours_till_next_business_hour"))


@query("business_hour_back", section=SEC, sql=f"""
SELECT ride_id, {hours_between('start_time', bh_sub_sql('start_time'))} AS hours_back,
  {hours_between('start_time', bh_sub_sql('start_time'))} + 1.0 AS hours_back_plus_one FROM bike""")
def business_hour_back(spark, sf):
    b = fx.bike(spark, sf)
    return b.select("ride_id", T.business_hour_back("start_time").alias("hours_back"),
                    T.business_hour_back("start_time", plus_one=True).alias("hours_back_plus_one"))


_ZC = "zc AS (SELECT pickup_taxizone_id AS z, count(*) AS n FROM trips WHERE pickup_taxizone_id IS NOT NULL GROUP BY 1)"


def _zone_counts(spark, sf):
    t = fx.trips(spark, sf).where(F.col("pickup_taxizone_id").isNotNull())
    return t.groupBy(F.col("pickup_taxizone_id").alias("z")).agg(F.count(F.lit(1)).alias("n"))


@query("math_log10", section=SEC, sql=f"""
WITH {_ZC} SELECT z, round(log10(n + 1), 9) AS log_n_plus_1, round(CASE WHEN n > 0 THEN log10(n) END, 9) AS log_n FROM zc""")
def math_log10(spark, sf):
    """``log10(n+1)`` and ``log10(n)``; log of 0 is null (guarded on both sides)."""
    c = _zone_counts(spark, sf)
    return c.select("z", F.round(F.log10(F.col("n") + 1), 9).alias("log_n_plus_1"),
                    F.round(F.when(F.col("n") > 0, F.log10("n")), 9).alias("log_n"))


@query("math_ln", section=SEC, sql=f"WITH {_ZC} SELECT z, round(CASE WHEN n > 0 THEN ln(n) END, 9) AS ln_n FROM zc")
def math_ln(spark, sf):
    return _zone_counts(spark, sf).select("z", F.round(F.when(F.col("n") > 0, F.log("n")), 9).alias("ln_n"))


@query("math_misc", section=SEC, sql="""
SELECT ride_id, abs(start_station_longitude + 73.95) AS abs_dlon, CAST(floor(start_station_latitude * 100) AS BIGINT) AS lat_floor,
  CAST(ceil(start_station_longitude * 100) AS BIGINT) AS lon_ceil,
  round(start_station_latitude / start_station_longitude, 9) AS ratio,
  round(cos(radians(start_station_latitude)), 9) AS cos_lat,
  round(111194.9 * cos(radians(start_station_latitude)), 6) AS m_per_deg_lon,
  CAST(ceil(ride_id / 1000.0) AS BIGINT) AS n_jobs
FROM bike""")
def math_misc(spark, sf):
    lat, lon = F.col("start_station_latitude"), F.col("start_station_longitude")
    b = fx.bike(spark, sf)
    return b.select(
        "ride_id", F.abs(lon + 73.95).alias("abs_dlon"), F.floor(lat * 100).alias("lat_floor"),
        F.ceil(lon * 100).alias("lon_ceil"), F.round(lat / lon, 9).alias("ratio"),
        F.round(F.cos(F.radians(lat)), 9).alias("cos_lat"),
        F.round(G.metres_per_degree_lon(lat), 6).alias("m_per_deg_lon"),
        F.ceil(F.col("ride_id") / 1000.0).alias("n_jobs"))


@query("unit_scale", section=SEC, sql="SELECT DATE, PRCP * 86400 * 24 AS prcp_scaled FROM weather")
def unit_scale(spark, sf):
    return fx.weather(spark, sf).select("DATE", (F.col("PRCP") * 86400 * 24).alias("prcp_scaled"))


@query("make_point", section=SEC, sql="""
SELECT ride_id, {'x': start_station_longitude, 'y': start_station_latitude}.x AS point_x,
  {'x': start_station_longitude, 'y': start_station_latitude}.y AS point_y FROM bike""")
def make_point(spark, sf):
    p = fx.bike(spark, sf).select("ride_id", G.make_point("start_station_longitude", "start_station_latitude").alias("geom"))
    return p.select("ride_id", F.col("geom.x").alias("point_x"), F.col("geom.y").alias("point_y"))


def _lcc_select() -> str:
    """Select list computing lon/lat from ``x_ft, y_ft`` with lateral aliases."""
    e, n, big_f, rho0 = G._lcc_constants()
    parts = [f"(x_ft - {G.LCC_FALSE_EASTING_FT!r}) * {G.US_FOOT_M!r} AS xm",
             f"{rho0!r} - (y_ft - {G.LCC_FALSE_NORTHING_FT!r}) * {G.US_FOOT_M!r} AS dy",
             f"pow(sqrt(xm * xm + dy * dy) / {G.LCC_A * big_f!r}, {1.0 / n!r}) AS t",
             f"{math.pi / 2!r} - 2.0 * atan(t) AS l0"]
    for i in range(1, 7):
        es = f"({e!r} * sin(l{i - 1}))"
        parts.append(f"{math.pi / 2!r} - 2.0 * atan(t * pow((1.0 - {es}) / (1.0 + {es}), {e / 2!r})) AS l{i}")
    parts.append(f"round(degrees(atan2(xm, dy) / {n!r} + {math.radians(G.LCC_LON0)!r}), 7) AS lon")
    parts.append("round(degrees(l6), 7) AS lat")
    return ",\n  ".join(parts)


@query("reproject_lcc", section=SEC, sql=f"""
WITH p AS (SELECT trip_id, CAST(900000 + (trip_id * 7919) % 200000 AS DOUBLE) AS x_ft,
                  CAST(120000 + (trip_id * 104729) % 150000 AS DOUBLE) AS y_ft FROM trips)
SELECT trip_id, lon, lat FROM (SELECT trip_id, {_lcc_select()} FROM p)""")
def reproject_lcc(spark, sf):
    """State Plane (Long Island, US feet) to longitude/latitude, closed form."""
    t = fx.trips(spark, sf).select(
        "trip_id", (F.lit(900000) + (F.col("trip_id") * 7919) % 200000).cast("double").alias("x_ft"),
        (F.lit(120000) + (F.col("trip_id") * 104729) % 150000).cast("double").alias("y_ft"))
    p = t.select("trip_id", G.lcc_to_lonlat("x_ft", "y_ft").alias("p"))
    return p.select("trip_id", F.round("p.lon", 7).alias("lon"), F.round("p.lat", 7).alias("lat"))


@query("polygon_centroid", section=SEC, sql="""
WITH s AS (SELECT LocationID, sum(x1 * y2 - x2 * y1) AS a2, sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS cx,
             sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS cy FROM zone_edges GROUP BY LocationID)
SELECT LocationID, round(cx / (3.0 * a2), 9) AS centroid_x, round(cy / (3.0 * a2), 9) AS centroid_y,
  round(a2 / 2.0, 12) AS area FROM s WHERE LocationID IN (SELECT pickup_taxizone_id FROM trips)""")
def polygon_centroid(spark, sf):
    """Shoelace centroid of every zone the trips use."""
    used = fx.trips(spark, sf).select(F.col("pickup_taxizone_id").alias("LocationID"))
    z = fx.zones(spark).join(used, "LocationID", "left_semi")
    c = z.select("LocationID", G.polygon_centroid("rings").alias("c"))
    return c.select("LocationID", F.round("c.x", 9).alias("centroid_x"), F.round("c.y", 9).alias("centroid_y"),
                    F.round("c.area", 12).alias("area"))
