"""Section 2.1: scans and sources.

Raw edge files are first written from the driver tables (``sources.raw``),
then read back by the reader under test, so each query measures the real
scan path and its output grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanlens.operators import spatial as SP
from urbanlens.plans.sqlbits import pip_sql
from urbanlens.sources import eras as E
from urbanlens.sources import fixtures as fx
from urbanlens.sources import raw as R
from urbanlens.sources import readers as RD
from urbanlens.sources.tables import read_table, table_path
from urbanlens.plans.registry import query
from urbanlens.session import scratch_path
from urbanlens.streaming.ingest import ingest_new_files

SEC = "2.1"

TAXI_TYPES = {
    "vendor_id": "string", "pickup_datetime": "timestamp_ntz", "dropoff_datetime": "timestamp_ntz",
    "store_and_fwd_flag": "string", "rate_code_id": "int", "passenger_count": "int",
    "pickup_longitude": "double", "pickup_latitude": "double", "dropoff_longitude": "double",
    "dropoff_latitude": "double", "trip_distance": "double", "fare_amount": "double",
}

# Expected canonical rows per kind, computed from the same trips view.
_CANON = """
SELECT {cols} FROM (SELECT trip_type,
  CASE WHEN trip_type = 'uber' THEN NULL WHEN trip_id % 2 = 0 THEN 'VTS' ELSE 'CMT' END AS vendor_id,
  pickup_datetime, CASE WHEN trip_type <> 'uber' THEN dropoff_datetime END AS dropoff_datetime,
  CASE WHEN trip_type = 'uber' THEN NULL WHEN trip_id % 4 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CASE WHEN trip_type <> 'uber' THEN CAST(1 + trip_id % 3 AS INTEGER) END AS rate_code_id,
  TRY_CAST(NULLIF(passenger_count, '') AS INTEGER) AS passenger_count,
  pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
  CASE WHEN trip_type <> 'uber' THEN trip_distance END AS trip_distance,
  CASE WHEN trip_type <> 'uber' THEN fare_amount END AS fare_amount
  FROM trips WHERE trip_type IN ({kinds}))"""


def _canon(kinds, cols="*"):
    return _CANON.format(kinds=", ".join(f"'{k}'" for k in kinds), cols=cols)


@query("scan_csv_positional", section=SEC, sql=_canon(["yellow"], "* EXCLUDE (trip_type)"))
def scan_csv_positional(spark, sf):
    """Header row skipped and replaced by positional names; types imposed."""
    paths = R.taxi_csv_eras(spark, sf, ["yellow"])
    return RD.read_csv_positional(spark, paths["yellow"], R.YELLOW_ERA_1, TAXI_TYPES)


@query("scan_csv_null_tokens", section=SEC, sql="""
SELECT CAST(trip_id % 2 = 0 AS INTEGER) AS even_vendor,
  count(*) AS n, count(TRY_CAST(NULLIF(passenger_count, '') AS INTEGER)) AS n_passenger_count
FROM trips WHERE trip_type = 'green' GROUP BY 1""")
def scan_csv_null_tokens(spark, sf):
    """``NA`` in the passenger column reads as null (counted as missing)."""
    paths = R.taxi_csv_eras(spark, sf, ["green"])
    g = RD.read_csv_positional(spark, paths["green"], R.GREEN_ERA_1, TAXI_TYPES)
    return g.groupBy((F.col("vendor_id") == "VTS").cast("int").alias("even_vendor")).agg(
        F.count(F.lit(1)).alias("n"), F.count("passenger_count").alias("n_passenger_count"))


@query("scan_csv_bad_lines", section=SEC, sql=_canon(["green"], "* EXCLUDE (trip_type)"))
def scan_csv_bad_lines(spark, sf):
    """Rows with two extra trailing fields are absorbed by ``junk1, junk2``
    and those columns dropped."""
    paths = R.taxi_csv_eras(spark, sf, ["green"])
    return RD.read_csv_positional(spark, paths["green"], R.GREEN_ERA_1, TAXI_TYPES)


# Canonical trips as the nine layouts hold them: e is the layout's number.
_ERAS = """eras AS (SELECT trip_id, CASE WHEN e >= 7 THEN 'uber' ELSE trip_type END AS trip_type, e, passenger_count, pickup_datetime, fare_amount, trip_distance,
  CASE WHEN e IN (3, 6, 8) THEN NULL ELSE pickup_longitude END AS pickup_longitude, CASE WHEN e IN (3, 6, 8) THEN NULL ELSE pickup_latitude END AS pickup_latitude,
  CASE WHEN e IN (0, 1, 2, 4, 5) THEN dropoff_longitude END AS dropoff_longitude, CASE WHEN e IN (0, 1, 2, 4, 5) THEN dropoff_latitude END AS dropoff_latitude,
  CASE WHEN e IN (3, 6, 8) THEN pickup_taxizone_id END AS pickup_taxizone_id, CASE WHEN e IN (3, 6) THEN dropoff_taxizone_id END AS dropoff_taxizone_id,
  dropoff_datetime
  FROM (SELECT *, CAST(CASE trip_type WHEN 'green' THEN trip_id % 4 WHEN 'yellow' THEN 4 + trip_id % 3 ELSE 7 + trip_id % 2 END AS INTEGER) AS e FROM trips)),
canon AS (SELECT trip_id, trip_type, pickup_datetime, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
  pickup_taxizone_id, dropoff_taxizone_id,
  CASE WHEN e < 7 THEN dropoff_datetime END AS dropoff_datetime,
  CASE WHEN e >= 7 THEN NULL WHEN trip_id % 2 = 0 THEN 'VTS' ELSE 'CMT' END AS vendor_id,
  CASE WHEN e >= 7 THEN NULL WHEN trip_id % 4 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CASE WHEN e < 7 THEN CAST(1 + trip_id % 4 AS VARCHAR) END AS payment_type,
  CASE WHEN e < 7 THEN CAST(1 + trip_id % 3 AS INTEGER) END AS rate_code_id,
  CASE WHEN e < 7 THEN TRY_CAST(NULLIF(passenger_count, '') AS INTEGER) END AS passenger_count,
  CASE WHEN e < 7 THEN trip_distance END AS trip_distance, CASE WHEN e < 7 THEN fare_amount END AS fare_amount,
  CASE WHEN e < 7 THEN (trip_id % 3) / 2 END AS extra, CASE WHEN e < 7 THEN 0.5::DOUBLE END AS mta_tax,
  CASE WHEN e < 7 THEN (trip_id % 20) / 4 END AS tip_amount, CASE WHEN e < 7 THEN (trip_id % 5) / 2 END AS tolls_amount,
  CASE WHEN e < 4 AND trip_id % 9 = 0 THEN 1.0::DOUBLE END AS ehail_fee,
  CASE WHEN e IN (1, 2, 3, 5, 6) THEN 0.3::DOUBLE END AS improvement_surcharge,
  CASE WHEN e < 7 THEN fare_amount * 2 END AS total_amount FROM eras)"""


@query("scan_versioned_union", section=SEC, sql=f"WITH {_ERAS} SELECT * EXCLUDE (trip_id) FROM canon")
def scan_versioned_union(spark, sf, files: str | None = None):
    """Nine layouts in one folder, chosen by file name, one scan each, in
    canonical columns; missing columns are typed nulls. ``files``: a folder
    written before."""
    known, _unknown = E.read_trip_files(spark, files or R.trip_files(spark, sf))
    return known


def _zone_fill_sql(end: str) -> str:
    return (f"pts_{end} AS (SELECT trip_id, {end}_longitude AS lon, {end}_latitude AS lat FROM canon WHERE {end}_taxizone_id IS NULL "
            f"AND {end}_longitude <> 0 AND {end}_latitude <> 0), hit_{end} AS {pip_sql('pts_' + end, 'trip_id', 'lon', 'lat')}")


def _float_sql(c: str) -> str:
    return f"CAST({c} AS FLOAT) AS {c}"


_DOUBLES = [c for c, t in E.TRIP_TYPES.items() if t == "double"]


@query("ingest_taxi", section=SEC, sql=f"""
WITH {_ERAS}, {_zone_fill_sql('pickup')}, {_zone_fill_sql('dropoff')}
SELECT c.* EXCLUDE (trip_id, pickup_taxizone_id, dropoff_taxizone_id, {', '.join(_DOUBLES)}), {', '.join(_float_sql(c) for c in _DOUBLES)},
  CAST(coalesce(pickup_taxizone_id, p.zid) AS INTEGER) AS pickup_taxizone_id, CAST(coalesce(dropoff_taxizone_id, d.zid) AS INTEGER) AS dropoff_taxizone_id
FROM canon c LEFT JOIN hit_pickup p USING (trip_id) LEFT JOIN hit_dropoff d USING (trip_id)""")
def ingest_taxi(spark, sf, files: str | None = None):
    """The whole taxi ingest: era files to canonical trips, in ranges of the pickup
    time, zones filled for both ends, stored types, written as parquet and read back.

    The ranges are drawn before the lookups, so their sampling runs no lookup;
    these are broadcast joins and keep the order.
    """
    trips, _ = E.read_trip_files(spark, files or R.trip_files(spark, sf))
    trips = trips.repartitionByRange("pickup_datetime").sortWithinPartitions("pickup_datetime")
    zones = SP.zone_index(fx.zones(spark))
    for end in ("pickup", "dropoff"):
        trips = SP.assign_zones(trips, zones, f"{end}_longitude", f"{end}_latitude", f"{end}_taxizone_id")
    path = scratch_path(spark, "ingest-taxi")
    E.narrow(trips).write.parquet(path)
    return spark.read.parquet(path)


_TURNSTILE_EXPECTED = """
SELECT ca, unit, scp,
  CASE WHEN user_id % 2 = 0 THEN station END AS station,
  CASE WHEN user_id % 2 = 0 THEN linename END AS linename,
  CASE WHEN user_id % 2 = 0 THEN division END AS division,
  endtime, description, cumul_entries, cumul_exits FROM turnstile"""


@query("scan_ragged_text", section=SEC, sql=_TURNSTILE_EXPECTED)
def scan_ragged_text(spark, sf):
    """Ragged turnstile text (11-field and 3+5k-field lines) to readings."""
    good, _bad = RD.parse_turnstile(fx.turnstile_raw(spark, sf))
    return good


@query("scan_ragged_quarantine", section=SEC, sql="SELECT line, reason FROM turnstile_bad")
def scan_ragged_quarantine(spark, sf):
    """The lines the turnstile parser rejects, kept beside the readings, and why."""
    _good, bad = RD.parse_turnstile(fx.turnstile_raw(spark, sf))
    return bad.select("line", "reason")


@query("ingest_new_text", section=SEC, sql=f"""
SELECT *, CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reason FROM ({_TURNSTILE_EXPECTED})
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, line, reason FROM turnstile_bad""")
def ingest_new_text(spark, sf):
    """Turnstile files that arrive in two parts, taken in by a stream that is run
    after each: every file once, readings and rejected lines read back."""
    raw = scratch_path(spark, "turnstile-lines")
    fx.turnstile_raw(spark, sf).write.parquet(raw)
    lines, folder = spark.read.parquet(raw), scratch_path(spark, "turnstile-arriving")
    out, checkpoint = scratch_path(spark, "turnstile-ingested"), scratch_path(spark, "turnstile-progress")
    for part in (0, 1):
        lines.where(F.pmod(F.xxhash64("value"), F.lit(2)) == part).write.mode("append").text(folder)
        ingest_new_files(spark, folder, out, checkpoint)
    return spark.read.parquet(out).drop("rejected")


@query("scan_many_text_files", section=SEC, sql=f"SELECT *, 1 AS has_file FROM ({_TURNSTILE_EXPECTED})")
def scan_many_text_files(spark, sf):
    """A folder of dated text files read with one glob; ``_metadata`` gives
    the source file of every reading."""
    base = R.turnstile_files(spark, sf)
    lines = spark.read.text(f"{base}/day=*/*.txt").select("value", F.col("_metadata.file_path").alias("src"))
    good, _bad = RD.parse_turnstile(lines, carry=("src",))
    return good.withColumn("has_file", F.col("src").rlike(r"/day=\d{4}/").cast("int")).drop("src")


@query("scan_parquet_pruned", section=SEC, sql="""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders""")
def scan_parquet_pruned(spark, sf):
    return read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])


@query("scan_parquet_all", section=SEC, sql="SELECT * FROM lineitem")
def scan_parquet_all(spark, sf):
    return spark.read.parquet(table_path(sf, "lineitem"))


@query("scan_hive_partition", section=SEC, sql="""
SELECT ride_id, start_station_id, start_time, user_type FROM bike WHERE user_type = 'Customer'""")
def scan_hive_partition(spark, sf):
    """Directory-partitioned layout (``user_type=...``) and a read of a single
    ``key=value`` directory: the filter prunes the other folders unread."""
    path = scratch_path(spark, "bike-by-user-type")
    b = fx.bike(spark, sf).select("ride_id", "start_station_id", "start_time", "user_type")
    b.write.mode("overwrite").partitionBy("user_type").parquet(path)
    return spark.read.parquet(path).where(F.col("user_type") == "Customer") \
        .select("ride_id", "start_station_id", "start_time", "user_type")


@query("scan_json_nested", section=SEC, sql="""
SELECT DISTINCT strftime(CAST(start_time AS DATE), '%Y-%m-%d') AS executionTime, start_station_id AS id,
  trim(start_station_name, '"') AS stationName,
  CAST(40.70 AS DOUBLE) + (start_station_id % 10) * CAST(0.005 AS DOUBLE) AS latitude,
  CAST(-74.00 AS DOUBLE) + (start_station_id // 10) * CAST(0.005 AS DOUBLE) AS longitude
FROM bike""")
def scan_json_nested(spark, sf):
    """Nested feed snapshots: ``stationBeanList`` exploded to rows, the four
    needed fields kept, the other twelve dropped."""
    return RD.read_station_feed(spark, R.station_feed(spark, sf)).select(
        "executionTime", "id", "stationName", "latitude", "longitude")


@query("scan_compressed_csv", section=SEC, sql="SELECT * FROM weather")
def scan_compressed_csv(spark, sf):
    """Gzip CSV read through the codec picked from the file extension."""
    path = R.weather_csv_gz(spark, sf)
    schema = "DATE string, PRCP double, SNWD double, SNOW double, TMAX double, TMIN double, AWND double"
    return spark.read.schema(schema).option("header", True).csv(f"{path}/*.csv.gz")


BIKE_SCHEMA = ("trip_duration int, start_time string, stop_time string, start_station_id bigint, "
               "start_station_name string, start_station_latitude double, start_station_longitude double, "
               "end_station_id bigint, end_station_name string, end_station_latitude double, "
               "end_station_longitude double, bike_id bigint, user_type string, birth_year string, gender int")


_BIKE_SQL = """SELECT trip_duration, start_time, stop_time, start_station_id, trim(start_station_name, '"') AS start_station_name,
  start_station_latitude, start_station_longitude, end_station_id, trim(end_station_name, '"') AS end_station_name,
  end_station_latitude, end_station_longitude, 14000 + ride_id % 997 AS bike_id, user_type,
  CASE WHEN ride_id % 5 <> 0 THEN CAST(1940 + ride_id % 60 AS INTEGER) END AS birth_year, CAST(ride_id % 3 AS INTEGER) AS gender"""


def _bike_rows(spark, sf, drop: str = "start"):
    """All fifteen columns of the bike files; lines that contain ``drop`` (the headers) go before parsing."""
    lines = spark.read.text(R.bike_csv(spark, sf)).where(~F.col("value").contains(drop))
    p = lines.select(F.from_csv("value", BIKE_SCHEMA).alias("r")).select("r.*")
    stamp = F.lit("yyyy-MM-dd HH:mm:ss")
    return p.withColumns({"start_time": F.to_timestamp_ntz("start_time", stamp), "stop_time": F.to_timestamp_ntz("stop_time", stamp),
                          "birth_year": F.col("birth_year").try_cast("int")})


@query("scan_line_filter", section=SEC, sql=f"{_BIKE_SQL} FROM bike")
def scan_line_filter(spark, sf):
    """``grep -v start`` before parsing, the rest parsed with ``from_csv``."""
    return _bike_rows(spark, sf)


@query("ingest_bike", section=SEC, sql=f"""
WITH a AS (SELECT ride_id, start_station_longitude AS lon, start_station_latitude AS lat FROM bike),
b AS (SELECT ride_id, end_station_longitude AS lon, end_station_latitude AS lat FROM bike),
ha AS {pip_sql('a', 'ride_id', 'lon', 'lat')}, hb AS {pip_sql('b', 'ride_id', 'lon', 'lat')}
{_BIKE_SQL}, CAST(ha.zid AS INTEGER) AS start_taxizone_id, CAST(hb.zid AS INTEGER) AS end_taxizone_id
FROM bike LEFT JOIN ha USING (ride_id) LEFT JOIN hb USING (ride_id)""")
def ingest_bike(spark, sf):
    """The whole bike ingest: files to typed rows, zones of both ends, parquet."""
    rows, zones = _bike_rows(spark, sf), SP.zone_index(fx.zones(spark))
    for end in ("start", "end"):
        rows = SP.lookup_zone(rows, zones, f"{end}_station_longitude", f"{end}_station_latitude", f"{end}_taxizone_id")
    path = scratch_path(spark, "ingest-bike")
    rows.write.parquet(path)
    return spark.read.parquet(path)


@query("scan_polygons", section=SEC, sql="""
SELECT z.LocationID, z.zone, z.borough, count(e.k) AS n_edges FROM zones z JOIN zone_edges e ON z.LocationID = e.LocationID
WHERE z.LocationID IN (SELECT pickup_taxizone_id FROM trips) GROUP BY 1, 2, 3""")
def scan_polygons(spark, sf):
    """Zone polygons stored as a ring table, read back for the zones that the
    trips reference."""
    path = scratch_path(spark, "zones")
    fx.zones(spark).write.mode("overwrite").parquet(path)
    z = spark.read.parquet(path)
    used = fx.trips(spark, sf).select(F.col("pickup_taxizone_id").alias("LocationID"))
    return (z.join(used, "LocationID", "left_semi")
            .select("LocationID", "zone", "borough",
                    F.aggregate("rings", F.lit(0).cast("bigint"), lambda a, r: a + F.size(r) - 1).alias("n_edges")))


@query("scan_grid_long", section=SEC, sql="""
SELECT var, time, count(*) AS n, round(sum(value), 4) AS total FROM grid GROUP BY var, time""")
def scan_grid_long(spark, sf):
    """Gridded fields as a long parquet table; read back and summarised per
    (variable, time step)."""
    path = scratch_path(spark, "grid")
    fx.grid(spark, sf).write.mode("overwrite").parquet(path)
    g = spark.read.parquet(path)
    return g.groupBy("var", "time").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("scan_sql_query", section=SEC, sql="""
SELECT trip_type, count(*) AS n, round(avg(fare_amount), 6) AS avg_fare FROM trips GROUP BY trip_type""")
def scan_sql_query(spark, sf):
    """SQL text over a frame passed by reference (no shared view name)."""
    return spark.sql("""SELECT trip_type, count(*) AS n, round(avg(fare_amount), 6) AS avg_fare
                        FROM {trips} GROUP BY trip_type""", trips=fx.trips(spark, sf))


@query("source_link_manifest", section=SEC, sql="""
WITH pages_all AS (SELECT page_id, html FROM pages UNION ALL SELECT page_id, html FROM html_links),
a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s+href="([^"]*)"[^>]*>([^<]*)</a>', 1)) AS href,
        unnest(regexp_extract_all(html, '<a\\s+href="([^"]*)"[^>]*>([^<]*)</a>', 2)) AS text FROM pages_all),
m AS (SELECT 'http://example.org/developers/' || href AS url, string_split(href, '/')[-1] AS file_name,
        CAST(strptime(regexp_replace(text, '^\\s*[A-Za-z]+,\\s*', ''), '%B %d, %Y') AS DATE) AS file_date
      FROM a WHERE regexp_matches(text, '^.*day.*20..')),
present AS (SELECT DISTINCT 'turnstile_' || strftime(CAST(o_orderdate AS DATE), '%y%m%d') || '.txt' AS file_name
            FROM orders WHERE date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 3 = 0)
SELECT * FROM m WHERE file_name NOT IN (SELECT file_name FROM present)""")
def source_link_manifest(spark, sf):
    """Download links from the index pages; files already present (plain or
    ``.gz``; every third day here) are skipped."""
    pages = read_table(spark, sf, "pages", ["page_id", "html"]).unionByName(fx.html_links(spark, sf))
    d = read_table(spark, sf, "orders", ["o_orderdate"]).select(F.to_date("o_orderdate").alias("d")).distinct()
    n = F.datediff("d", F.lit("1995-01-01").cast("date"))
    present = d.where(n % 3 == 0).select(F.concat(
        F.lit("turnstile_"), F.date_format("d", "yyMMdd"), F.lit(".txt"),
        F.when(n % 2 == 0, F.lit(".gz")).otherwise(F.lit(""))).alias("name"))
    return RD.link_manifest(pages, present)


@query("source_url_catalog", section=SEC, sql="""
WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS ym,
             ['yellow', 'green', 'fhv', 'uber', 'citibike'][CAST(o_orderkey % 5 AS INTEGER) + 1] AS kind FROM orders)
SELECT kind, CAST(substr(ym, 1, 4) AS INTEGER) AS year, CAST(substr(ym, 6, 2) AS INTEGER) AS month, count(*) AS n_files
FROM d GROUP BY 1, 2, 3""")
def source_url_catalog(spark, sf):
    """URL lists parsed to (kind, year, month) per file name pattern."""
    lines = spark.read.text(R.url_list(spark, sf))
    c = RD.url_catalog(lines)
    return c.groupBy("kind", "year", "month").agg(F.count(F.lit(1)).alias("n_files"))
