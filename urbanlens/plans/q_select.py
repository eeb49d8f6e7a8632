"""Section 2.3: projections, harmonisation, filters, conditional updates."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanlens.operators import clean as C
from urbanlens.operators.spatial import assign_zones, lookup_zone, zone_index
from urbanlens.operators.updates import Slices, fill_in_place, id_modulos, id_ranges
from urbanlens.plans.registry import query
from urbanlens.plans.sqlbits import pip_sql
from urbanlens.session import scratch_path
from urbanlens.sources import fixtures as fx
from urbanlens.sources.eras import narrow

SEC = "2.3"


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


@query("project_columns", section=SEC, sql="""
SELECT pickup_datetime, dropoff_datetime, pickup_taxizone_id, dropoff_taxizone_id, trip_distance, fare_amount, trip_type
FROM trips""")
def project_columns(spark, sf):
    cols = "pickup_datetime dropoff_datetime pickup_taxizone_id dropoff_taxizone_id trip_distance fare_amount trip_type"
    return fx.trips(spark, sf).select(*cols.split())


@query("rename_columns", section=SEC, sql="""
SELECT ride_id AS trip_id, start_station_id AS station_id, start_station_latitude AS lat, start_station_longitude AS lon
FROM bike""")
def rename_columns(spark, sf):
    """A rename map, then replacing all names at once (``toDF``)."""
    b = fx.bike(spark, sf).select("ride_id", "start_station_id", "start_station_latitude", "start_station_longitude")
    r = b.withColumnsRenamed({"ride_id": "trip_id", "start_station_id": "station_id"})
    return r.toDF("trip_id", "station_id", "lat", "lon")


@query("drop_columns", section=SEC, sql="""
SELECT trip_id, pickup_datetime, dropoff_datetime, pickup_taxizone_id, dropoff_taxizone_id, trip_type, fare_amount FROM trips""")
def drop_columns(spark, sf):
    return fx.trips(spark, sf).drop("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
                                    "trip_distance", "passenger_count")


@query("drop_all_null_columns", section=SEC, sql="""
SELECT trip_id, pickup_datetime, pickup_longitude, pickup_latitude, pickup_taxizone_id, trip_type, fare_amount,
  trip_distance, passenger_count FROM trips WHERE trip_type = 'uber'""")
def drop_all_null_columns(spark, sf):
    """Ride-hail rows have no drop-off data at all, so those columns go."""
    return C.drop_all_null_columns(fx.trips(spark, sf).where(F.col("trip_type") == "uber"))


@query("canonical_column_order", section=SEC, sql="""
SELECT dropoff_datetime, dropoff_taxizone_id, fare_amount, pickup_datetime, pickup_taxizone_id, trip_id, trip_type FROM trips""")
def canonical_column_order(spark, sf):
    t = fx.trips(spark, sf).select("trip_type", "trip_id", "pickup_datetime", "pickup_taxizone_id",
                                   "dropoff_datetime", "dropoff_taxizone_id", "fare_amount")
    return C.canonical_order(t)


_HARMONISE = {"ehail_fee": "double", "improvement_surcharge": "double", "rate_code_id": "int",
              "store_and_fwd_flag": "string", "trip_type": "string"}


@query("add_typed_null_column", section=SEC, sql="""
SELECT trip_id, trip_type, CAST(NULL AS DOUBLE) AS ehail_fee, CAST(NULL AS DOUBLE) AS improvement_surcharge,
  CAST(NULL AS INTEGER) AS rate_code_id, CAST(NULL AS VARCHAR) AS store_and_fwd_flag FROM trips""")
def add_typed_null_column(spark, sf):
    return C.add_typed_nulls(fx.trips(spark, sf).select("trip_id", "trip_type"), _HARMONISE)


@query("add_default_columns", section=SEC, sql="""
SELECT trip_id, trip_type, CAST(NULL AS DOUBLE) AS ehail_fee, CAST(NULL AS DOUBLE) AS improvement_surcharge,
  CAST(-999 AS INTEGER) AS rate_code_id, '' AS store_and_fwd_flag FROM trips""")
def add_default_columns(spark, sf):
    return C.add_defaults(fx.trips(spark, sf).select("trip_id", "trip_type"), _HARMONISE)


@query("copy_column", section=SEC, sql="""
SELECT trip_id, pickup_taxizone_id, pickup_taxizone_id AS pickup_zone_original FROM trips""")
def copy_column(spark, sf):
    t = fx.trips(spark, sf).select("trip_id", "pickup_taxizone_id")
    return t.withColumn("pickup_zone_original", F.col("pickup_taxizone_id"))


@query("add_literal_tag", section=SEC, sql="SELECT trip_id, fare_amount, 'green' AS trip_type FROM trips")
def add_literal_tag(spark, sf):
    return fx.trips(spark, sf).select("trip_id", "fare_amount").withColumn("trip_type", F.lit("green"))


@query("cast_by_schema", section=SEC, sql="""
SELECT trip_id, coalesce(TRY_CAST(trim(passenger_count) AS INTEGER), TRY_CAST(TRY_CAST(trim(passenger_count) AS DOUBLE) AS INTEGER)) AS passenger_count,
  CAST(pickup_taxizone_id AS DOUBLE) AS pickup_taxizone_id, CAST(trip_id AS VARCHAR) AS trip_key FROM trips""")
def cast_by_schema(spark, sf):
    t = fx.trips(spark, sf).select("trip_id", "passenger_count", "pickup_taxizone_id",
                                   F.col("trip_id").alias("trip_key"))
    return C.cast_by_schema(t, {"passenger_count": "int", "pickup_taxizone_id": "double", "trip_key": "string"})


# The canonical trip columns with wide types, as text and doubles come out of the files.
_WIDE = """SELECT trip_id, pickup_datetime, dropoff_datetime, pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude,
  CAST(pickup_taxizone_id AS DOUBLE) AS pickup_taxizone_id, CAST(dropoff_taxizone_id AS DOUBLE) AS dropoff_taxizone_id,
  passenger_count, CAST(1 + trip_id % 3 AS VARCHAR) AS rate_code_id, fare_amount, trip_distance, (trip_id % 3) / 2 AS extra,
  0.5::DOUBLE AS mta_tax, (trip_id % 20) / 4 AS tip_amount, (trip_id % 5) / 2 AS tolls_amount, 1.0::DOUBLE AS ehail_fee,
  0.3::DOUBLE AS improvement_surcharge, fare_amount * 2 AS total_amount FROM trips"""
_FLOATS = ["dropoff_latitude", "dropoff_longitude", "ehail_fee", "extra", "fare_amount", "improvement_surcharge", "mta_tax",
           "pickup_latitude", "pickup_longitude", "tip_amount", "tolls_amount", "total_amount", "trip_distance"]
_INTS = ["pickup_taxizone_id", "dropoff_taxizone_id", "passenger_count", "rate_code_id"]


@query("cast_narrow", section=SEC, sql=f"""
SELECT trip_id, date_trunc('second', pickup_datetime) AS pickup_datetime, date_trunc('second', dropoff_datetime) AS dropoff_datetime,
  {', '.join(f'CAST({c} AS FLOAT) AS {c}' for c in _FLOATS)}, {', '.join(f'TRY_CAST({c} AS INTEGER) AS {c}' for c in _INTS)}
FROM ({_WIDE})""")
def cast_narrow(spark, sf):
    """The nineteen casts of the stored table, with ``eras.narrow``."""
    k = F.col("trip_id")
    t = fx.trips(spark, sf).drop("trip_type").withColumns({
        "pickup_taxizone_id": F.col("pickup_taxizone_id").cast("double"), "dropoff_taxizone_id": F.col("dropoff_taxizone_id").cast("double"),
        "rate_code_id": (F.lit(1) + k % 3).cast("string"), "extra": (k % 3) / 2, "mta_tax": F.lit(0.5), "tip_amount": (k % 20) / 4,
        "tolls_amount": (k % 5) / 2, "ehail_fee": F.lit(1.0), "improvement_surcharge": F.lit(0.3), "total_amount": F.col("fare_amount") * 2})
    return narrow(t)


@query("fillna_value", section=SEC, sql="""
SELECT trip_id, coalesce(pickup_taxizone_id, 266) AS pickup_taxizone_id, coalesce(dropoff_taxizone_id, 266) AS dropoff_taxizone_id,
  coalesce(dropoff_longitude, 0.0::DOUBLE) AS dropoff_longitude, coalesce(dropoff_latitude, 0.0::DOUBLE) AS dropoff_latitude FROM trips""")
def fillna_value(spark, sf):
    t = fx.trips(spark, sf).select("trip_id", "pickup_taxizone_id", "dropoff_taxizone_id",
                                   "dropoff_longitude", "dropoff_latitude")
    return t.fillna({"pickup_taxizone_id": 266, "dropoff_taxizone_id": 266,
                     "dropoff_longitude": 0.0, "dropoff_latitude": 0.0})


@query("fillna_all", section=SEC, sql="""
WITH od AS (SELECT coalesce(pickup_taxizone_id, 266) AS p, coalesce(dropoff_taxizone_id, 266) AS d, count(*) AS n
            FROM trips WHERE trip_type IS DISTINCT FROM 'uber' GROUP BY 1, 2),
lab AS (SELECT LocationID, CAST((LocationID * 7) % 45 AS DOUBLE) AS labels FROM zones)
SELECT CAST(od.p AS DOUBLE) AS pickup_taxizone_id, CAST(od.d AS DOUBLE) AS dropoff_taxizone_id,
  CAST(od.n AS DOUBLE) AS n_trips, coalesce(a.labels, 45.0::DOUBLE) AS pickup_cluster_id, coalesce(b.labels, 45.0::DOUBLE) AS dropoff_cluster_id
FROM od LEFT JOIN lab a ON od.p = a.LocationID LEFT JOIN lab b ON od.d = b.LocationID""")
def fillna_all(spark, sf):
    """Whole-frame ``fillna(45.)`` after two label joins (zone ids past the layer
    and the unknown zone 266 have no label and get 45)."""
    from urbanlens.operators.aggregate import od_counts

    od = od_counts(fx.trips(spark, sf), "pickup_taxizone_id", "dropoff_taxizone_id", count_col="trip_id")
    lab = F.broadcast(fx.zones(spark)   # 260 zones by construction
                      .select("LocationID", ((F.col("LocationID") * 7) % 45).cast("double").alias("labels")))
    m = (od.join(lab.withColumnsRenamed({"LocationID": "pickup_taxizone_id", "labels": "pickup_cluster_id"}),
                 "pickup_taxizone_id", "left")
         .join(lab.withColumnsRenamed({"LocationID": "dropoff_taxizone_id", "labels": "dropoff_cluster_id"}),
               "dropoff_taxizone_id", "left"))
    m = m.select(*[F.col(c).cast("double").alias(c) for c in m.columns])
    return m.fillna(45.0)


@query("filter_not_equal", section=SEC, sql="""
SELECT trip_id, trip_type FROM trips WHERE trip_type IS DISTINCT FROM 'uber'""")
def filter_not_equal(spark, sf):
    """pandas ``!=``: rows with a null trip type are kept."""
    return fx.trips(spark, sf).select("trip_id", "trip_type").where(~F.col("trip_type").eqNullSafe("uber"))


@query("filter_equal", section=SEC, sql="""
SELECT ride_id, start_station_id, user_type FROM bike WHERE user_type = 'Customer' AND start_station_id = 7""")
def filter_equal(spark, sf):
    b = fx.bike(spark, sf)
    return (b.where((F.col("user_type") == "Customer") & (F.col("start_station_id") == 7))
            .select("ride_id", "start_station_id", "user_type"))


@query("filter_range", section=SEC, sql="""
SELECT ride_id, start_station_latitude, start_station_longitude FROM bike
WHERE start_station_latitude > 40.0 AND start_station_latitude < 40.74
  AND start_station_longitude + 74.0 > -0.25 AND start_station_longitude + 74.0 < 0.02""")
def filter_range(spark, sf):
    lat, lon = F.col("start_station_latitude"), F.col("start_station_longitude")
    b = fx.bike(spark, sf).select("ride_id", "start_station_latitude", "start_station_longitude")
    return b.where((lat > 40.0) & (lat < 40.74) & (lon + 74.0 > -0.25) & (lon + 74.0 < 0.02))


@query("filter_or", section=SEC, sql="""
SELECT ride_id, start_station_id, end_station_id FROM bike WHERE start_station_id = 92 OR end_station_id = 92""")
def filter_or(spark, sf):
    b = fx.bike(spark, sf).select("ride_id", "start_station_id", "end_station_id")
    return b.where((F.col("start_station_id") == 92) | (F.col("end_station_id") == 92))


def _bbox(lon, lat, half):
    return (F.abs(F.col(lon) + 73.95) < half) & (F.abs(F.col(lat) - 40.75) < half)


@query("filter_bbox", section=SEC, sql="""
SELECT trip_id, abs(pickup_longitude + 73.95) < 0.5 AND abs(pickup_latitude - 40.75) < 0.5 AS inner_box
FROM trips WHERE (abs(pickup_longitude + 73.95) < 1 AND abs(pickup_latitude - 40.75) < 1)
   OR (abs(dropoff_longitude + 73.95) < 1 AND abs(dropoff_latitude - 40.75) < 1)""")
def filter_bbox(spark, sf):
    """Trips with either end inside the study box (±1°), flagged for the ±0.5° box."""
    t = fx.trips(spark, sf)
    keep = _bbox("pickup_longitude", "pickup_latitude", 1) | _bbox("dropoff_longitude", "dropoff_latitude", 1)
    return t.where(keep).select("trip_id", _bbox("pickup_longitude", "pickup_latitude", 0.5).alias("inner_box"))


@query("filter_null", section=SEC, sql="""
SELECT trip_id, pickup_longitude, pickup_latitude FROM trips
WHERE pickup_taxizone_id IS NULL AND pickup_longitude IS NOT NULL AND pickup_latitude IS NOT NULL""")
def filter_null(spark, sf):
    t = fx.trips(spark, sf)
    return (t.where(F.col("pickup_taxizone_id").isNull() & F.col("pickup_longitude").isNotNull()
                    & F.col("pickup_latitude").isNotNull())
            .select("trip_id", "pickup_longitude", "pickup_latitude"))


@query("filter_date_cutoff", section=SEC, sql="""
SELECT trip_id, pickup_datetime FROM trips WHERE pickup_datetime < TIMESTAMP '2000-07-01 00:00:00'""")
def filter_date_cutoff(spark, sf):
    return fx.trips(spark, sf).select("trip_id", "pickup_datetime").where(
        F.col("pickup_datetime") < _ts("2000-07-01 00:00:00"))


@query("filter_in_list", section=SEC, sql="""
SELECT ride_id, start_station_id FROM bike WHERE start_station_id IN (SELECT id FROM stations)""")
def filter_in_list(spark, sf):
    """``isin(list)`` where the list is computed: a left-semi join, so the list
    never travels through the driver."""
    b = fx.bike(spark, sf).select("ride_id", "start_station_id")
    from urbanlens.operators.joins import semi_join

    return semi_join(b, fx.stations(spark, sf), "start_station_id", "id")


@query("filter_threshold", section=SEC, sql="""
SELECT start_station_id, count(*) AS n FROM bike GROUP BY start_station_id HAVING count(*) > 100""")
def filter_threshold(spark, sf, threshold: int = 100):
    b = fx.bike(spark, sf)
    return b.groupBy("start_station_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > threshold)


def _located(spark):
    """The work of a slice: missing pickup zones filled from coordinates."""
    zones = zone_index(fx.zones(spark))
    return lambda t: assign_zones(t.select("trip_id", "pickup_longitude", "pickup_latitude", "pickup_taxizone_id"),
                                  zones, "pickup_longitude", "pickup_latitude", "pickup_taxizone_id").select("trip_id", "pickup_taxizone_id")


def _by_slice(rows):
    return rows.groupBy(F.col("slice").cast("bigint").alias("shard")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("trip_id").alias("min_id"), F.max("trip_id").alias("max_id"),
        F.count("pickup_taxizone_id").alias("n_located"), F.sum("pickup_taxizone_id").cast("bigint").alias("zone_sum"))


_LOCATED_SQL = f"""pu AS (SELECT trip_id, pickup_longitude AS lon, pickup_latitude AS lat FROM trips
  WHERE pickup_taxizone_id IS NULL AND pickup_longitude <> 0 AND pickup_latitude <> 0), hp AS {pip_sql('pu', 'trip_id', 'lon', 'lat')},
l AS (SELECT t.trip_id, coalesce(t.pickup_taxizone_id, hp.zid) AS zone FROM trips t LEFT JOIN hp ON t.trip_id = hp.trip_id)"""


@query("shard_mod", section=SEC, sql=f"""
WITH {_LOCATED_SQL}
SELECT trip_id % 4 AS shard, count(*) AS n_rows, min(trip_id) AS min_id, max(trip_id) AS max_id, count(zone) AS n_located,
  CAST(sum(zone) AS BIGINT) AS zone_sum FROM l GROUP BY 1""")
def shard_mod(spark, sf, base: int = 4):
    """``MOD(id, base) = val`` slices of the zone update as a job that is stopped
    after one slice and gone on with; the slices' rows, read back, per slice."""
    job = Slices(spark, scratch_path(spark, "slices-mod"))
    trips, slices, work = fx.trips(spark, sf), id_modulos("trip_id", base), _located(spark)
    job.run(trips, slices, work, most=1)
    job.run(trips, slices, work)
    return _by_slice(job.rows())


@query("shard_id_range", section=SEC, sql=f"""
WITH {_LOCATED_SQL}, j AS (SELECT CAST(ceil(max(trip_id) / 4.0) AS BIGINT) AS size FROM trips)
SELECT CASE WHEN trip_id <= 0 THEN -1 ELSE (trip_id - 1) // size END AS shard, count(*) AS n_rows, min(trip_id) AS min_id, max(trip_id) AS max_id,
  count(zone) AS n_located, CAST(sum(zone) AS BIGINT) AS zone_sum FROM l, j GROUP BY 1""")
def shard_id_range(spark, sf, jobs: int = 4):
    """Job ``i`` covers ``i*n < id <= (i+1)*n`` with ``n = ceil(max(id)/jobs)``: the
    zone update, stopped after two slices and gone on with. Id 0 falls in slice -1."""
    trips = fx.trips(spark, sf)
    top = trips.agg(F.max("trip_id")).first()[0] or 1
    job = Slices(spark, scratch_path(spark, "slices-range"))
    slices, work = id_ranges("trip_id", -(-top // jobs), jobs), _located(spark)
    job.run(trips, slices, work, most=2)
    job.run(trips, slices, work)
    return _by_slice(job.rows())


@query("case_conditional_keep", section=SEC, sql="""
SELECT trip_id, CASE WHEN pickup_taxizone_id IS NULL AND pickup_longitude <> 0 AND pickup_latitude <> 0
  THEN dropoff_taxizone_id ELSE pickup_taxizone_id END AS pickup_taxizone_id FROM trips""")
def case_conditional_keep(spark, sf):
    t = fx.trips(spark, sf)
    needs = F.col("pickup_taxizone_id").isNull() & (F.col("pickup_longitude") != 0) & (F.col("pickup_latitude") != 0)
    return t.select("trip_id", F.when(needs, F.col("dropoff_taxizone_id"))
                    .otherwise(F.col("pickup_taxizone_id")).alias("pickup_taxizone_id"))


@query("coalesce_update", section=SEC, sql=f"""
WITH pts AS (SELECT trip_id, pickup_longitude AS lon, pickup_latitude AS lat FROM trips WHERE pickup_taxizone_id IS NULL),
hit AS {pip_sql('pts', 'trip_id', 'lon', 'lat')}
SELECT t.trip_id, coalesce(t.pickup_taxizone_id, CAST(hit.zid AS INTEGER)) AS pickup_taxizone_id
FROM trips t LEFT JOIN hit ON t.trip_id = hit.trip_id""")
def coalesce_update(spark, sf):
    """``UPDATE t SET c = COALESCE(c, new.c) FROM new`` on a table written by year:
    only the years with a row that changes are written again. The new values come
    from a spatial lookup; the table is read back."""
    t = fx.trips(spark, sf)
    path = scratch_path(spark, "trips-by-year")
    by_year = t.select("trip_id", "pickup_taxizone_id", F.year("pickup_datetime").alias("pickup_year"))
    by_year.write.partitionBy("pickup_year").parquet(path)
    new = lookup_zone(t.where(F.col("pickup_taxizone_id").isNull()).select("trip_id", "pickup_longitude", "pickup_latitude"),
                      fx.zones(spark), "pickup_longitude", "pickup_latitude", "pickup_taxizone_id").select("trip_id", "pickup_taxizone_id")
    fill_in_place(spark, path, new, "trip_id", "pickup_year", ["pickup_taxizone_id"])
    return spark.read.parquet(path).select("trip_id", "pickup_taxizone_id")


@query("preview_rows", section=SEC, sql="""
(SELECT trip_id, pickup_datetime, 'head' AS part FROM trips ORDER BY trip_id LIMIT 5)
UNION ALL (SELECT trip_id, pickup_datetime, 'tail' FROM trips ORDER BY trip_id DESC LIMIT 5)""")
def preview_rows(spark, sf, n: int = 5):
    """``head``/``tail``: top-n by the key from both ends (TakeOrderedAndProject)."""
    t = fx.trips(spark, sf).select("trip_id", "pickup_datetime")
    head = t.orderBy("trip_id").limit(n).withColumn("part", F.lit("head"))
    tail = t.orderBy(F.desc("trip_id")).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)
