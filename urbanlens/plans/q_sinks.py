"""Section 2.2: sinks, layout and catalog operations.

Writers target fresh folders under the shared checkpoint dir and every query
returns the data read back, so the check covers the full write/read path.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from urbanlens.operators import clean as C
from urbanlens.operators import layout as L
from urbanlens.operators.spatial import lookup_zone
from urbanlens.plans.registry import query
from urbanlens.plans.sqlbits import pip_sql
from urbanlens.session import scratch_path
from urbanlens.sources import fixtures as fx

SEC = "2.2"


@query("sink_parquet", section=SEC, sql="SELECT * FROM trips")
def sink_parquet(spark, sf):
    """Parquet with GZIP (ingest) and SNAPPY (layout) codecs, read back."""
    t = fx.trips(spark, sf)
    gz = L.write_parquet(t, scratch_path(spark, "trips-gzip"), compression="gzip")
    sn = L.write_parquet(spark.read.parquet(gz), scratch_path(spark, "trips-snappy"), compression="snappy")
    return spark.read.parquet(sn)


@query("sink_overwrite", section=SEC, sql="SELECT * FROM bike")
def sink_overwrite(spark, sf):
    """A second write with ``mode('overwrite')`` replaces the first."""
    path = scratch_path(spark, "bike-ow")
    b = fx.bike(spark, sf)
    L.write_parquet(b.where(F.col("user_type") == "Customer"), path)
    L.write_parquet(b, path, mode="overwrite")
    return spark.read.parquet(path)


@query("sink_partition_by", section=SEC, sql=f"""
WITH pts AS (SELECT ride_id, start_station_longitude AS lon, start_station_latitude AS lat FROM bike),
hit AS {pip_sql('pts', 'ride_id', 'lon', 'lat')}
SELECT hit.zid AS start_taxizone_id, count(*) AS n FROM pts LEFT JOIN hit ON pts.ride_id = hit.ride_id GROUP BY 1""")
def sink_partition_by(spark, sf):
    """Bike trips written in one folder per start zone, read back; the
    partition column comes back from the folder names."""
    b = fx.bike(spark, sf).select("ride_id", "start_station_longitude", "start_station_latitude")
    z = lookup_zone(b, fx.zones(spark), "start_station_longitude", "start_station_latitude", "start_taxizone_id")
    path = scratch_path(spark, "bike-by-zone")
    L.write_parquet(z, path, partition_by=["start_taxizone_id"])
    back = spark.read.parquet(path)
    return back.groupBy(F.col("start_taxizone_id").cast("int").alias("start_taxizone_id")).agg(
        F.count(F.lit(1)).alias("n"))


@query("sink_csv", section=SEC, sql="SELECT * FROM bike")
def sink_csv(spark, sf):
    """CSV with a header (quoted names survive the round trip), read back
    with the schema."""
    path = scratch_path(spark, "bike-csv")
    b = fx.bike(spark, sf)
    b.write.mode("overwrite").option("header", True).csv(path)
    return spark.read.schema(b.schema).option("header", True).csv(path)


@query("sink_table_sorted", section=SEC, sql="SELECT trip_id, pickup_datetime, pickup_taxizone_id, fare_amount FROM trips")
def sink_table_sorted(spark, sf):
    """Table written in key order (range partitions, sorted inside), saved
    to the catalog with its data in the shared folder."""
    name = f"trips_sorted_{uuid.uuid4().hex[:8]}"
    t = fx.trips(spark, sf).select("trip_id", "pickup_datetime", "pickup_taxizone_id", "fare_amount")
    L.save_sorted_table(t, name, ["pickup_datetime", "trip_id"], scratch_path(spark, name))
    return spark.table(name)


@query("ctas", section=SEC, sql="""
SELECT trip_id, trip_type, pickup_taxizone_id FROM trips WHERE trip_type IN ('green', 'yellow')""")
def ctas(spark, sf):
    """``CREATE TABLE ... AS SELECT`` then ``INSERT INTO ... SELECT`` through
    Spark SQL, with the frame pushed to a named staging view."""
    name = f"trips_ctas_{uuid.uuid4().hex[:8]}"
    fx.trips(spark, sf).createOrReplaceTempView("trips_staging")
    path = scratch_path(spark, name)
    spark.sql(f"""CREATE TABLE {name} USING parquet LOCATION '{path}' AS
                  SELECT trip_id, trip_type, pickup_taxizone_id FROM trips_staging WHERE trip_type = 'green'""")
    spark.sql(f"""INSERT INTO {name}
                  SELECT trip_id, trip_type, pickup_taxizone_id FROM trips_staging WHERE trip_type = 'yellow'""")
    return spark.table(name)


@query("create_view_unlocated", section=SEC, sql="""
SELECT trip_id, pickup_longitude, pickup_latitude FROM trips
WHERE abs(pickup_longitude + 73.95) < 1 AND abs(pickup_latitude - 40.75) < 1 AND pickup_taxizone_id IS NULL""")
def create_view_unlocated(spark, sf):
    """View of rows with usable coordinates that still lack a zone id."""
    t = fx.trips(spark, sf)
    (t.where((F.abs(F.col("pickup_longitude") + 73.95) < 1) & (F.abs(F.col("pickup_latitude") - 40.75) < 1)
             & F.col("pickup_taxizone_id").isNull())
     .select("trip_id", "pickup_longitude", "pickup_latitude").createOrReplaceTempView("trips_unlocated"))
    return spark.sql("SELECT * FROM trips_unlocated")


@query("add_columns_if_missing", section=SEC, sql="""
SELECT trip_id, pickup_taxizone_id, dropoff_taxizone_id, CAST(NULL AS INTEGER) AS pickup_ct_id,
  CAST(NULL AS INTEGER) AS dropoff_ct_id FROM trips""")
def add_columns_if_missing(spark, sf):
    """``ADD COLUMN IF NOT EXISTS``: existing columns are left untouched."""
    t = fx.trips(spark, sf).select("trip_id", "pickup_taxizone_id", "dropoff_taxizone_id")
    return C.add_typed_nulls(t, {"pickup_taxizone_id": "int", "pickup_ct_id": "int", "dropoff_ct_id": "int"})


def _statistics_sql(column: str, kind: str) -> str:
    low, high = f"CAST(min({column}) AS VARCHAR)", f"CAST(max({column}) AS VARCHAR)"
    if kind == "timestamp_ntz":
        low, high = (f"strftime({f}({column}), '%Y-%m-%d %H:%M:%S.%f')" for f in ("min", "max"))
    elif kind == "string":
        low = high = "NULL"
    size = f"max(length({column}))" if kind == "string" else {"int": "4"}.get(kind, "8")
    height = "NULL" if kind == "string" else f"round(count({column}) / 254.0, 6)"
    return (f"SELECT '{column}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows, count(*) - count({column}) AS n_null, "
            f"{low} AS min_value, {high} AS max_value, CAST({size} AS BIGINT) AS max_len, CAST({height} AS DOUBLE) AS histogram_height FROM trips")


_TRIP_COLUMNS = {
    "trip_id": "bigint", "pickup_datetime": "timestamp_ntz", "dropoff_datetime": "timestamp_ntz", "pickup_longitude": "double",
    "pickup_latitude": "double", "dropoff_longitude": "double", "dropoff_latitude": "double", "pickup_taxizone_id": "int",
    "dropoff_taxizone_id": "int", "trip_type": "string", "fare_amount": "double", "trip_distance": "double", "passenger_count": "string"}


@query("profile_columns", section=SEC, sql=" UNION ALL ".join(_statistics_sql(c, k) for c, k in _TRIP_COLUMNS.items()))
def profile_columns(spark, sf):
    """``ANALYZE``: the catalog's statistics of every column of the saved trips table."""
    name = f"trips_analyzed_{uuid.uuid4().hex[:8]}"
    fx.trips(spark, sf).write.option("path", scratch_path(spark, name)).saveAsTable(name)
    found = L.catalog_statistics(spark, name)
    return found.select("column_name", "data_type", "n_rows", "n_null", "min_value", "max_value", "max_len",
                        F.round("histogram_height", 6).alias("histogram_height"))


@query("repartition_n", section=SEC, sql="SELECT ca, unit, scp, station, endtime, event_id FROM turnstile")
def repartition_n(spark, sf):
    return L.repartition_n(fx.turnstile_readings(spark, sf), 16)


@query("repartition_by_key", section=SEC, sql="SELECT trip_id, pickup_taxizone_id, pickup_datetime FROM trips")
def repartition_by_key(spark, sf):
    """Hash layout by zone (263 buckets), e.g. before writing per-zone series."""
    t = fx.trips(spark, sf).select("trip_id", "pickup_taxizone_id", "pickup_datetime")
    return L.repartition_by_key(t, "pickup_taxizone_id", 263, salt_buckets=4)


@query("range_index", section=SEC, sql="SELECT * FROM bike")
def range_index(spark, sf):
    """``set_index(col)``: global range order, sorted within partitions."""
    return L.range_index(fx.bike(spark, sf), "start_time", 8, tiebreak="ride_id")
