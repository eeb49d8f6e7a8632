"""Raw edge files (CSV eras, turnstile text, station feed, URL lists) written
from the driver tables into the shared scratch folder, so the readers in
this package are exercised on real files whose rows grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions.timeparts import format_ntz
from urbanlens.session import scratch_path
from urbanlens.sources import fixtures as fx

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def write_lines(lines: DataFrame, path: str, header: str | None = None, compression: str | None = None) -> str:
    """Write a one-column ``value`` frame as text files; an optional header
    line goes first in every file (as in per-month CSV downloads)."""
    if header is None:
        w = lines.write.mode("overwrite")
        if compression:
            w = w.option("compression", compression)
        w.text(path)
        return path
    # The CSV writer puts the header at the top of every part file. Naming the
    # single column after the header line, with separator and quote set to
    # control characters that never occur, writes both lines verbatim.
    w = (lines.select("value").toDF(header).write.mode("overwrite").option("header", True)
         .option("sep", "\u0001").option("quote", "\u0002").option("escape", "\u0003"))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def _fmt(c: str):
    return F.coalesce(format_ntz(F.col(c), TS_FMT), F.lit(""))


def _num(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


# Column layouts of the three feeds, one per era (positional; the header
# text in the files differs from these names on purpose).
GREEN_ERA_1 = ["vendor_id", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag", "rate_code_id",
               "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "passenger_count",
               "trip_distance", "fare_amount", "junk1", "junk2"]
YELLOW_ERA_1 = ["vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
                "pickup_longitude", "pickup_latitude", "rate_code_id", "store_and_fwd_flag",
                "dropoff_longitude", "dropoff_latitude", "fare_amount"]


# File names of the written eras, in the order of ``eras.LAYOUTS``.
ERA_FILES = (
    ("green_tripdata_2013-08.csv", "green_tripdata_2014-02.csv"), ("green_tripdata_2015-03.csv",),
    ("green_tripdata_2015-08.csv", "green_tripdata_2015-11.csv", "green_tripdata_2016-05.csv"),
    ("green_tripdata_2016-07.csv", "green_tripdata_2016-12.csv"),
    ("yellow_tripdata_2009-03.csv", "yellow_tripdata_2012-07.csv"), ("yellow_tripdata_2015-10.csv", "yellow_tripdata_2016-06.csv"),
    ("yellow_tripdata_2016-09.csv", "yellow_tripdata_2016-10.csv"), ("uber-raw-data-apr14.csv",), ("uber-raw-data-janjune-15.csv",),
)


def trip_files(spark: SparkSession, sf: str) -> str:
    """All trips as era-named CSV files in one folder, written in one pass.

    Green trips go through four layouts (by id modulo 4), yellow through
    three, ride-hail and untyped ones through two. Passenger counts and fees use ``NA`` for
    missing; some rows fill the trailing junk columns.
    """
    from urbanlens.sources.eras import LAYOUTS, WIDTH

    t, k = fx.trips(spark, sf), F.col("trip_id")
    era = (F.when(F.col("trip_type") == "green", k % 4).when(F.col("trip_type") == "yellow", 4 + k % 3).otherwise(7 + k % 2)).cast("int")
    file = F.element_at(F.array(*[F.element_at(F.array(*[F.lit(n) for n in names]), (F.floor(k / 12) % len(names) + 1).cast("int"))
                                  for names in ERA_FILES]), F.col("era") + 1)
    junk = F.when(k % 7 == 0, F.lit("X1")).otherwise(F.lit(""))
    text = {
        "vendor_id": F.when(k % 2 == 0, F.lit("VTS")).otherwise(F.lit("CMT")), "rate_code_id": (F.lit(1) + k % 3).cast("string"),
        "store_and_fwd_flag": F.when(k % 4 == 0, F.lit("Y")).otherwise(F.lit("N")),
        "passenger_count": F.when(F.col("passenger_count") == "", F.lit("NA")).otherwise(F.col("passenger_count")),
        "pickup_datetime": _fmt("pickup_datetime"), "dropoff_datetime": _fmt("dropoff_datetime"),
        "extra": ((k % 3) / 2).cast("string"), "mta_tax": F.lit("0.5"), "tip_amount": ((k % 20) / 4).cast("string"),
        "tolls_amount": ((k % 5) / 2).cast("string"), "ehail_fee": F.when(k % 9 == 0, F.lit("1.0")).otherwise(F.lit("NA")),
        "improvement_surcharge": F.lit("0.3"), "total_amount": (F.col("fare_amount") * 2).cast("string"),
        "payment_type": (F.lit(1) + k % 4).cast("string"), "trip_type": F.lit("1"), "junk1": junk, "junk2": junk,
    }
    rows = t.withColumn("era", era)

    def field(i: int):
        at = [(e, x.names()[i]) for e, x in enumerate(LAYOUTS) if i < len(x.names())]
        return F.coalesce(*[F.when(F.col("era") == e, text.get(n, _num(n) if n in t.columns else F.lit(""))) for e, n in at], F.lit(""))

    path = scratch_path(spark, "raw-trips")
    (rows.select(file.alias("file"), *[field(i).alias(f"field {i}") for i in range(WIDTH)])
     .write.mode("overwrite").option("header", True).option("emptyValue", "").partitionBy("file").csv(path))
    return path


def taxi_csv_eras(spark: SparkSession, sf: str, kinds=("green", "yellow", "uber")) -> dict[str, str]:
    """Write the trips of ``kinds`` (green, yellow, ride-hail) as CSV text with
    their own column orders, header rows, ``NA`` / ``\\N`` null tokens and, for
    green, two extra trailing fields on some rows. Returns {kind: directory}."""
    t = fx.trips(spark, sf)
    base = scratch_path(spark, "raw-taxi")
    k = F.col("trip_id")
    pc = F.when(F.col("passenger_count") == "", F.lit("NA")).otherwise(F.col("passenger_count"))
    vendor = F.when(k % 2 == 0, F.lit("VTS")).otherwise(F.lit("CMT"))
    rate = (F.lit(1) + k % 3).cast("string")
    flag = F.when(k % 4 == 0, F.lit("Y")).otherwise(F.lit("N"))
    green = t.where(F.col("trip_type") == "green").select(F.concat_ws(
        ",", vendor, _fmt("pickup_datetime"), _fmt("dropoff_datetime"), flag, rate,
        _num("pickup_longitude"), _num("pickup_latitude"), _num("dropoff_longitude"), _num("dropoff_latitude"),
        pc, _num("trip_distance"), _num("fare_amount"),
        F.when(k % 7 == 0, F.lit("X1,X2"))).alias("value"))
    yellow = t.where(F.col("trip_type") == "yellow").select(F.concat_ws(
        ",", vendor, _fmt("pickup_datetime"), _fmt("dropoff_datetime"), pc, _num("trip_distance"),
        _num("pickup_longitude"), _num("pickup_latitude"), rate, flag,
        _num("dropoff_longitude"), _num("dropoff_latitude"), _num("fare_amount")).alias("value"))
    uber = t.where(F.col("trip_type") == "uber").select(F.concat_ws(
        ",", _fmt("pickup_datetime"), _num("pickup_latitude"), _num("pickup_longitude"),
        F.lit("\\N")).alias("value"))
    lines = {
        "green": (green, f"{base}/green_tripdata_2015", "VendorID,lpep_pickup,lpep_dropoff,flag,rate,plon,plat,dlon,dlat,pc,dist,fare"),
        "yellow": (yellow, f"{base}/yellow_tripdata_2015", "vendor_name,Trip_Pickup,Trip_Dropoff,Passenger_Count,Trip_Distance,Start_Lon,Start_Lat,Rate_Code,store_and_forward,End_Lon,End_Lat,Fare_Amt"),
        "uber": (uber, f"{base}/uber-raw-data-2015", "Date/Time,Lat,Lon,Base"),
    }
    return {k: write_lines(*lines[k]) for k in kinds}


def turnstile_files(spark: SparkSession, sf: str) -> str:
    """Turnstile text split into one folder per first reading day
    (``day=MMdd``), the way dated downloads arrive; undated lines go to
    ``day=0000``."""
    raw = fx.turnstile_raw(spark, sf)
    md = F.regexp_extract("value", r",(\d\d)[-/](\d\d)[-/]\d{2,4},", 0)
    base = scratch_path(spark, "raw-turnstile")
    day = F.when(md != "", F.concat(F.substring(md, 2, 2), F.substring(md, 5, 2))).otherwise(F.lit("0000"))
    raw.withColumn("day", day).write.mode("overwrite").partitionBy("day").text(base)
    return base


def station_feed(spark: SparkSession, sf: str) -> str:
    """Station feed snapshots as JSON lines: one document per day, listing
    the stations trips started from that day (with the current coordinates),
    nested in ``stationBeanList`` with twelve extra fields."""
    cb = fx.citibike(spark, sf)
    i = F.col("id")
    s = (cb.select(F.to_date("start_time").alias("day"), F.col("start_station_id").alias("id"),
                   F.col("start_station_name").alias("stationName")).distinct()
         .withColumn("latitude", F.lit(40.70) + (i % 10) * F.lit(0.005))
         .withColumn("longitude", F.lit(-74.00) + F.floor(i / 10) * F.lit(0.005)))
    bean = F.struct(
        F.col("id"), F.col("stationName"), F.lit(0).alias("availableDocks"), F.lit(0).alias("totalDocks"),
        F.col("latitude"), F.col("longitude"), F.lit("In Service").alias("statusValue"), F.lit(1).alias("statusKey"),
        F.lit(0).alias("availableBikes"), F.lit("").alias("stAddress1"), F.lit("").alias("stAddress2"),
        F.lit("").alias("city"), F.lit("").alias("postalCode"), F.lit("").alias("location"),
        F.lit("").alias("altitude"), F.lit(False).alias("testStation"))
    # One document per day: its list is bounded by the number of stations.
    docs = (s.groupBy("day").agg(F.array_sort(F.collect_list(bean)).alias("stationBeanList"))
            .select(F.date_format("day", "yyyy-MM-dd").alias("executionTime"), "stationBeanList"))
    path = scratch_path(spark, "raw-stations")
    docs.write.mode("overwrite").json(path)
    return path


def weather_csv_gz(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "raw-weather")
    (fx.weather(spark, sf).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path))
    return path


BIKE_HEADER = ("tripduration,starttime,stoptime,start station id,start station name,start station latitude,"
               "start station longitude,end station id,end station name,end station latitude,"
               "end station longitude,bikeid,usertype,birth year,gender")


def bike_csv(spark: SparkSession, sf: str) -> str:
    """Bike CSV text with a header in each file (quoted names, as downloaded)."""
    b = fx.bike(spark, sf)
    line = F.concat_ws(",", _num("trip_duration"), _fmt("start_time"), _fmt("stop_time"), _num("start_station_id"),
                       "start_station_name", _num("start_station_latitude"), _num("start_station_longitude"),
                       _num("end_station_id"), "end_station_name", _num("end_station_latitude"),
                       _num("end_station_longitude"), (F.lit(14000) + F.col("ride_id") % 997).cast("string"), "user_type",
                       F.when(F.col("ride_id") % 5 == 0, F.lit("\\N")).otherwise((F.lit(1940) + F.col("ride_id") % 60).cast("string")),
                       (F.col("ride_id") % 3).cast("string"))
    return write_lines(b.select(line.alias("value")), scratch_path(spark, "raw-bike"), BIKE_HEADER)


def url_list(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "raw-urls")
    fx.url_catalog_lines(spark, sf).write.mode("overwrite").text(path)
    return path
