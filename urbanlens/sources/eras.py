"""Trip files of several eras: the layout is chosen by file name.

The files of a folder are grouped by layout from the listing, and each group
is one scan of just that layout's columns, so a row meets one branch of the
code. The scans are united in canonical columns; columns that a layout lacks
are typed nulls.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions import timeparts as T


@dataclass(frozen=True)
class Layout:
    kind: str
    pattern: str
    columns: str

    def names(self) -> list[str]:
        return self.columns.split(",")


# File-name patterns and column order of each published layout.
LAYOUTS = (
    Layout("green", r"green_tripdata_201[34]",
           "vendor_id,pickup_datetime,dropoff_datetime,store_and_fwd_flag,rate_code_id,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,passenger_count,trip_distance,fare_amount,extra,mta_tax,tip_amount,tolls_amount,ehail_fee,total_amount,payment_type,trip_type,junk1,junk2"),
    Layout("green", r"green_tripdata_2015-0[1-6]",
           "vendor_id,pickup_datetime,dropoff_datetime,store_and_fwd_flag,rate_code_id,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,passenger_count,trip_distance,fare_amount,extra,mta_tax,tip_amount,tolls_amount,ehail_fee,improvement_surcharge,total_amount,payment_type,trip_type,junk1,junk2"),
    Layout("green", r"green_tripdata_(2015-0[7-9]|2015-1[0-2]|2016-0[1-6])",
           "vendor_id,pickup_datetime,dropoff_datetime,store_and_fwd_flag,rate_code_id,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,passenger_count,trip_distance,fare_amount,extra,mta_tax,tip_amount,tolls_amount,ehail_fee,improvement_surcharge,total_amount,payment_type,trip_type"),
    Layout("green", r"green_tripdata_(2016-0[7-9]|2016-1[0-2])",
           "vendor_id,pickup_datetime,dropoff_datetime,store_and_fwd_flag,rate_code_id,pickup_taxizone_id,dropoff_taxizone_id,passenger_count,trip_distance,fare_amount,extra,mta_tax,tip_amount,tolls_amount,ehail_fee,improvement_surcharge,total_amount,payment_type,trip_type,junk1,junk2"),
    Layout("yellow", r"yellow_tripdata_(201[0-4]|2009)",
           "vendor_id,pickup_datetime,dropoff_datetime,passenger_count,trip_distance,pickup_longitude,pickup_latitude,rate_code_id,store_and_fwd_flag,dropoff_longitude,dropoff_latitude,payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,total_amount"),
    Layout("yellow", r"yellow_tripdata_(2015|2016-0[1-6])",
           "vendor_id,pickup_datetime,dropoff_datetime,passenger_count,trip_distance,pickup_longitude,pickup_latitude,rate_code_id,store_and_fwd_flag,dropoff_longitude,dropoff_latitude,payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,improvement_surcharge,total_amount"),
    Layout("yellow", r"yellow_tripdata_(2016-0[7-9]|2016-1[0-2])",
           "vendor_id,pickup_datetime,dropoff_datetime,passenger_count,trip_distance,rate_code_id,store_and_fwd_flag,pickup_taxizone_id,dropoff_taxizone_id,payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,improvement_surcharge,total_amount,junk1,junk2"),
    Layout("uber", r"uber[^/]*-[a-z]{3}14", "pickup_datetime,pickup_latitude,pickup_longitude,junk1"),
    Layout("uber", r"uber[^/]*15", "junk1,pickup_datetime,junk2,pickup_taxizone_id"),
)

# Canonical columns and types; doubles and zone ids as read, before narrowing.
TRIP_TYPES = {
    "dropoff_datetime": "timestamp_ntz", "dropoff_latitude": "double", "dropoff_longitude": "double", "dropoff_taxizone_id": "int",
    "ehail_fee": "double", "extra": "double", "fare_amount": "double", "improvement_surcharge": "double", "mta_tax": "double",
    "passenger_count": "int", "payment_type": "string", "pickup_datetime": "timestamp_ntz", "pickup_latitude": "double",
    "pickup_longitude": "double", "pickup_taxizone_id": "int", "rate_code_id": "int", "store_and_fwd_flag": "string",
    "tip_amount": "double", "tolls_amount": "double", "total_amount": "double", "trip_distance": "double", "vendor_id": "string",
}
WIDTH = max(len(x.names()) for x in LAYOUTS)
NULL_TOKENS = ("NA", "\\N", "", "NaN", "nan", "NULL", "null", "N/A")
TS_FORMATS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss")


def layout_of(path: str) -> int | None:
    """Number of the first layout whose pattern occurs in the file's path, None if none does."""
    return next((i for i, x in enumerate(LAYOUTS) if re.search(x.pattern, path)), None)


def _csv(spark: SparkSession, columns: list[str]):
    """Positional text columns; each file's header line is skipped, extra trailing fields are dropped, missing ones are null."""
    return (spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("header", True).option("enforceSchema", True)
            .option("mode", "PERMISSIVE"))


def _typed(text: Column, name: str) -> Column:
    t = TRIP_TYPES[name]
    text = F.when(~text.isin(*NULL_TOKENS), text)
    return T.parse_datetime_flexible(text, TS_FORMATS) if t == "timestamp_ntz" else text if t == "string" else text.try_cast("double").cast(t)


def read_trip_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(trips in canonical columns with ``trip_type``, rows of files that match no layout).

    Columns that a feed lacks are null, those of ride-hail trips (no drop-off,
    no codes) like any other; a value that does not parse is null. The listing
    is the file index's own, so no file is opened for it.
    """
    any_file = _csv(spark, [f"c{i}" for i in range(WIDTH)]).option("recursiveFileLookup", True)
    groups: dict[int | None, list[str]] = {}
    for file in any_file.csv(path).inputFiles():
        groups.setdefault(layout_of(file), []).append(file)
    scans = []
    for i, files in sorted((i, f) for i, f in groups.items() if i is not None):
        names = LAYOUTS[i].names()
        rows = _csv(spark, names).csv(files)
        scans.append(rows.select(*[(_typed(F.col(c), c) if c in names else F.lit(None).cast(t)).alias(c) for c, t in TRIP_TYPES.items()],
                                 F.lit(LAYOUTS[i].kind).alias("trip_type")))
    empty = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in TRIP_TYPES.items()) + ", trip_type string")
    unknown = any_file.csv(groups[None]) if None in groups else spark.createDataFrame([], any_file.csv(path).schema)
    return reduce(DataFrame.unionAll, scans) if scans else empty, unknown


def narrow(trips: DataFrame) -> DataFrame:
    """The casts of the stored table: money, distance and coordinates to float, codes and ids to int, times to whole seconds."""
    out = []
    for c in trips.columns:
        t = TRIP_TYPES.get(c)
        out.append(F.col(c).cast("float").alias(c) if t == "double" else F.col(c).try_cast("int").alias(c) if t == "int"
                   else T.trunc_second(c).alias(c) if t == "timestamp_ntz" else F.col(c))
    return trips.select(*out)
