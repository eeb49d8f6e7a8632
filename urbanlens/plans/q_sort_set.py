"""Sections 2.7 and 2.8: sorts, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanlens.operators import windows as W
from urbanlens.plans.registry import query
from urbanlens.sources import fixtures as fx

SEC = "2.7"


@query("sort_global", section=SEC, sql="SELECT trip_id, pickup_datetime FROM trips ORDER BY pickup_datetime")
def sort_global(spark, sf):
    # trip_id breaks ties so range partitioning can split repeated timestamps.
    return fx.trips(spark, sf).select("trip_id", "pickup_datetime").orderBy("pickup_datetime", "trip_id")


@query("sort_multi", section=SEC, sql="""
SELECT trip_type, pickup_datetime, trip_id FROM trips ORDER BY trip_type, pickup_datetime, trip_id""")
def sort_multi(spark, sf):
    return fx.trips(spark, sf).select("trip_type", "pickup_datetime", "trip_id").orderBy(
        "trip_type", "pickup_datetime", "trip_id")


@query("sort_desc_rank", section=SEC, sql="""
SELECT start_station_id, count(*) AS n FROM bike GROUP BY start_station_id ORDER BY n DESC, start_station_id LIMIT 10""")
def sort_desc_rank(spark, sf, k: int = 10):
    """Top-k stations by trips (ties broken by id): TakeOrderedAndProject."""
    b = fx.bike(spark, sf).groupBy("start_station_id").agg(F.count(F.lit(1)).alias("n"))
    return b.orderBy(F.desc("n"), "start_station_id").limit(k)


@query("sort_within_partition", section=SEC, sql="SELECT trip_id, pickup_datetime FROM trips")
def sort_within_partition(spark, sf):
    """Per-partition sort (no global order, no shuffle)."""
    return fx.trips(spark, sf).select("trip_id", "pickup_datetime").sortWithinPartitions("pickup_datetime")


@query("sort_index", section=SEC, sql="""
SELECT pickup_taxizone_id, count(*) AS n FROM trips WHERE pickup_taxizone_id IS NOT NULL GROUP BY 1 ORDER BY 1""")
def sort_index(spark, sf):
    t = fx.trips(spark, sf).where(F.col("pickup_taxizone_id").isNotNull())
    return t.groupBy("pickup_taxizone_id").agg(F.count(F.lit(1)).alias("n")).orderBy("pickup_taxizone_id")


@query("sort_list", section=SEC, sql="""
SELECT id, row_number() OVER (ORDER BY id) - 1 AS position FROM (SELECT DISTINCT start_station_id AS id FROM bike)""")
def sort_list(spark, sf):
    """Sorted distinct ids as (id, position) rows: the list stays a
    distributed table instead of one collected array."""
    ids = fx.bike(spark, sf).select(F.col("start_station_id").alias("id")).distinct()
    return W.dense_ids(ids, ["id"], "position", start=0)


SEC = "2.8"


@query("union_all", section=SEC, sql="""
SELECT start_station_id AS id, 'start' AS side FROM bike UNION ALL SELECT end_station_id, 'end' FROM bike""")
def union_all(spark, sf):
    b = fx.bike(spark, sf)
    return (b.select(F.col("start_station_id").alias("id"), F.lit("start").alias("side"))
            .unionByName(b.select(F.col("end_station_id").alias("id"), F.lit("end").alias("side"))))


@query("union_distinct", section=SEC, sql="""
SELECT start_station_id AS id FROM bike UNION SELECT end_station_id FROM bike""")
def union_distinct(spark, sf):
    b = fx.bike(spark, sf)
    return (b.select(F.col("start_station_id").alias("id"))
            .union(b.select(F.col("end_station_id").alias("id"))).distinct())


@query("all_ids_concat", section=SEC, sql="""
SELECT id, side FROM (SELECT DISTINCT start_station_id AS id, 'start' AS side FROM bike
  UNION ALL SELECT DISTINCT end_station_id, 'end' FROM bike) ORDER BY side DESC, id""")
def all_ids_concat(spark, sf):
    """Start ids then end ids, each side distinct, concatenated and sorted."""
    b = fx.bike(spark, sf)
    s = b.select(F.col("start_station_id").alias("id")).distinct().withColumn("side", F.lit("start"))
    e = b.select(F.col("end_station_id").alias("id")).distinct().withColumn("side", F.lit("end"))
    return s.unionByName(e).orderBy(F.desc("side"), "id")
