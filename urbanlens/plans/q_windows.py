"""Section 2.6: ordered differences, first-match dedup and row ids."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanlens.operators import spatial as SP
from urbanlens.operators import windows as W
from urbanlens.plans.registry import query
from urbanlens.plans.sqlbits import pip_pairs_sql
from urbanlens.session import reliable_checkpoint
from urbanlens.sources import fixtures as fx

SEC = "2.6"

_DELTA = """d AS (SELECT ca, unit, scp, endtime, event_id,
  cumul_entries - lag(cumul_entries) OVER w AS cumul_entries,
  cumul_exits - lag(cumul_exits) OVER w AS cumul_exits,
  row_number() OVER w AS rn
  FROM turnstile WINDOW w AS (PARTITION BY ca, unit, scp ORDER BY endtime, event_id))"""


@query("counter_delta", section=SEC, sql=f"""
WITH {_DELTA} SELECT ca, unit, scp, endtime, event_id, cumul_entries, cumul_exits FROM d WHERE rn > 1""")
def counter_delta(spark, sf):
    """First differences of the cumulative counters per turnstile, ordered by
    time (event id breaks ties); the first reading of each turnstile is dropped."""
    t = fx.turnstile(spark, sf).select("ca", "unit", "scp", "endtime", "event_id", "cumul_entries", "cumul_exits")
    return W.counter_delta(t, ["ca", "unit", "scp"], ["endtime", "event_id"], ["cumul_entries", "cumul_exits"])


@query("counter_delta_by_time", section=SEC, sql=f"""
WITH {_DELTA} SELECT endtime, CAST(sum(cumul_entries) AS BIGINT) AS cumul_entries,
  CAST(sum(cumul_exits) AS BIGINT) AS cumul_exits FROM d WHERE rn > 1 GROUP BY endtime""")
def counter_delta_by_time(spark, sf):
    d = counter_delta(spark, sf)
    return d.groupBy("endtime").agg(F.sum("cumul_entries").alias("cumul_entries"),
                                    F.sum("cumul_exits").alias("cumul_exits"))


@query("first_match_dedup", section=SEC, sql=f"""
WITH pts AS (SELECT trip_id AS pid, pickup_longitude AS lon, pickup_latitude AS lat FROM trips
  UNION ALL SELECT -CAST(e.LocationID AS BIGINT), e.x1, e.y1 FROM zone_edges e
  WHERE e.k = 0 AND e.LocationID IN (SELECT pickup_taxizone_id FROM trips)),
hit AS {pip_pairs_sql('pts', 'pid', 'lon', 'lat', 'intersects')}
SELECT pid, CAST(min(zid) AS INTEGER) AS LocationID, count(*) AS n_matches FROM hit GROUP BY pid""")
def first_match_dedup(spark, sf):
    """One zone per point after a multi-match join: the smallest id (a
    deterministic "keep first")."""
    from urbanlens.plans.q_joins import _pts_with_vertices

    pairs = SP.spatial_join(_pts_with_vertices(spark, sf), fx.zones(spark), "lon", "lat", how="inner",
                            mode="intersects")
    return pairs.groupBy("pid").agg(F.min("LocationID").alias("LocationID"), F.count(F.lit(1)).alias("n_matches"))


@query("row_id_monotonic", section=SEC, sql="""
SELECT pickup_datetime, count(*) AS n, true AS ids_apart, true AS ids_in_order FROM trips GROUP BY pickup_datetime""")
def row_id_monotonic(spark, sf):
    """Sort, then ``monotonically_increasing_id``: unique and ordered, not dense.

    Returned per pickup time: its rows, whether their ids differ, and whether
    they lie above every id of the times before (running maxima within a day and
    over the days, so no task holds the whole series).
    """
    t = fx.trips(spark, sf).select("pickup_datetime").orderBy("pickup_datetime").withColumn("id", F.monotonically_increasing_id())
    t = reliable_checkpoint(t)   # ids must not be drawn again by the second branch
    per = t.groupBy("pickup_datetime").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"),
                                           F.min("id").alias("lo"), F.max("id").alias("hi"))
    day = F.to_date("pickup_datetime")
    days = per.groupBy(day.alias("day")).agg(F.max("hi").alias("day_hi"))   # one row a day
    before = days.withColumn("floor", F.coalesce(F.max("day_hi").over(
        Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1)))
    inside = Window.partitionBy(day).orderBy("pickup_datetime").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("day", day).withColumn("last", F.coalesce(F.max("hi").over(inside), F.lit(-1)))
    return per.join(before.select("day", "floor"), "day").select(
        "pickup_datetime", "n", (F.col("n") == F.col("d")).alias("ids_apart"), (F.col("lo") > F.greatest("last", "floor")).alias("ids_in_order"))


@query("row_id_serial", section=SEC, sql="""
SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS row_id FROM events""")
def row_id_serial(spark, sf):
    """``BIGSERIAL``-style dense ids 1..N in (ts, event_id) order, computed
    from per-partition counts of a range-sorted, checkpointed frame."""
    from urbanlens.sources.tables import read_table

    e = read_table(spark, sf, "events", ["event_id", "ts"])
    return W.dense_ids(e, ["ts", "event_id"], "row_id", start=1)


@query("row_index_reset", section=SEC, sql="""
WITH c AS (SELECT DISTINCT start_station_id AS id, trim(start_station_name, '"') AS name FROM bike)
SELECT id, name, row_number() OVER (ORDER BY id, name) - 1 AS idx FROM c""")
def row_index_reset(spark, sf):
    """``sort_values(...).reset_index(drop=True)``: 0-based positions."""
    c = fx.citibike(spark, sf).select(F.col("start_station_id").alias("id"),
                                      F.col("start_station_name").alias("name")).distinct()
    return W.dense_ids(c, ["id", "name"], "idx", start=0)
