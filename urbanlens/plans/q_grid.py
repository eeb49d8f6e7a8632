"""Sections 2.11 and 2.12: gridded fields and the per-partition function hook."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanlens.operators import grid as GR
from urbanlens.operators.partitions import map_partitions
from urbanlens.plans.registry import query
from urbanlens.sources import fixtures as fx

SEC = "2.11"


@query("grid_time_slice", section=SEC, sql="""
SELECT lat, lon, round(avg(value), 9) AS value FROM grid WHERE var = 'T2M' AND time = 6 GROUP BY lat, lon""")
def grid_time_slice(spark, sf, var: str = "T2M", step: int = 6):
    """The field of one variable at the i-th time step (mean per cell)."""
    return GR.time_slice(fx.grid(spark, sf), var, step)


@query("grid_bbox", section=SEC, sql="""
SELECT var, time, lat, lon, round(avg(value), 9) AS value FROM grid
WHERE lon > -74.1 AND lon < -73.8 AND lat > 40.6 AND lat < 40.85 GROUP BY var, time, lat, lon""")
def grid_bbox(spark, sf):
    """Fields cut to a lon/lat window."""
    return GR.bbox(fx.grid(spark, sf), -74.1, -73.8, 40.6, 40.85)


@query("grid_levels", section=SEC, sql="""
WITH v AS (SELECT var, value, CASE var WHEN 'T2M' THEN 270.0::DOUBLE ELSE 8.0::DOUBLE END AS lo,
             CASE var WHEN 'T2M' THEN 14 ELSE 7 END AS nb FROM grid WHERE var IN ('T2M', 'SPEED'))
SELECT var, CAST(least(greatest(floor((value - lo) / 2.0::DOUBLE), -1), nb) AS INTEGER) AS level, count(*) AS n
FROM v GROUP BY 1, 2""")
def grid_levels(spark, sf):
    """Contour bands: T2M on 270..298 step 2, SPEED on 8..22 step 2; values
    below the first edge go to band -1, above the last to band ``nbands``."""
    g = fx.grid(spark, sf)
    t = GR.levels(g.where(F.col("var") == "T2M"), 270.0, 2.0, 14)
    s = GR.levels(g.where(F.col("var") == "SPEED"), 8.0, 2.0, 7)
    return t.unionByName(s)


@query("grid_axes", section=SEC, sql="""
SELECT lo.lon, la.lat FROM (SELECT DISTINCT lon FROM grid) lo, (SELECT DISTINCT lat FROM grid) la""")
def grid_axes(spark, sf):
    """Distinct longitude and latitude axes and every (lon, lat) node."""
    return GR.axes_product(fx.grid(spark, sf), "lon", "lat")


SEC = "2.12"


@query("map_partitions", section=SEC, sql="""
SELECT trip_id, strftime(pickup_datetime, '%Y-%m-%dT%H:%M') AS pickup_minute FROM trips""")
def map_partitions_query(spark, sf):
    """A user function run once per partition over its batches, with a declared
    output schema (here numpy's minute label of the pickup time)."""
    def minute_label(batches):
        for pdf in batches:
            ts = pdf["pickup_datetime"].values.astype("datetime64[m]").astype(str)
            yield pdf.assign(pickup_minute=ts)[["trip_id", "pickup_minute"]]

    t = fx.trips(spark, sf).select("trip_id", "pickup_datetime")
    return map_partitions(t, minute_label, "trip_id bigint, pickup_minute string")
