"""Gridded fields stored long: (time, lat, lon, var, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.operators.windows import dense_ids


def time_slice(g: DataFrame, var: str, step: int) -> DataFrame:
    return (g.where((F.col("var") == var) & (F.col("time") == step))
            .groupBy("lat", "lon").agg(F.round(F.avg("value"), 9).alias("value")))


def bbox(g: DataFrame, lon_lo: float, lon_hi: float, lat_lo: float, lat_hi: float) -> DataFrame:
    """Open lon/lat window (the filter reaches the scan), mean per node."""
    w = g.where((F.col("lon") > lon_lo) & (F.col("lon") < lon_hi) & (F.col("lat") > lat_lo) & (F.col("lat") < lat_hi))
    return w.groupBy("var", "time", "lat", "lon").agg(F.round(F.avg("value"), 9).alias("value"))


def levels(g: DataFrame, lo: float, step: float, nbands: int, value: str = "value") -> DataFrame:
    """Count of values per band ``floor((v - lo) / step)``, clipped to [-1, nbands]."""
    band = F.least(F.greatest(F.floor((F.col(value) - F.lit(lo)) / F.lit(step)), F.lit(-1)), F.lit(nbands))
    return g.groupBy("var", band.cast("int").alias("level")).agg(F.count(F.lit(1)).alias("n"))


def axes_product(g: DataFrame, x: str, y: str) -> DataFrame:
    """Every (x, y) node of the distinct axes, built without a cross join:
    each axis gets dense positions, ``range(nx * ny)`` enumerates the nodes
    and two equi-joins attach the coordinates."""
    xs = dense_ids(g.select(x).distinct(), [x], "_i", start=0)
    ys = dense_ids(g.select(y).distinct(), [y], "_j", start=0)
    ny = ys.count()
    nx = xs.count()
    spark = g.sparkSession
    nodes = spark.range(nx * ny).select((F.col("id") / F.lit(ny)).cast("bigint").alias("_i"),
                                        (F.col("id") % F.lit(ny)).alias("_j"))
    return nodes.join(xs, "_i").join(ys, "_j").select(x, y)
