"""k-means whose labels do not depend on partitions, order or retries.

Coordinates are whole numbers of ``UNIT`` degrees, so that sums of any number
of points are exact in any order; centres are rounded means of them. The start
is the ``k`` points whose hashed ids come first, distances compare as whole
numbers, and the lowest label wins a tie. A round is one aggregate keyed by
cluster: ``k`` rows reach the driver however many points there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts a degree: about 11 cm.
UNIT = 1_000_000


def whole_degrees(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Longitude and latitude as non-negative whole numbers, from -180 and -90 on."""
    return (F.floor((lon + 180.0) * F.lit(float(UNIT)) + 0.5).cast("bigint"),
            F.floor((lat + 90.0) * F.lit(float(UNIT)) + 0.5).cast("bigint"))


def nearest(x: Column, y: Column, centers: list[tuple[int, int]]) -> Column:
    """The label of the nearest centre, the lowest on a tie; null for a point without coordinates."""
    far = [F.struct(((x - a) * (x - a) + (y - b) * (y - b)).alias("d"), F.lit(i).alias("label")) for i, (a, b) in enumerate(centers)]
    return F.when(x.isNotNull() & y.isNotNull(), F.array_min(F.array(*far))["label"])


def fit(points: DataFrame, key: str, k: int, seed: int, rounds: int) -> list[tuple[int, int]]:
    """Centres of ``points`` (key, x, y as whole numbers) after at most ``rounds`` rounds.

    Fewer points than ``k`` give fewer centres; a cluster that loses all its
    points keeps its centre. Stops early when no centre moves.
    """
    points = points.dropna(subset=["x", "y"])
    start = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    centers = [(r["x"], r["y"]) for r in points.orderBy(start, key).limit(k).select("x", "y").collect()]
    for _ in range(rounds if centers else 0):
        big = "decimal(38,0)"
        n = F.count(F.lit(1))
        # Half up, in whole numbers: (2 * sum + n) div (2 * n).
        mean = lambda c: F.expr(f"(2 * sum(cast({c} as {big})) + count(1)) div (2 * count(1))").alias(c)
        moved = points.groupBy(nearest(F.col("x"), F.col("y"), centers).alias("label")).agg(mean("x"), mean("y"), n.alias("n")).collect()
        after = list(centers)
        for r in moved:
            after[r["label"]] = (int(r["x"]), int(r["y"]))
        if after == centers:
            break
        centers = after
    return centers
