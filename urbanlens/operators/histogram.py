"""Histograms as grouped counts (bins are computed per row, counted with a
partial/final aggregate; nothing is collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.operators.quantiles import quantiles


def _binned(df: DataFrame, x: str, lo, width, nbins) -> DataFrame:
    """Bin index for ``[lo + i*w, lo + (i+1)*w)``, last edge inclusive, values
    outside ``[lo, lo + nbins*w]`` dropped (numpy ``histogram`` rules)."""
    hi = lo + nbins * width
    v = F.col(x)
    b = F.when(v == hi, nbins - 1).otherwise(F.floor((v - lo) / width))
    return df.where((v >= lo) & (v <= hi)).select(b.alias("bin")).where((F.col("bin") >= 0) & (F.col("bin") < nbins))


def fixed_histogram(df: DataFrame, x: str, lo: float, width: float, nbins: int) -> DataFrame:
    """(bin, left_edge, n) for fixed edges ``lo + k*width``, k = 0..nbins."""
    b = _binned(df, x, F.lit(float(lo)), F.lit(float(width)), nbins)
    lo_c, w_c = F.lit(float(lo)), F.lit(float(width))
    return (b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("bin").cast("int").alias("bin"), F.round(lo_c + F.col("bin") * w_c, 9).alias("left_edge"),
                    "n", F.lit(float(width)).alias("_width")))


def density(hist: DataFrame) -> DataFrame:
    """Normalise counts so the bars integrate to 1: n / (total * width).
    The total is a scalar subquery, not a join."""
    total = hist.select(F.sum("n")).scalar()
    return hist.select("bin", "left_edge", "n",
                       F.round(F.col("n") / (total * F.col("_width")), 9).alias("density"))


def auto_histogram(df: DataFrame, x: str, max_bins: int | None = 50) -> DataFrame:
    """Histogram with the Freedman-Diaconis bin count, at most ``max_bins``
    (the plotting rule's default; ``None`` lifts it), or ``sqrt(n)`` bins when
    the IQR is 0, over equal-width bins of [min, max].

    The quartiles are exact and interpolated (``quantiles.py``), found in a few
    passes with a fixed buffer. A column without values has no bins.
    """
    v = F.col(x)
    low, high = quantiles(df, x, [0.25, 0.75])
    if low is None:
        return df.where(F.lit(False)).select(F.lit(0).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    iqr = high - low
    stats = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"))
    most = F.lit((1 << 62) if max_bins is None else max_bins).cast("bigint")
    if iqr > 0:
        nb = F.least(most, F.ceil((F.col("hi") - F.col("lo")) / (F.lit(2.0 * iqr) / F.pow(F.col("n"), F.lit(1.0 / 3)))))
    else:
        nb = F.least(most, F.floor(F.sqrt(F.col("n"))))
    p = stats.select(F.struct("lo", nb.alias("nb"), ((F.col("hi") - F.col("lo")) / nb).alias("w")).alias("p"))
    sp = p.select("p").scalar()   # one scalar subquery
    lo, w, nbc = sp["lo"], sp["w"], sp["nb"]
    b = F.when(w == 0, 0).when(v >= lo + nbc * w, nbc - 1).otherwise(F.floor((v - lo) / F.when(w != 0, w)))
    return df.where(v.isNotNull()).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
