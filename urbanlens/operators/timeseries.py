"""Regular time grids: dense series per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.functions import timeparts as T

DAY_US = 86_400_000_000


def dense_series(df: DataFrame, key: str, ts_col: str, step_us: int, block_us: int = DAY_US) -> DataFrame:
    """Counts of every bin between a key's first and last one (missing = 0), an array per block.

    Returns (key, block, first_bin, n, counts): ``block`` is the block's start (a
    day by default), ``first_bin`` the time of the first count, ``n`` the sum of
    the counts. A null key is a key of its own; rows without a time are left out.

    Rows are counted per bin, the counts of a block become one row, and a row
    gives its own block and the empty ones up to the key's next block. So no
    calendar is made or joined, and what is moved after the first aggregate is
    at most the number of bins, however many rows fall into each.
    """
    per_block = block_us // step_us
    if block_us % step_us:
        raise ValueError("a block must hold whole bins")
    us = F.col("_us")
    # The time arithmetic in a projection of its own, as both parts of it are read.
    times = df.where(F.col(ts_col).isNotNull()).select(F.col(key), T.epoch_micros(ts_col).alias("_us"))
    cells = (times.select(key, F.floor(us / F.lit(block_us)).cast("bigint").alias("_b"),
                          F.floor(F.pmod(us, F.lit(block_us)) / F.lit(step_us)).cast("int").alias("_s"))
             .groupBy(key, "_b", "_s").agg(F.count(F.lit(1)).alias("_n")))
    # One exchange by key serves the blocks and their order: a key has at most one row a bin here.
    # A fixed number, as these few bytes grow afterwards and would else be drawn together in one task.
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cells.repartition(width, key).groupBy(key, "_b").agg(
        F.array_sort(F.collect_list(F.struct("_s", "_n"))).alias("_c"), F.sum("_n").alias("_sum"))
    w = Window.partitionBy(key).orderBy("_b")
    rows = rows.select(key, "_b", "_c", "_sum", F.lag("_b").over(w).isNull().alias("_first"), F.lead("_b").over(w).alias("_next"))
    c, size = F.col("_c"), F.size("_c")
    lo = F.when(F.col("_first"), c[0]["_s"]).otherwise(0)
    end = F.when(F.col("_next").isNull(), F.element_at(c, -1)["_s"] + 1).otherwise(per_block)
    zeros = lambda n: F.array_repeat(F.lit(0).cast("bigint"), n.cast("int"))
    before = lambda i: F.when(i == 0, lo).otherwise(F.get(c, i - 1)["_s"] + 1)
    filled = F.concat(F.flatten(F.transform(c, lambda x, i: F.concat(zeros(x["_s"] - before(i)), F.array(x["_n"])))),
                      zeros(end - F.element_at(c, -1)["_s"] - 1))
    more = F.sequence("_b", F.coalesce(F.col("_next") - 1, F.col("_b")))
    rows = rows.select(key, "_b", "_sum", lo.alias("_lo"), filled.alias("_filled"), F.explode(more).alias("_at"))
    own = F.col("_at") == F.col("_b")
    start = F.col("_at") * F.lit(block_us)
    return rows.select(
        key, T.from_epoch_micros(start).alias("block"),
        T.from_epoch_micros(start + F.when(own, F.col("_lo")).otherwise(0).cast("bigint") * F.lit(step_us)).alias("first_bin"),
        F.when(own, F.col("_sum")).otherwise(0).alias("n"),
        F.when(own, F.col("_filled")).otherwise(zeros(F.lit(per_block))).alias("counts"))


def series_rows(series: DataFrame, key: str, step_us: int, ts_col: str = "bin", out: str = "n") -> DataFrame:
    """``dense_series`` as one row per bin: (key, ts_col, out)."""
    long = series.select(key, "first_bin", F.posexplode("counts").alias("_i", out))
    return long.select(key, T.from_epoch_micros(T.epoch_micros("first_bin") + F.col("_i").cast("bigint") * F.lit(step_us)).alias(ts_col), out)
