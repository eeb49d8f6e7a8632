"""Row ids and ordered differences that stay balanced under key skew.

A ``Window.partitionBy(key)`` puts every row of a key in one task; with a key
holding a third of the rows that task dominates the job. Here ids come from a
global range sort (range partitioning splits a hot key across tasks),
per-partition counts and a tiny prefix sum. "Previous row" needs no such sort:
windows run inside (key, time bucket) and a small table of bucket ends stitches
the buckets together.
Running sums cut the ids into fixed-size blocks: windows run inside a block
(bounded size), and a small per-(key, block) total table supplies each
block's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.functions import timeparts as T
from urbanlens.session import reliable_checkpoint


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str = "row_id", start: int = 1,
              num_partitions: int | None = None) -> DataFrame:
    """Dense 1..N ids in ``order_cols`` order (BIGSERIAL / ``reset_index``).

    Make ``order_cols`` unique (add a tie-break column) for reproducible ids.
    The range-sorted frame is checkpointed to the shared checkpoint dir so the
    partition layout that the offsets describe cannot change on recompute.
    """
    # Without a number AQE sizes the range partitions from the bytes it measured.
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    ordered = reliable_checkpoint(ranged.sortWithinPartitions(*order_cols))
    tagged = ordered.withColumn("_pid", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id())
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a bounded table, so a global window and a broadcast are safe.
    offsets = sizes.select("_pid", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(id_col, F.col("_off") + local + F.lit(start))
            .drop("_pid", "_mono", "_off"))


def time_bucket(ts_col: str, micros: int = 7 * T.MICROS_PER_DAY) -> Column:
    """The number of the time bucket a timestamp falls in."""
    return F.floor(T.epoch_micros(ts_col) / F.lit(micros)).cast("bigint")


def stitched_lag(df: DataFrame, keys: list[str], order_cols: list[str], value_cols: list[str], bucket: Column) -> DataFrame:
    """Attach ``prev_<v>`` (the previous row of the same key) to each row; rows without one are dropped.

    ``bucket`` must not fall as ``order_cols`` rise (a time bucket, say). Windows
    run inside (key, bucket), so a key of very many rows is many tasks' work.
    What they cannot see is the row before a bucket's first one: the last rows of
    all buckets are a small table, put in order per key, which the first rows are
    joined with. The rows themselves are shuffled once, by (key, bucket), and
    nothing is sorted globally or written. Rows with a null in a key are dropped;
    a null bucket comes first. Make ``order_cols`` unique for reproducible results.
    """
    rows = df.dropna(subset=keys).withColumn("_bucket", F.coalesce(bucket.cast("bigint"), F.lit(-(1 << 62))))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order_cols)
    # Plain columns only, so that both uses of ``ordered`` need the same shuffled rows and share them.
    lags = [F.lag(v).over(inside).alias(f"prev_{v}") for v in value_cols]
    one = F.lit(1)
    ordered = rows.select("*", *lags, F.lag(one).over(inside).alias("_has"), F.lead(one).over(inside).alias("_more"))
    # One row a key and bucket: what the next bucket of the key starts from.
    along = Window.partitionBy(*keys).orderBy("_bucket")
    starts = (ordered.where(F.col("_more").isNull()).select(
        *keys, F.lead("_bucket").over(along).alias("_bucket"), *[F.col(v).alias(f"_end_{v}") for v in value_cols], one.alias("_start"))
        .where(F.col("_bucket").isNotNull()))
    # Both sides lie by (key, bucket) already; a bucket's other rows have their previous row.
    joined = ordered.join(starts, [*keys, "_bucket"], "left").where(F.col("_has").isNotNull() | F.col("_start").isNotNull())
    prev = [F.when(F.col("_has").isNotNull(), F.col(f"prev_{v}")).otherwise(F.col(f"_end_{v}")).alias(f"prev_{v}") for v in value_cols]
    return joined.select(*df.columns, *prev)


def counter_delta(df: DataFrame, keys: list[str], order_cols: list[str], counters: list[str], bucket: Column | None = None) -> DataFrame:
    """First differences of cumulative counters per device, ordered by time.

    Raw differences: no reset or gap handling, negative deltas stay. Only the
    named columns are moved and returned. ``bucket`` defaults to weeks of the
    first order column (see ``stitched_lag``).
    """
    slim = df.select(*dict.fromkeys([*keys, *order_cols, *counters]))
    j = stitched_lag(slim, keys, order_cols, counters, time_bucket(order_cols[0]) if bucket is None else bucket)
    return j.select(*[F.col(c) - F.col(f"prev_{c}") if c in counters else F.col(c) for c in slim.columns]).toDF(*slim.columns)


def running_sums(df: DataFrame, keys: list[str], order_cols: list[str], values: dict[str, object],
                 block_rows: int = 100_000, id_col: str = "_rid") -> DataFrame:
    """Running (cumulative) sums per key in order, without putting a key in one task.

    ``values`` maps output name -> column (or expression) to accumulate.
    Rows get dense ids in (keys, order) order; ids are cut into fixed-size
    blocks; one small table of per-(key, block) totals gives each block its
    starting offset (a window over blocks, not rows: one row per ``block_rows``
    rows of a key); inside a block a window
    runs over at most ``block_rows`` rows. A hot key is thus split into many
    equal blocks, and every shuffle is keyed by (key, block).
    """
    base = df
    for name, expr in values.items():
        base = base.withColumn(f"_v_{name}", expr if not isinstance(expr, str) else F.col(expr))
    ided = dense_ids(base, keys + order_cols, id_col)
    blk = F.floor(F.col(id_col) / F.lit(block_rows))
    ided = ided.withColumn("_blk", blk)
    totals = ided.groupBy(*keys, "_blk").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    wk = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_blk", *[F.coalesce(F.sum(f"_t_{n}").over(wk), F.lit(0)).alias(f"_o_{n}")
                                            for n in values])
    wr = Window.partitionBy(*keys, "_blk").orderBy(id_col).rowsBetween(Window.unboundedPreceding, 0)
    inner = ided.select("*", *[F.sum(f"_v_{n}").over(wr).alias(f"_r_{n}") for n in values])
    out = inner.join(offsets, [*keys, "_blk"], "inner")
    for n in values:
        out = out.withColumn(n, F.col(f"_o_{n}") + F.col(f"_r_{n}"))
    drop = [id_col, "_blk"] + [f"_{p}_{n}" for n in values for p in ("v", "o", "r")]
    return out.drop(*drop)
