"""Aggregations with pandas semantics made explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_nonnull_by(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """pandas ``groupby(keys).count()``: rows with a null key are dropped and
    every other column gets its own non-null count."""
    cols = columns or [c for c in df.columns if c not in keys]
    keep = F.lit(True)
    for k in keys:
        keep = keep & F.col(k).isNotNull()
    nonnull = df.where(keep)
    return nonnull.groupBy(*keys).agg(*[F.count(c).alias(c) for c in cols])


def count_per_column(df: DataFrame) -> DataFrame:
    """``df.count()``: non-null cells per column, one row per column."""
    wide = df.agg(*[F.count(c).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return wide.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, n_nonnull)")


def od_counts(trips: DataFrame, origin: str, dest: str, fill_id: int = 266,
              exclude_type: str | None = "uber", type_col: str = "trip_type",
              count_col: str = "pickup_datetime", out: str = "n_trips") -> DataFrame:
    """Origin-destination trip counts: missing zones become ``fill_id``, one
    trip type excluded (null types kept, as pandas ``!=`` keeps them)."""
    t = trips.select(origin, dest, type_col, count_col).fillna({origin: fill_id, dest: fill_id})
    if exclude_type is not None:
        t = t.where(~F.col(type_col).eqNullSafe(exclude_type))
    return t.groupBy(origin, dest).agg(F.count(count_col).alias(out))


def dense_square(counts: DataFrame, i_col: str, j_col: str, n_col: str, size: int,
                 out_col: str = "log_n") -> DataFrame:
    """Dense ``size x size`` matrix as a long table with ``log10(n + 1)``.

    Cells come from ``range(size*size)`` (i = id div size, j = id mod size),
    not a cross join; the counts are joined on (i, j). Counts of ids outside
    ``0..size-1`` keep their own cells, so the total never changes.
    """
    spark = counts.sparkSession
    cells = spark.range(size * size).select(
        F.floor(F.col("id") / size).cast("int").alias(i_col), (F.col("id") % size).cast("int").alias(j_col))
    c = counts.select(F.col(i_col).cast("int").alias(i_col), F.col(j_col).cast("int").alias(j_col), n_col)
    m = cells.join(c, [i_col, j_col], "full")
    n = F.coalesce(F.col(n_col), F.lit(0)).cast("bigint")
    # Rounded to 9 places: log implementations may differ in the last bit.
    return m.select(i_col, j_col, n.alias(n_col), F.round(F.log10(n + F.lit(1.0)), 9).alias(out_col))
