"""Column harmonisation: typed nulls, defaults, casts, fills, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

# Per-type defaults for absent columns. Missing doubles are null (the
# reference's NaN), integers -999, strings "".
_DEFAULTS = {"double": None, "float": None, "bigint": -999, "int": -999, "string": ""}


def add_typed_nulls(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add each missing column as a null of the given type."""
    missing = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def add_defaults(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add each missing column with its type's default value."""
    missing = {c: F.lit(_DEFAULTS.get(t)).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def cast_by_schema(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``try_cast`` each listed column (dirty text never throws under ANSI).

    Text that may carry a decimal point is routed through double first,
    since ``try_cast('1.0' AS INT)`` is null.
    """
    out = []
    for f in df.schema.fields:
        t = types.get(f.name)
        if t is None:
            out.append(F.col(f.name))
        elif isinstance(f.dataType, Ty.StringType) and t in ("int", "bigint", "smallint", "tinyint"):
            c = F.trim(F.col(f.name))
            out.append(F.coalesce(c.try_cast(t), c.try_cast("double").try_cast(t)).alias(f.name))
        else:
            out.append(F.col(f.name).try_cast(t).alias(f.name))
    return df.select(*out)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column."""
    return df.select(*[F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
                       if isinstance(f.dataType, (Ty.DoubleType, Ty.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def canonical_order(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """``dropna(axis=1, how='all')``: one aggregate row of non-null counts
    (one number per column reaches the driver), then keep non-empty columns."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Column statistics: rows, nulls, distinct, min, max per column, one row
    per column (min/max as text).

    Exact: each column is counted by value on its own (values are combined
    before the shuffle, rows are never multiplied by the columns), then
    summarised. ``approx`` takes one pass with sketches of the distinct counts.
    """
    if approx:
        aggs = []
        for i, c in enumerate(df.columns):
            v = F.col(f"`{c}`")
            aggs.append(F.struct(F.lit(c).alias("column_name"), F.count("*").alias("n_rows"), (F.count("*") - F.count(v)).alias("n_null"),
                                 F.approx_count_distinct(v).alias("n_distinct"), F.min(v).cast("string").alias("min_value"),
                                 F.max(v).cast("string").alias("max_value")).alias(f"s{i}"))
        wide = df.agg(*aggs)
        return wide.select(F.inline(F.array(*wide.columns)))
    parts = []
    for c in df.columns:
        counts = df.select(F.col(f"`{c}`").alias("v")).groupBy("v").agg(F.count("*").alias("n"))
        parts.append(counts.agg(
            F.lit(c).alias("column_name"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("n_null"), F.count("v").alias("n_distinct"),
            F.min("v").cast("string").alias("min_value"), F.max("v").cast("string").alias("max_value")))
    return reduce(DataFrame.unionAll, parts)
