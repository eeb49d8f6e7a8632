"""Statistics over tables: standardisation and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standardize(df: DataFrame, columns: list[str], suffix: str = "") -> DataFrame:
    """``(x - mean) / population sd`` per column (patsy ``standardize``).

    Means and deviations come from one aggregate used as scalar subqueries,
    so the data is not joined to itself. Nulls stay null.
    """
    stats = df.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in columns],
                            *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).alias("st"))
    st = stats.select("st").scalar()   # one scalar subquery for all columns
    out = df
    for c in columns:
        out = out.withColumn(c + suffix, (F.col(c) - st[f"m_{c}"]) / st[f"s_{c}"])
    return out


def sample_by_key(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Rows whose hashed key falls into the first ``fraction`` of the hash range.

    Unlike ``DataFrame.sample`` the choice depends on the key alone, not on
    partitions or retries, and equal keys stay together.
    """
    top = format(min(int(fraction * 16**8), 16**8 - 1), "08x")
    text = F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))
    return df if fraction >= 1 else df.where(F.substring(F.md5(text), 1, 8) < top)
