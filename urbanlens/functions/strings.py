"""String helpers as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_quotes(col) -> Column:
    """Python ``str.strip('"')``: remove every leading and trailing double quote."""
    return F.btrim(_c(col), F.lit('"'))


def strip_ws(col) -> Column:
    """Python ``str.strip()``: whitespace incl. tabs and newlines (``trim`` only drops spaces)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def strip_quotes_all(df: DataFrame) -> DataFrame:
    """Strip quotes from every string column."""
    return df.select(*[strip_quotes(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
                       for f in df.schema.fields])


def split_fields(col, sep: str = ",") -> Column:
    return F.split(_c(col), sep, -1)


def chunks(arr, start: int, size: int) -> Column:
    """Fixed-size chunks of an array after ``start`` leading elements
    (``grouper(l[start:], size)``); a short tail is dropped by the caller's checks."""
    a = _c(arr)
    n = F.floor((F.size(a) - F.lit(start)) / F.lit(size)).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(a, i * size + start + 1, size))
                  ).otherwise(F.array().cast("array<array<string>>"))
