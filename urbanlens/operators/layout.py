"""Physical layout: writers, partitioning and sorted tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def repartition_n(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def repartition_by_key(df: DataFrame, key: str, n: int, salt_buckets: int = 1) -> DataFrame:
    """Hash layout by ``key``. With ``salt_buckets > 1`` each key is spread over
    that many tasks (rows of one key still share a key folder when written
    with ``partitionBy``), so a key holding a third of the rows does not land
    in a single task."""
    if salt_buckets <= 1:
        return df.repartition(n, key)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salt_buckets))
    return df.repartition(n, F.col(key), salt)


def range_index(df: DataFrame, key: str, n: int, tiebreak: str | None = None) -> DataFrame:
    """Globally ordered by ``key``: range partitions, each sorted locally.
    A unique ``tiebreak`` lets the range partitioner split a heavily repeated
    key value across partitions."""
    keys = [key] + ([tiebreak] if tiebreak else [])
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


def save_sorted_table(df: DataFrame, name: str, keys: list[str], path: str, n: int | None = None) -> None:
    """Catalog table whose files are in key order (min/max skipping works)."""
    ranged = df.repartitionByRange(n, *keys) if n else df.repartitionByRange(*keys)   # AQE sizes it without n
    (ranged.sortWithinPartitions(*keys)
     .write.mode("overwrite").option("path", path).saveAsTable(name))


def save_bucketed_table(df: DataFrame, name: str, key: str, n: int, path: str) -> None:
    """Catalog table in ``n`` buckets of ``key``, one sorted file a bucket.

    Tables in the same number of buckets of the same key join on it without a
    shuffle. Rows of one key lie in one bucket: for keys with few rows each
    (trip ids), not for skewed ones. ``n`` is a property of the data: about its
    bytes / 256 MB, and at least the cores that will read it.
    """
    (df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name))


def catalog_statistics(spark: SparkSession, name: str) -> DataFrame:
    """``ANALYZE TABLE ... FOR ALL COLUMNS`` with histograms, and what the catalog then holds of every column.

    The planner uses these numbers once ``spark.sql.cbo.enabled`` is on: filters
    and joins are sized by them, and with ``spark.sql.cbo.joinReorder.enabled``
    joins are put in order. Returned per column, from the catalog alone:
    column_name, data_type, n_rows, n_null, n_distinct (a sketch, within
    ``spark.sql.statistics.ndv.maxError``), min_value, max_value, avg_len,
    max_len, histogram_bins, histogram_height (rows a bin).
    """
    setting = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    finally:
        spark.conf.set(setting, before)
    table = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Statistics"}
    n_rows = int(re.search(r"(\d+) rows", table["Statistics"]).group(1))
    rows = []
    for field in spark.table(name).schema:   # metadata, a few values a column
        info = {r["info_name"]: None if r["info_value"] == "NULL" else r["info_value"]
                for r in spark.sql(f"DESCRIBE EXTENDED {name} `{field.name}`").collect() if not r["info_name"].startswith("bin_")}
        histogram = re.match(r"height: ([\d.E]+), num_of_bins: (\d+)", info.get("histogram") or "")
        number = lambda k: None if info.get(k) is None else int(info[k])  # noqa: B023, E731
        rows.append((field.name, field.dataType.simpleString(), n_rows, number("num_nulls"), number("distinct_count"), info.get("min"), info.get("max"),
                     number("avg_col_len"), number("max_col_len"), int(histogram.group(2)) if histogram else None, float(histogram.group(1)) if histogram else None))
    return spark.createDataFrame(rows, "column_name string, data_type string, n_rows long, n_null long, n_distinct long, min_value string, max_value string, "
                                       "avg_len long, max_len long, histogram_bins int, histogram_height double")
