"""Updates of written tables, and long jobs in slices that can go on where they stopped."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.session import scratch_path


def fill_in_place(spark: SparkSession, path: str, updates: DataFrame, key: str, partition: str, columns: Sequence[str]) -> list:
    """``UPDATE t SET c = COALESCE(t.c, u.c) FROM u WHERE t.key = u.key`` on a partitioned Parquet table.

    Only the folders (values of ``partition``) in which a row would change are
    read whole and written again; the others keep their files. The search for
    them reads rows with a null in ``columns`` and a key within the bounds of
    the updates, both of which reach the scan. Returns the folders' values, at
    most one per folder.

    The rows to write are staged in the shared folder first and then replace
    their folders. A run that is cut short is mended by running it again: rows
    already filled do not change, so a second run finds fewer folders or none.
    Several updates of a key count as one with the least values; null keys match
    nothing. The order of columns stays.
    """
    columns = list(columns)
    table = spark.read.parquet(path)
    new = updates.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.min(c).alias(f"_new_{c}") for c in columns])
    bounds = updates.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if bounds["lo"] is None:
        return []
    open_cells = _any(F.col(c).isNull() for c in columns)
    changes = _any(F.col(c).isNull() & F.col(f"_new_{c}").isNotNull() for c in columns)
    pending = table.where(open_cells & F.col(key).between(F.lit(bounds["lo"]), F.lit(bounds["hi"]))).select(partition, key, *columns)
    touched = [r[0] for r in pending.join(new, key).where(changes).select(partition).distinct().collect()]
    if not touched:
        return []
    in_folder = F.col(partition).isin([v for v in touched if v is not None])
    if None in touched:
        in_folder = in_folder | F.col(partition).isNull()
    filled = {c: F.coalesce(c, f"_new_{c}") for c in columns}
    rows = table.where(in_folder).join(new, key, "left").withColumns(filled).select(*table.columns)
    staged = scratch_path(spark, f"staged-{uuid.uuid4().hex[:6]}")
    rows.write.parquet(staged)
    (spark.read.schema(rows.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))
    return sorted(touched, key=lambda v: (v is None, v))


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


class Slices:
    """A job cut into numbered slices, each written once.

    Slice i's rows are written to ``path/rows/slice=i`` and then entered in the
    ledger (``path/ledger/slice=i``, one row: rows written). A slice without an
    entry is written anew, over whatever an interrupted run left of it, so a
    job that was stopped goes on with the first unfinished slice and its result
    is that of a run in one go. Slices are numbered jobs of a whole cluster, as
    many as the caller asks for; rows never pass through the driver.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def finished(self) -> dict[int, int]:
        """Slice number -> rows written."""
        ledger = f"{self.path}/ledger"
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return {}
        return {r["slice"]: r["n_rows"] for r in self.spark.read.schema("n_rows long, slice int").parquet(ledger).collect()}

    def run(self, source: DataFrame, slices: Sequence[tuple[int, Column]], work: Callable[[DataFrame], DataFrame], most: int | None = None) -> list[int]:
        """Runs ``work`` on the rows of each unfinished slice (number, condition), at most ``most`` of them; returns their numbers."""
        done, ran = self.finished(), []
        for number, condition in slices:
            if number in done:
                continue
            if most is not None and len(ran) >= most:
                break
            out = f"{self.path}/rows/slice={number}"
            work(source.where(condition)).write.mode("overwrite").parquet(out)
            count = self.spark.read.parquet(out).select(F.count(F.lit(1)).alias("n_rows"))
            count.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/slice={number}")
            ran.append(number)
        return ran

    def rows(self) -> DataFrame:
        """All rows of finished slices, with their ``slice``."""
        done = sorted(self.finished())
        return self.spark.read.parquet(f"{self.path}/rows").where(F.col("slice").isin(done))


def id_ranges(key: str, size: int, jobs: int) -> list[tuple[int, Column]]:
    """Slice i covers ``i * size < key <= (i + 1) * size``; 0 and below fall into slice -1. The conditions reach the scan."""
    k = F.col(key)
    return [(-1, k <= 0)] + [(i, (k > i * size) & (k <= (i + 1) * size)) for i in range(jobs)]


def id_modulos(key: str, base: int) -> list[tuple[int, Column]]:
    """Slice i covers the keys with remainder i."""
    return [(i, F.pmod(F.col(key), F.lit(base)) == i) for i in range(base)]
