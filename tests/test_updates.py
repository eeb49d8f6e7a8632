"""Updates in place and jobs in slices: what is written, what is left alone, what a rerun does."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from urbanlens.operators.updates import Slices, fill_in_place, id_modulos, id_ranges


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_only_touched_folders_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, i % 6 if i % 6 else None, None if i % 4 == 0 else i, None if i % 2 else f"v{i}") for i in range(120)]
    spark.createDataFrame(rows, "id long, part int, a long, b string").repartition(2).write.partitionBy("part").parquet(path)
    before = files(path)
    new = spark.createDataFrame([(4, 1000, "x"), (4, 900, "y"), (5, 7, "five"), (7, 1, "seven"), (999, 1, "z"), (None, 1, "n"), (6, 6, "six"), (3, None, None)],
                                "id long, a long, b string")
    # 4: a (part 4); 5, 7: b (parts 5, 1); 6: nothing is null; 3: nothing to fill with.
    assert fill_in_place(spark, path, new, "id", "part", ["a", "b"]) == [1, 4, 5]
    got = {r.id: (r.part, r.a, r.b) for r in spark.read.parquet(path).collect()}
    want = {i: (p, a, b) for i, p, a, b in rows}
    want[4] = (4, 900, "v4")
    want[5], want[7] = (5, 5, "five"), (1, 7, "seven")
    assert got == want
    after = files(path)
    touched = ("part=1/", "part=4/", "part=5/")
    assert {f: t for f, t in after.items() if not f.startswith(touched)} == {f: t for f, t in before.items() if not f.startswith(touched)}
    # A rerun finds nothing to do.
    assert fill_in_place(spark, path, new, "id", "part", ["a", "b"]) == [] and files(path) == after


def test_null_folder_and_no_updates(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, None, None), (2, 5, None)], "id long, part int, a long").write.partitionBy("part").parquet(path)
    none = spark.createDataFrame([], "id long, a long")
    assert fill_in_place(spark, path, none, "id", "part", ["a"]) == []
    one = spark.createDataFrame([(1, 11)], "id long, a long")
    assert fill_in_place(spark, path, one, "id", "part", ["a"]) == [None]
    assert sorted((r.id, r.part, r.a) for r in spark.read.parquet(path).collect()) == [(1, None, 11), (2, 5, None)]


def test_the_search_for_folders_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("part"), F.lit(None).cast("long").alias("a")).write.partitionBy("part").parquet(path)
    q = spark.read.parquet(path).where(F.col("a").isNull() & F.col("id").between(3, 4))
    pushed = q._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1].split("]")[0]
    assert {"IsNull(a)", "GreaterThanOrEqual(id,3)", "LessThanOrEqual(id,4)"} <= set(pushed.split(", "))


class Killed(Exception):
    pass


@pytest.mark.parametrize("kind", ["ranges", "modulos"])
def test_a_stopped_job_goes_on(spark, tmp_path, kind):
    slices = id_ranges("id", 30, 4) if kind == "ranges" else id_modulos("id", 5)
    source = spark.range(0, 120).select("id", (F.col("id") * 2).alias("x"))
    work = lambda t: t.withColumn("y", F.col("x") + 1)
    calls = []

    def failing(t):
        calls.append(1)
        if len(calls) == 3:
            raise Killed
        return work(t)

    job = Slices(spark, str(tmp_path / "job"))
    with pytest.raises(Killed):
        job.run(source, slices, failing)
    assert list(job.finished()) and len(job.finished()) == 2
    done = files(tmp_path / "job")
    # A slice that was written but not entered is written again.
    half = slices[2]
    source.limit(7).withColumn("y", F.lit(0).cast("long")).write.parquet(str(tmp_path / "job" / "rows" / f"slice={half[0]}"))
    again = Slices(spark, str(tmp_path / "job"))
    assert again.run(source, slices, work, most=1) == [half[0]]
    assert again.run(source, slices, work) == [n for n, _ in slices[3:]]
    assert again.run(source, slices, work) == []
    assert {f: t for f, t in files(tmp_path / "job").items() if f in done} == done
    assert sorted(tuple(r) for r in again.rows().select("id", "x", "y").collect()) == sorted(tuple(r) for r in work(source).collect())
    assert again.finished() == {n: source.where(c).count() for n, c in slices}


def test_slice_conditions_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "ids")
    spark.range(100).write.parquet(path)
    plan = spark.read.parquet(path).where(id_ranges("id", 10, 3)[1][1])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,0), LessThanOrEqual(id,10)" in plan
