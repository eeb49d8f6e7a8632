"""Saved tables: buckets, catalog statistics, files taken in once."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from urbanlens.operators import joins as J
from urbanlens.operators import layout as L
from urbanlens.sources import readers as RD
from urbanlens.streaming.ingest import ingest_new_files


@pytest.fixture
def conf(spark):
    old = {}

    def put(**values):
        for k, v in values.items():
            k = "spark.sql." + k.replace("__", ".")
            old.setdefault(k, spark.conf.get(k))
            spark.conf.set(k, v)

    yield put
    for k, v in old.items():
        spark.conf.set(k, v)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path, conf):
    frames = [spark.range(0, 900, 2).withColumn("a", F.col("id") * 10), spark.range(0, 900, 3).withColumn("b", F.lit(None).cast("int")),
              spark.range(300, 600).withColumn("c", F.col("id").cast("string")), spark.range(0).withColumn("d", F.lit(1))]

    def saved(df, name):
        name = f"{name}_{uuid.uuid4().hex[:6]}"
        L.save_bucketed_table(df, name, "id", 5, str(tmp_path / name))
        return spark.table(name)

    base = saved(spark.range(1000), "base")
    (folder,) = tmp_path.glob("base_*")
    joined = J.join_all_using(base, [saved(f, f"part{i}") for i, f in enumerate(frames)], "id")
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 4 and "SelectedBucketsCount: 5 out of 5" in plan
    want = J.join_full_using(frames, "id")
    key = lambda r: r.id
    assert sorted(joined.collect(), key=key) == sorted(want.collect(), key=key) and joined.columns == want.columns
    # One file a bucket.
    assert sum(f.endswith(".parquet") for f in os.listdir(folder)) == 5


def test_statistics_reach_the_catalog(spark, tmp_path):
    name = f"stats_{uuid.uuid4().hex[:6]}"
    rows = [(i, i % 50 if i % 10 else None, f"v{i % 7}" * (1 + i % 3), float(i % 200) / 4) for i in range(5000)]
    spark.createDataFrame(rows, "id long, k int, s string, x double").write.option("path", str(tmp_path / name)).saveAsTable(name)
    got = {r.column_name: r for r in L.catalog_statistics(spark, name).collect()}
    assert set(got) == {"id", "k", "s", "x"} and {r.n_rows for r in got.values()} == {5000}
    assert (got["k"].n_null, got["k"].min_value, got["k"].max_value) == (500, "1", "49") and got["s"].max_len == 6
    for c, n in (("id", 5000), ("k", 45), ("s", 21), ("x", 200)):
        assert abs(got[c].n_distinct - n) <= 0.15 * n
    assert got["id"].histogram_bins == 254 and got["id"].histogram_height == pytest.approx(5000 / 254) and got["s"].histogram_bins is None
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == "false"


def test_join_order_follows_the_statistics(spark, tmp_path, conf):
    """The table that keeps one row in a hundred is joined first once the planner knows, whatever the text says."""
    tag = uuid.uuid4().hex[:6]
    frames = {"big": spark.range(20_000).select((F.col("id") % 2000).alias("a"), (F.col("id") % 1000).alias("b"), "id"),
              "wide": spark.range(2000).select(F.col("id").alias("a"), F.lit("w").alias("w")),
              "few": spark.range(10).select(F.col("id").alias("b"), F.lit("f").alias("f"))}
    for name, df in frames.items():
        df.write.option("path", str(tmp_path / name)).saveAsTable(f"{name}_{tag}")
    query = f"SELECT id, w, f FROM big_{tag} JOIN wide_{tag} USING (a) JOIN few_{tag} USING (b)"

    def first_joined():
        plan = spark.sql(query)._jdf.queryExecution().optimizedPlan().toString()
        deepest = max((line for line in plan.splitlines() if "Join Inner" in line), key=lambda line: len(line) - len(line.lstrip(" :+-")))
        at = plan.splitlines().index(deepest)
        inside = "\n".join(plan.splitlines()[at:])
        return "few" if "f#" in inside.split("Relation")[2] or "f#" in inside.split("Relation")[1] else "wide"

    conf(autoBroadcastJoinThreshold="-1", cbo__enabled="true", cbo__joinReorder__enabled="true")
    before = first_joined()
    for name in frames:
        L.catalog_statistics(spark, f"{name}_{tag}")
        spark.catalog.refreshTable(f"{name}_{tag}")
    assert (before, first_joined()) == ("wide", "few")
    assert spark.sql(query).count() == 200


GOOD = "A1,R1,00-00-01,ST1,NQR,BMT,01/0{d}/2024,0{h}:00:00,REGULAR,{n},5"


def lines(n, day):
    return [GOOD.format(d=day, h=i % 10, n=i) for i in range(n)] + [f"A1,R1,bad{day}"]


def test_files_are_taken_in_once(spark, tmp_path):
    """Two runs with a file in between equal one run over all; nothing is read twice, and a rerun adds nothing."""
    def put(folder, name, rows):
        (tmp_path / folder / "day=0102").mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / "day=0102" / name).write_text("\n".join(rows) + "\n")

    def run(tag, folder):
        return ingest_new_files(spark, str(tmp_path / folder), str(tmp_path / f"out-{tag}"), str(tmp_path / f"progress-{tag}"), max_files=2)

    put("arriving", "a.txt", lines(5, 1))
    put("arriving", "b.txt", lines(3, 2))
    assert run("steps", "arriving") == 10
    put("arriving", "c.txt", lines(4, 3))
    put("arriving", "d.txt", ["", RD.TURNSTILE_HEADER])
    assert run("steps", "arriving") == 7   # 5 + 2 lines: none of the first files
    assert run("steps", "arriving") == 0
    assert run("once", "arriving") == 17
    read = lambda tag: sorted((tuple(r) for r in spark.read.parquet(str(tmp_path / f"out-{tag}")).collect()), key=str)
    assert read("steps") == read("once") and len(read("once")) == 15
    rejected = spark.read.parquet(str(tmp_path / "out-steps")).where("rejected = 1").select("line", "reason").collect()
    assert sorted(map(tuple, rejected)) == [(f"A1,R1,bad{d}", "unknown layout") for d in (1, 2, 3)]


def test_tagged_rows_equal_both_outputs(spark):
    rows = lines(3, 1) + ["A2,R2,00-00-02,01-02-24,00:00:00,REGULAR,1,2,01-02-24,04:00:00,REGULAR,3,4", "", "A2,R2,00-00-02,01-02-24,00:00:00,REGULAR,x,2", "   "]
    frame = spark.createDataFrame([(r,) for r in rows] + [(None,)], "value string")
    good, bad = RD.parse_turnstile(frame)
    tagged = RD.parse_turnstile_tagged(frame)
    key = str
    assert sorted(good.collect(), key=key) == sorted(tagged.where("line IS NULL").drop("line", "reason").collect(), key=key)
    assert sorted(bad.collect(), key=key) == sorted(tagged.where("line IS NOT NULL").select("line", "reason").collect(), key=key)
