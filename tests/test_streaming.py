"""The streaming six-minute job gives the batch answer once the watermark
has passed every window."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanlens.session import scratch_path
from urbanlens.sources import fixtures as fx
from urbanlens.streaming.sixmin import start_sixmin_job


def test_sixmin_stream_matches_batch(spark, sf):
    import __spark_entry__ as entry

    trips = fx.trips(spark, sf).select("trip_id", "pickup_datetime", "pickup_taxizone_id")
    src = scratch_path(spark, "stream-src")
    # Two arrivals: everything before the last day, then the rest plus one far
    # later trip that moves the watermark past every earlier window.
    cut = trips.agg(F.max("pickup_datetime")).first()[0].replace(hour=0, minute=0, second=0)
    trips.where(F.col("pickup_datetime") < F.lit(cut)).write.parquet(f"{src}/a")
    trips.where(F.col("pickup_datetime") >= F.lit(cut)).write.parquet(f"{src}/b")
    late = spark.createDataFrame([(-1, "2030-01-01 00:00:00", None)], "trip_id bigint, t string, z int").select(
        "trip_id", F.col("t").cast("timestamp_ntz").alias("pickup_datetime"), F.col("z").alias("pickup_taxizone_id"))
    late.write.parquet(f"{src}/c")

    sink = scratch_path(spark, "stream-sink")
    q = start_sixmin_job(spark, f"{src}/*", trips.schema, sink)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    want = entry.queries()["sixmin_counts"](spark, sf)
    from collections import Counter

    def rows(df):
        return Counter((r.pickup_taxizone_id, r.pickup_dt_group, r["count"]) for r in df.collect())

    assert rows(got) == rows(want)
