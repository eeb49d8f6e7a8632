"""Turnstile text taken in as it arrives: every file once, across restarts.

A file-source stream with ``availableNow`` works through the files it has not
seen and stops. Its checkpoint knows the files, and the sink's log makes the
rows of a batch count once even if a run is cut off between writing and
noting, so the job can be run again at any time. Readings and rejected lines
come from one pass over the lines and are told apart by their folder.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from urbanlens.sources.readers import parse_turnstile_tagged


def ingest_new_files(spark: SparkSession, source: str, out: str, checkpoint: str, max_files: int = 1000) -> int:
    """Takes in the files under ``source`` that no earlier run with this
    ``checkpoint`` has taken, at most ``max_files`` in a batch; returns the number of lines read.

    ``out`` is a Parquet table of readings with ``line`` and ``reason`` (null but
    for rejected lines), in folders by ``rejected``. Read it with Spark, which
    honours the sink's log.
    """
    # An empty folder is no error: there is nothing to do yet.
    lines = (spark.readStream.format("text").option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).load(source))
    rows = parse_turnstile_tagged(lines).withColumn("rejected", F.col("line").isNotNull().cast("int"))
    query = (rows.writeStream.format("parquet").partitionBy("rejected").outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)
