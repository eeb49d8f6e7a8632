"""Sharding by vector bin packing over bytes, tokens and rows.

Rows with equal texts form a group and stay together. Groups that hold more
than a ``1/ITEMS`` part of a shard in any measure are items of their own (so
there are at most ``3 * ITEMS`` of them a shard); the rest fall by a hash into
``ITEMS`` parcels a shard. This bounded list of items is packed on the driver,
largest first, each into the shard where the dot product of its demand with
the capacity left is highest; all rows are counted and dealt by Spark. A group
larger than half a shard would upset any balance and is split into parts.

Slots come from counts per bucket of a shard, so no task numbers a whole shard.

Defined cases: a null or empty text is a group like any other, of size 8 a
row; repeated rows share a shard and get slots of their own; null ids stay
null; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm import text as X

ITEMS = 512
BUCKET_ROWS = 4096
MEASURES = ("size", "tokens", "rows")
#: Weight of each measure's share in the dot product: bytes are the law.
WEIGHTS = (100.0, 1.0, 1.0)


def place(demand: np.ndarray, capacity: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item: largest demand first, highest dot product with the capacity left."""
    share = demand / np.maximum(capacity, 1e-9)
    left = np.ones((shards, share.shape[1]))
    weight = np.array(WEIGHTS)
    out = np.zeros(len(share), np.int64)
    for i in np.argsort(-(share * weight).sum(axis=1), kind="stable"):
        d = share[i]
        out[i] = b = int(np.argmax(left @ (d * weight)))
        left[b] -= d
    return out


def pack_shards(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document row: doc_id, size, text_crc32, shard, slot."""
    spark, text = docs.sparkSession, F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("rid"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("g"))
    slim = X.stored(slim, "shard-rows")
    groups = X.stored(slim.groupBy("g").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "shard-groups")
    total = groups.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES]).first()
    cap = np.array([max(1, total[m]) / shards for m in MEASURES])
    part = F.greatest(*[F.col(m) / F.lit(float(c)) for m, c in zip(MEASURES, cap, strict=True)])
    own = F.when(part > 0.5, F.ceil(part * 8)).when(part > 1.0 / ITEMS, 1).otherwise(0).cast("long")
    # Bounded: at most 3 * ITEMS groups a shard pass the bar.
    large = X.stored(groups.withColumn("parts", own).filter("parts > 0").select("g", "parts"), "large-groups")
    rows = slim.join(F.broadcast(large), "g", "left")
    rows = rows.withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("rid"), F.col("parts"))).when(F.col("parts") == 1, F.lit(0).cast("long")))
    rows = rows.withColumn("item", F.when(F.col("part").isNull(), F.pmod(F.xxhash64("g"), F.lit(shards * ITEMS)).cast("string"))
                           .otherwise(F.concat_ws("-", F.hex("g"), F.col("part").cast("string"))))
    items = rows.groupBy("item").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).orderBy("item").toPandas()
    dealt = place(items[list(MEASURES)].to_numpy(np.float64), cap, shards) if len(items) else []
    where = spark.createDataFrame([(k, int(s)) for k, s in zip(items["item"], dealt, strict=True)], "item string, shard int")
    buckets = max(1, -(-int(total["rows"]) // (shards * BUCKET_ROWS)))
    rows = rows.join(F.broadcast(where), "item").select("doc_id", "rid", "size", "text_crc32", "shard", F.pmod(F.xxhash64("rid"), F.lit(buckets)).alias("bucket"))
    rows = X.stored(rows, "dealt-rows")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    at = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("rid")) - 1
    return rows.join(starts, ["shard", "bucket"]).select("doc_id", "size", "text_crc32", "shard", (F.col("start") + at).cast("long").alias("slot"))
