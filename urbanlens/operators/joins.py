"""Joins: equi, composite, full outer USING, semi/anti.

Nothing here runs while a plan is built. A broadcast is hinted only by callers
that join a layer of known size (the zone layers, or a cell table whose bytes
were bounded by ``operators.spatial.zone_index``); every other join is left to
the planner, which broadcasts by its own size estimate or, with AQE, by the
size it measured, and splits skewed keys of a shuffle join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_left_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``merge(left_on=, right_on=, how='left')`` then drop the right key."""
    return left.join(right, left[left_key] == right[right_key], "left").drop(right[right_key])


def join_full_using(frames: list[DataFrame], key: str) -> DataFrame:
    """Chained ``FULL OUTER JOIN ... USING (key)``; the key is coalesced."""
    return reduce(lambda a, b: a.join(b, on=key, how="full"), frames)


def join_all_using(base: DataFrame, frames: list[DataFrame], key: str) -> DataFrame:
    """``FULL OUTER JOIN ... USING (key)`` of ``frames`` whose keys all occur in ``base``, once each.

    Left joins from the keys of ``base`` keep its layout, which a full outer join
    loses: over tables in the same buckets of ``key`` nothing is shuffled. Keys
    in none of the frames are dropped.
    """
    out, marks = base.select(key), []
    for i, f in enumerate(frames):
        marks.append(f"_in_{i}")
        out = out.join(f.withColumn(marks[-1], F.lit(True)), key, "left")
    return out.where(F.coalesce(*marks)).drop(*marks)


def semi_join(df: DataFrame, keys: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``df[df.k.isin(list)]`` as a left-semi join (no driver-side list)."""
    k = keys.select(right_key).distinct()
    return df.join(k, df[left_key] == k[right_key], "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, left_key: str, right_key: str) -> DataFrame:
    k = keys.select(right_key).distinct()
    return df.join(k, df[left_key] == k[right_key], "left_anti")
