"""Exact order statistics against sorting."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanlens.operators import histogram as H
from urbanlens.operators import quantiles as Q


def frame(spark, values, parts=6):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double").repartition(parts)


def test_a_million_distinct_values(spark):
    """Far more values than the buffers hold; the answers are exact."""
    df = spark.range(1_000_000, numPartitions=8).select((F.pow(F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / 1e6, 5) * 1e9).alias("x"))
    values = np.sort(df.toPandas()["x"].to_numpy())
    assert len(np.unique(values)) > 990_000
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    assert Q.quantiles(df, "x", probabilities, accuracy=500, few=100) == pytest.approx(np.quantile(values, probabilities).tolist(), rel=1e-12)
    ranks = [0, 1, 123_456, 999_999]
    assert Q.order_statistics(df, "x", ranks, accuracy=500, few=100) == {r: values[r] for r in ranks}


@pytest.mark.parametrize("case", ["ties", "two", "outliers", "steps"])
def test_ranks_with_ties_and_outliers(spark, case):
    """Values shared by many rows, and ranges that equal widths would not split; tiny buffers force many passes."""
    r = np.random.default_rng(3)
    values = {"ties": r.integers(0, 7, 3000), "two": [1.0] * 1500 + [2.0] * 1500, "outliers": np.concatenate([r.normal(size=2990), [1e300, -1e300] * 5]),
              "steps": np.repeat(np.arange(30), 100)}[case]
    want = np.sort(np.asarray(values, float))
    ranks = [0, 1, 749, 1499, 1500, 2250, 2998, 2999]
    assert Q.order_statistics(frame(spark, values), "x", ranks, accuracy=20, few=3) == {k: want[k] for k in ranks}


def test_few_or_no_values(spark):
    assert Q.quantiles(frame(spark, [None, None]), "x", [0.5]) == [None]
    assert Q.quantiles(frame(spark, [3.0, None]), "x", [0.0, 0.5, 1.0]) == [3.0, 3.0, 3.0]
    assert Q.quantiles(frame(spark, [1.0, 2.0, float("nan")]), "x", [0.25]) == [1.25]


def test_auto_histogram_on_continuous_data(spark):
    """Freedman-Diaconis bins as numpy makes them, and the cases without a spread."""
    values = np.random.default_rng(8).gamma(2.0, size=4000)
    got = {r.bin: r.n for r in H.auto_histogram(frame(spark, values), "x", None).collect()}
    n, _ = np.histogram(values, bins="fd")
    assert [got.get(i, 0) for i in range(len(n))] == n.tolist()
    assert H.auto_histogram(frame(spark, [None]), "x").count() == 0
    assert [tuple(r) for r in H.auto_histogram(frame(spark, [2.0] * 9), "x").collect()] == [(0, 9)]
