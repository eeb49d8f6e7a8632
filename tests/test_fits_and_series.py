"""Least squares, k-means and dense series against plain versions."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanlens.operators import clusters as CL
from urbanlens.operators import regression as RG
from urbanlens.operators import timeseries as TS


def t_tail(t, dof, steps=200_000):
    """Two-sided tail of Student's t by Simpson's rule."""
    c = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi)
    x = np.linspace(0, abs(t), steps + 1)
    y = c * (1 + x * x / dof) ** (-(dof + 1) / 2)
    return 1 - 2 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()) * (x[1] - x[0]) / 3


@pytest.mark.parametrize(("t", "dof"), [(0.0, 5), (0.3, 1), (2.1, 2), (-1.7, 7), (3.3, 30), (1.96, 1000), (0.01, 2400)])
def test_p_values(t, dof):
    assert RG.two_sided_p(t, dof) == pytest.approx(t_tail(t, dof), abs=1e-9)


def plain_ols(y, x):
    """On centred columns, as the raw ones are too far from the origin for a direct solve."""
    n, m = len(y), x.mean(0)
    xc, yc = x - m, y - y.mean()
    b, *_ = np.linalg.lstsq(xc, yc, rcond=None)
    r = yc - xc @ b
    inv = np.linalg.inv(xc.T @ xc)
    err = np.sqrt(np.array([1 / n + m @ inv @ m, *np.diag(inv)]) * (r @ r) / (n - x.shape[1] - 1))
    return [y.mean() - m @ b, *b], err, 1 - r @ r / (yc @ yc)


def test_ols_by_group_equals_lstsq(spark):
    """Far from the origin, where raw sums of squares would lose all digits."""
    rng = np.random.default_rng(1)
    rows = []
    for g, n in (("a", 400), ("b", 57), (None, 30)):
        x = rng.normal(size=(n, 3)) * [1, 50, 0.01] + [1e6, -3e5, 40]
        y = 2.5 * x[:, 0] - 0.1 * x[:, 1] + 30 * x[:, 2] + rng.normal(size=n) + 7
        rows += [(g, float(v), *map(float, r)) for v, r in zip(y, x, strict=True)]
    df = spark.createDataFrame(rows + [("a", None, 1.0, 2.0, 3.0), ("b", 1.0, None, 2.0, 3.0)], "g string, y double, x1 double, x2 double, x3 double")
    got = {}
    for r in RG.ols(df.repartition(5), "y", ["x1", "x2", "x3"], ["g"]).collect():
        got.setdefault(r.g, []).append(r)
    assert set(got) == {"a", "b", None}
    for g, out in got.items():
        data = np.array([r[1:] for r in rows if r[0] == g])
        b, err, r2 = plain_ols(data[:, 0], data[:, 1:])
        assert [r.term for r in out] == ["Intercept", "x1", "x2", "x3"] and {r.n for r in out} == {len(data)}
        assert [r.coef for r in out] == pytest.approx(b, rel=1e-5) and [r.std_err for r in out] == pytest.approx(err, rel=1e-5)
        assert out[0].r2 == pytest.approx(r2, rel=1e-6)
        assert all(r.p_value == pytest.approx(t_tail(r.coef / r.std_err, len(data) - 4), abs=1e-8) for r in out if abs(r.t_value) < 30)


def test_ols_without_a_fit(spark):
    df = spark.createDataFrame([("few", 1.0, 2.0, 3.0), ("few", 2.0, 3.0, 1.0), *[("same", float(i), float(i * i), float(2 * i * i)) for i in range(9)],
                                *[("flat", float(i), 5.0, float(i % 3)) for i in range(9)]], "g string, y double, a double, b double")
    assert all(r.coef is None and r.p_value is None for r in RG.ols(df, "y", ["a", "b"], ["g"]).collect())
    assert RG.ols(df.limit(0), "y", ["a", "b"]).count() == 0


def plain_kmeans(points, k, seed, rounds):
    order = sorted(points, key=lambda p: (hashlib.md5(f"{seed}:{p[0]}".encode()).hexdigest(), p[0]))
    c = [(x, y) for _, x, y in order[:k]]
    near = lambda x, y: min(range(len(c)), key=lambda i: ((x - c[i][0]) ** 2 + (y - c[i][1]) ** 2, i))
    for _ in range(rounds):
        of = {}
        for _, x, y in points:
            of.setdefault(near(x, y), []).append((x, y))
        c = [tuple((2 * sum(v) + len(v)) // (2 * len(v)) for v in zip(*of[i], strict=True)) if i in of else c[i] for i in range(len(c))]
    return c, {p: near(x, y) for p, x, y in points}


@pytest.mark.parametrize(("n", "k"), [(300, 7), (3, 5), (60, 1)])
def test_kmeans_ignores_the_layout(spark, n, k):
    """On a lattice, where many distances tie."""
    r = random.Random(n)
    points = [(i, 100 * r.randrange(12), 100 * r.randrange(12)) for i in range(n)]
    want, labels = plain_kmeans(points, k, 9, 6)
    df = spark.createDataFrame(points, "id long, x long, y long")
    for parts in (1, 7):
        frame = df.repartition(parts).union(spark.createDataFrame([(-1, None, 3)], df.schema))
        assert CL.fit(frame, "id", k, 9, 6) == want
    got = df.select("id", CL.nearest(F.col("x"), F.col("y"), want).alias("l")).collect()
    assert {x.id: x.l for x in got} == labels
    assert CL.fit(df.limit(0), "id", k, 9, 6) == []


def test_whole_degrees(spark):
    df = spark.createDataFrame([(-74.25, 40.5), (-180.0, -90.0), (0.0000005, 89.9999999), (None, 1.0)], "lon double, lat double")
    x, y = CL.whole_degrees(F.col("lon"), F.col("lat"))
    assert [tuple(r) for r in df.select(x, y).collect()][:2] == [(105_750_000, 130_500_000), (0, 0)]


@pytest.mark.parametrize("block_minutes", [60, 1440])
def test_dense_series(spark, block_minutes):
    """A hot key, a key with one row, a null key and gaps over many blocks."""
    r = random.Random(4)
    t0 = dt.datetime(2011, 12, 30, 23, 50)
    rows = [(1, t0 + dt.timedelta(minutes=r.randrange(900))) for _ in range(800)]
    rows += [(2, t0 + dt.timedelta(minutes=x)) for x in (0, 3, 5, 6, 9000, 9001, 20_000)]
    rows += [(3, t0), (None, t0), (None, t0 + dt.timedelta(days=3)), (4, None)]
    df = spark.createDataFrame(rows, "z int, t timestamp_ntz").repartition(4)
    series = TS.dense_series(df, "z", "t", 6 * 60_000_000, block_minutes * 60_000_000)
    assert all(x.n == sum(x.counts) for x in series.collect())
    got = sorted(map(tuple, TS.series_rows(series, "z", 6 * 60_000_000).collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    want = []
    for z in (1, 2, 3, None):
        bins = [t.replace(minute=t.minute // 6 * 6, second=0) for k, t in rows if k == z and t]
        t = min(bins)
        while t <= max(bins):
            want.append((z, t, bins.count(t)))
            t += dt.timedelta(minutes=6)
    assert got == want


def test_dense_series_makes_no_calendar(spark, sf):
    """Two shuffles, no join."""
    from urbanlens.plans.registry import QUERIES, load_all

    load_all()
    plan = QUERIES["timeseries_dense_6min"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_dense_series_needs_whole_bins(spark):
    with pytest.raises(ValueError, match="whole bins"):
        TS.dense_series(spark.createDataFrame([], "z int, t timestamp_ntz"), "z", "t", 7 * 60_000_000)
