"""Least squares from one mergeable aggregate.

The means and the centred cross products of all columns (``avg`` and
``covar_pop``, which Spark merges between partial results without loss of
precision) are all that a fit needs: a fixed number of values a group however
many rows it has. The normal equations of a group are then solved where its
row lies; nothing comes to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUMMARY = "term string, coef double, std_err double, t_value double, p_value double, r2 double, n bigint"


def cross_products(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per group of ``by``: n, ``mean`` and ``cov`` (upper triangle by rows) over the rows without a null in ``columns``."""
    x = [F.col(c).cast("double") for c in columns]
    pairs = [F.covar_pop(x[i], x[j]) for i in range(len(x)) for j in range(i, len(x))]
    return df.dropna(subset=list(columns)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in x]).alias("mean"), F.array(*pairs).alias("cov"))


def two_sided_p(t: float, dof: float) -> float:
    """Probability that Student's t with ``dof`` degrees of freedom is at least as far from 0 as ``t``."""
    return 1.0 if t == 0 else _incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    value, c, d = 1.0, 1.0, 0.0
    for k in range(10_000):
        m = k // 2
        if k == 0:
            step = 1.0
        elif k % 2 == 0:
            step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / ((1.0 + step * d) or tiny)
        c = (1.0 + step / c) or tiny
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * (value - 1.0)


def solve(terms: Sequence[str], n: int, mean: np.ndarray, cov: np.ndarray) -> list[tuple]:
    """Rows of ``SUMMARY`` for one group; ``terms`` are the features, the label is the last column of ``mean``.

    A group with too few rows, or with features that depend on each other, has null results.
    """
    k = len(terms)
    names = ["Intercept", *terms]
    full = np.zeros((k + 1, k + 1))
    full[np.triu_indices(k + 1)] = cov
    full = full + np.triu(full, 1).T
    sxx, sxy, syy = full[:k, :k] * n, full[:k, k] * n, full[k, k] * n
    dof = n - k - 1
    scale = np.sqrt(np.diag(sxx))
    if n < 1 or not np.all(scale > 0) or np.linalg.matrix_rank(sxx / np.outer(scale, scale), tol=1e-10) < k:
        return [(t, None, None, None, None, None, int(n)) for t in names]
    inverse = np.linalg.inv(sxx / np.outer(scale, scale)) / np.outer(scale, scale)
    slope = inverse @ sxy
    coef = [mean[k] - slope @ mean[:k], *slope]
    rss = max(syy - slope @ sxy, 0.0)
    r2 = 1.0 - rss / syy if syy > 0 else None
    if dof < 1:
        return [(t, float(c), None, None, None, r2, int(n)) for t, c in zip(names, coef, strict=True)]
    spread = [1.0 / n + mean[:k] @ inverse @ mean[:k], *np.diag(inverse)]
    out = []
    for t, c, s in zip(names, coef, spread, strict=True):
        err = math.sqrt(rss / dof * s)
        ratio = float(c) / err if err > 0 else None
        p = None if ratio is None else two_sided_p(ratio, dof)
        out.append((t, float(c), err, ratio, p, r2, int(n)))
    return out


def ols(df: DataFrame, label: str, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Ordinary least squares with an intercept: one row per group of ``by`` and term.

    Columns: ``by``, term, coef, std_err, t_value, p_value (two-sided), r2, n.
    """
    features, by = list(features), list(by)
    sums = cross_products(df, [*features, label], by)
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in sums.schema if f.name in by] + [SUMMARY])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                if r["n"]:
                    key = tuple(r[b] for b in by)
                    rows += [(*key, *x) for x in solve(features, int(r["n"]), np.array(r["mean"], float), np.array(r["cov"], float))]
            yield pd.DataFrame(rows, columns=[*by, *names])

    return sums.mapInPandas(run, schema)
