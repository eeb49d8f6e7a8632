"""Per-partition user functions (the ``map_partitions(func, meta=)`` hook).

Prefer column expressions; this is the escape hatch for logic that only
exists as pandas code. Batches cross the JVM/Python boundary as Arrow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Call ``fn`` once per partition with the iterator of its batches; it
    yields the output frames (``schema`` is the declared type, ``meta=``).

    The whole partition is never held at once. To sort one, use
    ``operators.layout.sort_within_partition``, which spills.
    """
    return df.mapInPandas(fn, schema)


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Apply a row-wise ``fn`` to every Arrow batch. The batch size is a session
    setting, so ``fn`` must not depend on which rows share a batch."""
    return map_partitions(df, lambda batches: (fn(b) for b in batches), schema)
