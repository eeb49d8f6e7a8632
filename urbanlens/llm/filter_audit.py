"""How filters overlap, for every order in which they could run.

Five filters judge a document by its whole text (and, for copies, by the whole
table). One row per part (a value of ``lang``), filter order and step says what
that step keeps and removes, what it would have removed had nothing run before,
and what only it removes.

All of this follows from how many documents fail each subset of the filters.
Spark counts them, per part, and twice more for labelled documents; a part's
counts are then an array of 2 x 2 x 2 x 2 x 2 (passes or fails, per filter).
A step is a contraction of that array: along each filter's axis it selects
passing (ran before), failing (this one) or all (runs later), and ``einsum``
does so for all orders and steps at once.

Copies: a text's least ``doc_id`` comes from an aggregate by its digest, after
equal rows were counted together, so a text held by a third of all rows is a
few rows when it is shuffled. Nothing is joined back to the documents.

Defined cases: a null text is empty and no copy of one with a smaller id unless
that is empty or null as well; a null id is greater than any other; rows with
the same id and text are no copies of each other; a null part is the empty
string; several labels of one document count as 1 if any is 1; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.text import NO_ID, id_key

FILTERS = "ABCDE"
AXES = "abcde"
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")
WHITE = " \t\n\v\f\r"

#: What a step selects along an axis: (passes, fails).
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def text_failures(text: Column) -> Column:
    """One bit per filter A to D (A is 1, B 2, C 4, D 8) that ``text`` fails."""
    bare = F.btrim(text, F.lit(WHITE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    n, distinct, length = F.size(words), F.size(F.array_distinct(words)), F.char_length(text)
    capitals = length - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    symbols = F.translate(text, "#$%&*|", "") != text
    # Long products: a text of 2^31 / 100 characters would overflow.
    fails = (n < 100, distinct * F.lit(100).cast("long") < n * F.lit(80).cast("long"),
             capitals * F.lit(100).cast("long") > length * F.lit(10).cast("long"), symbols)
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Documents counted by part and the filters A to D they fail: part, bits, and for each of all (n),
    good and toxic documents those that are the first with their text (``_0``) and those that are copies (``_1``)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Rows without an id have no label; a second key spreads them and keeps them from meeting one.
    spread = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))).otherwise(0)
    rows = docs.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), id_key().alias("doc_id"),
                       spread.cast("long").alias("spread"), F.unhex(F.sha2(text, 256)).alias("digest"), text_failures(text).alias("bits"))
    marks = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
             .withColumn("spread", F.lit(0).cast("long")))
    rows = rows.join(marks, ["doc_id", "spread"], "left").fillna(0, ["good", "toxic"])
    kind = ["digest", "part", "bits", "good", "toxic"]
    same = rows.groupBy("doc_id", "spread", *kind).agg(F.count("*").alias("n"))
    kinds = same.groupBy(*kind).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("least"))
    # A digest has at most four rows a part here.
    first = F.col("least.doc_id") == F.min("least.doc_id").over(Window.partitionBy("digest"))
    # All rows without an id are equally late.
    at_first = F.when(F.col("least.doc_id") == NO_ID, F.col("n")).otherwise(F.col("least.n"))
    split = kinds.select("part", "bits", "good", "toxic", "n", F.when(first, at_first).otherwise(0).alias("firsts"))
    sums = []
    for name, of in (("n", F.lit(1)), ("good", F.col("good")), ("toxic", F.col("toxic"))):
        sums += [F.sum(of * F.col("firsts")).alias(f"{name}_0"), F.sum(of * (F.col("n") - F.col("firsts"))).alias(f"{name}_1")]
    return split.groupBy("part", "bits").agg(*sums)


def contractions() -> tuple[list[tuple[str, int, int]], list[np.ndarray]]:
    """(order, step, filter) of every row, and for every axis the selection (passes, fails) of every row."""
    keys, picks = [], []
    for order in permutations(range(len(FILTERS))):
        for step, f in enumerate(order):
            keys.append(("".join(FILTERS[k] for k in order), step + 1, f))
            picks.append([PASS if k in order[:step] else FAIL if k == f else ALL for k in range(len(FILTERS))])
    return keys, list(np.array(picks, np.int64).transpose(1, 0, 2))


def audit_counts(counts: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of all 600 rows for ``counts`` of shape (3, 2, 2, 2, 2, 2): all, good, toxic; then fails or not per filter."""
    keys, picks = contractions()
    select = lambda use: np.einsum(f"m{AXES},{','.join('r' + a for a in AXES)}->mr", counts, *use, optimize=False)
    swap = lambda was, now: [np.where((p == was).all(1)[:, None], now, p) for p in picks]
    removed = select(picks)
    fails = select(swap(PASS, ALL))
    which = np.array([f for _, _, f in keys])
    total = np.bincount(which, removed[0], len(FILTERS)).astype(np.int64)
    return {"kept": select(swap(FAIL, PASS))[0], "removed": removed[0], "redundant": fails[0] - removed[0],
            "unique_fails": select([np.where((p == FAIL).all(1)[:, None], FAIL, PASS) for p in picks])[0],
            "good_lost": removed[1], "toxic_lost": removed[2], "shapley": total[which]}


def _audit_part(rows: pd.DataFrame) -> pd.DataFrame:
    counts = np.zeros((3, 32), np.int64)
    for copy in (0, 1):
        counts[:, rows["bits"] + 16 * copy] = rows[[f"{m}_{copy}" for m in ("n", "good", "toxic")]].to_numpy(np.int64).T
    # The lowest bit is the last axis of a reshape; filter A comes first.
    cube = counts.reshape(3, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1)
    keys, _ = contractions()
    head = {"part": rows["part"].iloc[0], "filter_order": [k[0] for k in keys], "step": [k[1] for k in keys]}
    return pd.DataFrame({**head, **audit_counts(cube)})


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step; see the module's head."""
    return failures(docs, labels, part).groupBy("part").applyInPandas(_audit_part, SCHEMA)
