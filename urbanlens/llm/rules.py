"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose measure lies over a cutoff, and each
stratum (language) has its own cutoffs. They come from labelled good documents
(distinct texts, all of them): from the loosest cutoff to stricter ones, a
cutoff is accepted while the exact binomial test shows that at most ``risk /
number of rules`` of the stratum's good documents are rejected by it. Cutoffs
of one rule and stratum are tested in a fixed order up to the first failure;
across rules and strata the error rate is divided (Bonferroni). So with
probability ``1 - error`` no stratum loses more than ``risk`` of its good
documents to the rules. A rule without evidence rejects nothing.

The measures of all documents are taken in one pass; the tests see counts
per stratum, rule and bin, made by Spark.

Defined cases: null or empty text has no words and measures of zero; repeated
rows are judged alike; a null stratum is a stratum; without labels no rule
rejects; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm import text as X

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
#: Measures from 0 to 1, cut into BINS steps; larger values share the last.
RULES = {
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_upper / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "long_words": "word_chars / greatest(n_words, 1) / 40",
}
BINS = 100


@dataclass(frozen=True)
class Settings:
    risk: float = 0.05
    error: float = 0.05


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    space = X.byte_table("space")
    code = np.arange(256)
    flags = {"n_symbols": np.isin(code, np.frombuffer(SYMBOLS, np.uint8)), "n_upper": (code >= 0x41) & (code <= 0x5A), "n_marks": code == 0x21}
    chars = space & ((code & 0xC0) != 0x80)
    for batch in batches:
        data, off = X.column_bytes(batch.column("text"))
        for a, b in X.chunks(off):
            w = X.Words(data, off, a, b, space)
            n = w.counts()
            out = {"n_words": n}
            for name, table in {**flags, "word_chars": chars}.items():
                sums = np.r_[0, np.cumsum(table[w.data])]
                out[name] = sums[w.offsets[1:]] - sums[w.offsets[:-1]]
            out["n_repeat_words"] = _repeats(w)
            raw, lines, dups = w.data.tobytes(), np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
            for i, (s, e) in enumerate(zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True)):
                full = [x for x in raw[s:e].split(b"\n") if x.strip()]
                lines[i], dups[i] = len(full), len(full) - len(set(full))
            out["n_lines"], out["n_dup_lines"] = lines, dups
            cols = [c.slice(a, b - a) for c in batch.columns[1:]] + [pa.array(out[c].astype(np.int64)) for c in COUNTS]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "lang", "key", *COUNTS])


def _repeats(w: X.Words) -> np.ndarray:
    """Per document: its words inside three-word windows that it has twice or more."""
    hit = np.zeros(w.n + 1, bool)
    if w.n >= 3:
        p = np.arange(w.n - 2)
        doc = w.doc()
        p = p[doc[p] == doc[p + 2]]
        g = X.SpanHash(w.hashes(), X.BASE_B)(p, p + 3) ^ X.mix(doc[p].astype(np.uint64) + np.uint64(1))
        order = np.argsort(g)
        same = g[order][1:] == g[order][:-1]
        twice = p[order[np.r_[same, False] | np.r_[False, same]]] if len(p) else p
        for k in range(3):
            hit[twice + k] = True
    sums = np.r_[0, np.cumsum(hit[:-1])]
    return sums[w.ptr[1:]] - sums[w.ptr[:-1]]


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, key (hash of the text) and the counts, for every row."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    slim = docs.select(F.col("text").cast("string"), F.col("doc_id").cast("long"), lang.alias("lang"), X.text_key().alias("key"))
    return slim.mapInArrow(_measure, "doc_id long, lang string, key long, " + ", ".join(f"{c} long" for c in COUNTS))


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p)."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    logs = [math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) for x in i.tolist()] + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def strictest(bins: np.ndarray, counts: np.ndarray, risk: float, error: float) -> int:
    """The lowest bin b such that rejecting all bins over b is proven, stepping down from the last; BINS if none is.

    ``counts[i]`` good documents lie in bin ``bins[i]``.
    """
    n, k, cut = int(counts.sum()), 0, BINS
    have = dict(zip(bins.tolist(), counts.tolist(), strict=True))
    for b in range(BINS, -1, -1):
        if binomial_tail(n, k, risk) > error:
            break
        cut = b
        k += int(have.get(b, 0))
    return cut


def thresholds(measured: DataFrame, good: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, one cutoff a rule): a document is rejected if its bin lies over the cutoff."""
    known = measured.join(good.select("doc_id").distinct(), "doc_id").dropDuplicates(["lang", "key"])
    binned = known.select("lang", F.explode(F.create_map(*[x for r in RULES for x in (F.lit(r), _bin(r))])).alias("rule", "bin"))
    counts = X.stored(binned.groupBy("lang", "rule", "bin").count(), "good-bins")
    strata = max(1, counts.select("lang").distinct().count())
    risk, error = settings.risk / len(RULES), settings.error / (len(RULES) * strata)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        cut = strictest(rows["bin"].to_numpy(), rows["count"].to_numpy(), risk, error)
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "rule": rows["rule"].iloc[:1], "cut": [cut]})

    # A group has at most BINS + 1 rows.
    return counts.groupBy("lang", "rule").applyInPandas(choose, "lang string, rule string, cut int").groupBy("lang").pivot("rule", list(RULES)).agg(F.first("cut"))


def _bin(rule: str):
    return F.least(F.ceil(F.expr(RULES[rule]) * F.lit(float(BINS))), F.lit(BINS)).cast("int")


def judge(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """``measured`` with base_failed, kept, and the first rule that rejects (null if none)."""
    cuts = cuts.withColumnsRenamed({r: f"cut_{r}" for r in RULES}).withColumnRenamed("lang", "stratum")
    rows = measured.join(cuts, measured["lang"].eqNullSafe(cuts["stratum"]), "left")
    over = F.coalesce(*[F.when(_bin(r) > F.col(f"cut_{r}"), F.lit(r)) for r in RULES])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (rows.withColumn("base_failed", failed).withColumn("rule", over)
            .withColumn("kept", ~failed & F.col("rule").isNull()).drop("stratum", *[f"cut_{r}" for r in RULES]))


def quality_rules(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every row of ``docs`` judged; ``labels``: (doc_id, quality), 1 for good."""
    measured = X.stored(measures(docs), "measures")
    good = labels.filter("quality = 1 and doc_id is not null")
    return judge(measured, thresholds(measured, good, settings))
