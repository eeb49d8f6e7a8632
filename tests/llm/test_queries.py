"""The registered queries on the smallest tables, against plain versions."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from urbanlens.llm.text import table

from . import brute


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]


def run(spark, sf, n):
    name = next(q for q in entry.queries() if q.startswith(f"op{n}_"))
    return entry.queries()[name](spark, sf)


def test_all_queries_and_the_pipeline_are_registered():
    names = [q for q in entry.queries() if q.startswith("op") and q.split("_")[0][2:].isdigit()]
    assert sorted(int(q.split("_")[0][2:]) for q in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize(("n", "plain", "columns"), [
    (1, brute.substring_dedup, "doc_id n_words n_removed kept_sha256"),
    (5, brute.components, "doc_id fingerprint component_id"),
])
def test_whole_rows(spark, sf, docs, n, plain, columns):
    assert sorted(map(tuple, run(spark, sf, n).select(*columns.split()).collect())) == sorted(plain(docs))


def test_op3(spark, sf, docs):
    want = {r[0]: r[1:] for r in brute.pii(docs)}
    for r in run(spark, sf, 3).collect():
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want[r.doc_id][:5]
        assert set(filter(None, want[r.doc_id][5].split(","))) <= set(r.spans.split(","))


def test_op7(spark, sf, docs):
    items = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    got = run(spark, sf, 7).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got)) == sorted(brute.decontaminate(docs, items))


def test_op9(spark, sf, docs):
    got = [tuple(r) for r in run(spark, sf, 9).collect()]
    assert sorted(r[:7] for r in got) == sorted(brute.rule_counts(docs))
    assert not any(r[6] and r[7] for r in got)


def test_op10(spark, sf, docs):
    got = sorted(map(tuple, run(spark, sf, 10).collect()))
    for g, w in zip(got, sorted(brute.unigrams(docs)), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] < 0


def test_op4(spark, sf, docs):
    got = run(spark, sf, 4).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((d, len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in docs)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and {r.law for r in got} == {"bytes"}


def test_op8_held_out_accuracy(spark, sf):
    """On the 0.1 tables, as the smallest have too few labels to learn from."""
    sf = sf.replace("0.001", "0.1")
    toxic = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    rows = [r for r in run(spark, sf, 8).collect() if r.held_out and r.doc_id in toxic]
    pos, neg = (np.array([r.score for r in rows if toxic[r.doc_id] == k]) for k in (1, 0))
    auc = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    assert auc > 0.93 and sum(r.predicted for r in rows if not toxic[r.doc_id]) <= 0.01 * len(neg)


def test_op2_separates_held_out_quality(spark, sf):
    sf = sf.replace("0.001", "0.1")
    good = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = [r for r in run(spark, sf, 2).collect() if r.doc_id in good]
    lost = [not r.kept for r in rows if good[r.doc_id]]
    assert np.mean(lost) < 0.03 and np.mean([not r.kept for r in rows if not good[r.doc_id]]) > 0.6


def test_pipeline_stages(spark, sf, docs):
    """Every stage on its predecessor's rows, against the plain version of its decision."""
    rows = table(spark, sf, "documents")
    columns, items = rows.columns, [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    pairs = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    before = pairs(rows)
    predicted = {r.doc_id: r.predicted for r in run(spark, sf, 8).collect()}
    stages = corpus_pipeline.STAGES
    assert len(stages) == 5

    def step(i, df):
        from urbanlens.llm.text import stored

        out = stored(stages[i][1](spark, df, sf), "test-stage")
        assert i == 4 or out.columns == columns
        return out

    rows = step(0, rows)
    assert pairs(rows) == [x for x in before if not predicted[x[0]]]
    before, rows = pairs(rows), step(1, rows)
    first = {c for _, _, c in brute.components(before)}
    assert pairs(rows) == [x for x in before if x[0] in first]
    before, rows = pairs(rows), step(2, rows)
    clean = {r[0] for r in brute.decontaminate(before, items) if not r[5]}
    assert pairs(rows) == [x for x in before if x[0] in clean]
    before, rows = pairs(rows), step(3, rows)
    after = dict(pairs(rows))
    assert set(after) == {d for d, _ in before}
    for doc, text, found in ((d, t, r[6]) for (d, t), r in zip(before, brute.pii(before), strict=True)):
        assert found or after[doc] == text
        for span in filter(None, found.split(",")):
            kind, s, e = span.split(":")
            assert text[int(s):int(e)] not in after[doc] and f"<{kind.upper()}>" in after[doc]
    pieces = step(4, rows).collect()
    whole = {}
    for p in pieces:
        whole[p.doc_id] = whole.get(p.doc_id, 0) + p.length
        assert p.offset + p.length <= 2048
    assert whole == {p.doc_id: p.doc_tokens for p in pieces} and set(whole) == set(after)


def test_pipeline_run(spark, sf):
    total = corpus_pipeline.run(spark, sf)
    assert total.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(total.columns)


@pytest.mark.parametrize("n", [1, 7])
def test_sql(spark, sf, duck, n):
    name = next(q for q in entry.queries() if q.startswith(f"op{n}_"))
    df = entry.queries()[name](spark, sf)
    want = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(want.fetchall())
