"""Best-two-fit packing, periodic runs and the filter audit, against plain versions."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from urbanlens.llm import bestfit, filter_audit, periodic
from urbanlens.llm.text import table

from . import brute
from .conftest import prose
from .test_operators import sort, tokenizer


# Best-two-fit packing

def one_by_one(lengths, limit):
    """Best-two-fit with a plain list of pieces, one sequence after the other."""
    left, out = sorted(lengths), []
    while left:
        seq, room = [], limit
        while fits := [x for x in left if x <= room]:
            seq.append(max(fits))
            left.remove(seq[-1])
            room -= seq[-1]
        gap, last = room, seq[-1]
        pairs = [(left[i] + left[j], left[j], left[i]) for i in range(len(left)) for j in range(i + 1, len(left)) if left[i] + left[j] <= gap + last]
        if gap and pairs and max(pairs)[0] > last:
            _, a, b = max(pairs)
            seq[-1:] = [a, b]
            left.remove(a)
            left.remove(b)
            left = sorted([*left, last])
        out.append(tuple(sorted(seq, reverse=True)))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=40))
def test_plan_equals_one_by_one(lengths):
    counts = np.bincount(lengths, minlength=31)
    got = [tuple(sizes) for sizes, often in bestfit.plan(counts, 30) for _ in range(often)]
    assert got == one_by_one(lengths, 30)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(3)
    counts = np.bincount(np.minimum(rng.lognormal(6, 1, 50_000).astype(int) + 1, 2048), minlength=2049)
    plan = bestfit.plan(counts, 2048)
    need = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert sum(k for _, k in plan) <= need + 2 and all(sum(s) <= 2048 for s, _ in plan)
    assert (sum((np.bincount(s, minlength=2049) * k for s, k in plan), np.zeros(2049, int)) == counts).all()
    # A thousand times the pieces need hardly more kinds of sequences.
    assert len(bestfit.plan(counts * 1000, 2048)) < 2 * len(plan) + 100


def packed(df, ids_of, limit):
    """Checks every rule of the pieces and returns the number of sequences."""
    by, seqs = {}, {}
    for r in df.collect():
        by.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    assert set(by) == set(ids_of)
    for doc, rows in by.items():
        copies = ids_of[doc]
        want = Counter()
        for ids in copies:
            for k, at in enumerate(range(0, len(ids), limit)):
                part = ids[at:at + limit]
                want[k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        assert want == Counter((r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == list(np.cumsum([0] + [r.length for r in s])[:-1]) and sum(r.length for r in s) <= limit
    return len(seqs)


@pytest.mark.parametrize("limit", [64, 256, 2048])
def test_packed_texts(make, odd_rows, limit):
    from tokenizers import Tokenizer

    rows = odd_rows + [(30, "x <|endoftext|> y"), (31, "日本語 and more"), (32, "y" * 9000)] + [(40 + i, "the same text again") for i in range(60)]
    whole, ids_of = Tokenizer.from_file(tokenizer()), {}
    for d, t in rows:
        ids_of.setdefault(d, []).append([*whole.encode(t or "", add_special_tokens=False).ids, 0])
    n = packed(bestfit.pack_texts(make(rows).repartition(5), tokenizer(), limit), ids_of, limit)
    sizes = [len(part) for copies in ids_of.values() for ids in copies for at in range(0, len(ids), limit) if (part := ids[at:at + limit])]
    assert n == len(one_by_one(sizes, limit))


def test_op11(spark, sf):
    got = entry.queries()["op11_best_fit_packing"](spark, sf)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer())
    ids_of = {r.doc_id: [[*whole.encode(r.text or "", add_special_tokens=False).ids, 0]] for r in table(spark, sf, "documents").collect()}
    total = sum(len(ids) for (ids,) in ids_of.values())
    assert packed(got, ids_of, 2048) <= -(-total // 2048) + 1


# Periodic runs

texts = st.lists(st.integers(1, 3), max_size=40) | st.tuples(
    st.lists(st.integers(1, 3), max_size=9), st.lists(st.integers(1, 3), min_size=1, max_size=7), st.integers(2, 8),
    st.lists(st.integers(1, 3), max_size=9)).map(lambda x: x[0] + x[1] * x[2] + x[1][:len(x[1]) // 2] + x[3])


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4), st.sampled_from([(24, 3), (2, 2), (4, 3), (6, 2)]))
def test_runs_equal_all_pairs(batch, least):
    got = list(zip(*(x.tolist() for x in periodic.find_runs(batch, *least)), strict=True))
    assert got == [(k, *r) for k, t in enumerate(batch) for r in brute.runs(t, *least)]


@settings(max_examples=200, deadline=None)
@given(texts)
def test_tree_and_extensions(text):
    """Every suffix is a leaf, the leaves are in order, and extensions are what they say."""
    ext = periodic.Extensions([text])
    whole = [*text, 0]
    order = sorted(range(len(whole)), key=lambda i: whole[i:])
    assert [int(x) for x in np.argsort(ext.rank)] == order
    pairs = [(i, j) for i in range(len(whole)) for j in range(len(whole)) if i != j]
    if pairs:
        a, b = map(np.array, zip(*pairs, strict=True))
        want = [next(k for k in range(len(whole)) if whole[i + k] != whole[j + k]) for i, j in pairs]
        assert ext.common(a, b).tolist() == want


def periodic_rows():
    u = prose(11, 9)
    return [(100, " ".join([u] * 7)), (101, "a " * 24), (102, "a " * 23), (103, prose(20, 1) + " " + "x y " * 30 + prose(20, 2) + " " + (u + " ") * 4),
            (104, "a b a b c " * 40), (105, ("p q r " * 9 + "z ") * 5), (None, "a " * 50)] + [(1000 + i, prose(100 + i, i)) for i in range(40)]


def test_periodic_runs(make, odd_rows):
    # All pairs of places of the longest text would take minutes.
    rows = [(d, t if len(t or "") < 50_000 else t[:20_000]) for d, t in odd_rows] + periodic_rows()
    got = periodic.periodic_runs(make(rows).repartition(3)).collect()
    assert sort(got) == sort(brute.periodic(rows))
    assert sum(r.n_runs for r in got) > 12


def test_long_periodic_text(make):
    """Trees as deep as the text is long."""
    rows = [(1, "a b " * 20_000), (2, "w " * 40_000), (3, prose(30_000, 8))]
    got = {r.doc_id: tuple(r[1:6]) for r in periodic.periodic_runs(make(rows), change=lambda w, _: w).collect()}
    assert got[1] == (1, 0, 40_000, 2, 20_000_000) and got[2] == (1, 0, 40_000, 1, 40_000_000) and got[3][0] == 0


def test_op12(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert sort(entry.queries()["op12_periodic_runs"](spark, sf).collect()) == sort(brute.periodic(docs))


# Filter audit

def test_audit(spark, make, odd_rows):
    rows = odd_rows + [(50 + i, t) for i, t in enumerate([prose(150, 1), "ABC " * 130, "# a", prose(150, 1), "x" * 5, "A" * 9 + "b" * 91, "A" * 10 + "b" * 91,
                                                          " ".join(f"w{k}" for k in range(100)), " ".join(f"w{k % 80}" for k in range(100)),
                                                          " ".join(f"w{k % 79}" for k in range(100)), "", None])] + [(None, "x" * 5), (None, "q"), (None, "q")]
    docs = make(rows).unionByName(make(rows[:4] + [(90, prose(150, 1)), (0, "q")], lang="de")).unionByName(make([(91, "# a"), (92, None)], lang=None))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, None), (50, 1, 1), (53, 1, 0), (None, 1, 1), (90, 0, 1), (91, 1, 1), (999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    want = brute.filter_audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    assert sort(filter_audit.audit(docs.repartition(4), labels).collect()) == sort(want)


def test_op13(spark, sf, duck):
    df = entry.queries()["op13_filter_audit"](spark, sf)
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text", "lang").collect()]
    got = sort(df.collect())
    assert got == sort(brute.filter_audit(docs, [tuple(r) for r in table(spark, sf, "labels").select("doc_id", "quality", "toxic").collect()]))
    want = duck.execute(entry.oracle_sql()["op13_filter_audit"])
    assert df.columns == [d[0] for d in want.description] and got == sort(want.fetchall())


def test_no_rows(spark, make):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    empty = make([])
    for df in (bestfit.pack_texts(empty, tokenizer()), periodic.periodic_runs(empty), filter_audit.audit(empty, labels)):
        assert df.count() == 0
    one = make([(None, None)], lang=None)
    assert [(r.part, r.kept, r.removed) for r in filter_audit.audit(one, labels).filter("filter_order = 'ABCDE' AND step = 1").collect()] == [("", 0, 1)]
    assert [(r.length, r.offset) for r in bestfit.pack_texts(one, tokenizer()).collect()] == [(1, 0)]


# Plain versions of the placement of shards and of the rules' verdicts

def test_placement_takes_the_highest_dot_product():
    from urbanlens.llm import sharding

    rng = np.random.default_rng(6)
    demand = rng.integers(1, 1000, (400, 3)).astype(float)
    demand[50:60] = demand[50]
    capacity = demand.sum(0) / 7
    got = sharding.place(demand, capacity, 7)
    left = [[1.0] * 3 for _ in range(7)]
    share = [[x / c for x, c in zip(d, capacity, strict=True)] for d in demand.tolist()]
    weigh = lambda d: sum(w * x for w, x in zip(sharding.WEIGHTS, d, strict=True))
    for i in sorted(range(len(share)), key=lambda i: (-round(weigh(share[i]), 12), i)):
        fit = [weigh([x * y for x, y in zip(room, share[i], strict=True)]) for room in left]
        assert fit[got[i]] >= max(fit) - 1e-12
        left[got[i]] = [a - b for a, b in zip(left[got[i]], share[i], strict=True)]


def test_verdicts_equal_exact_cutoffs(spark, make, odd_rows):
    from urbanlens.llm import rules

    rows = [(i, prose(55, i) + (" # !" if i % 40 == 0 else "")) for i in range(900)] + [(2000 + i, " # ".join(prose(60, 900 + i).split())) for i in range(20)]
    rows += [(2100 + i, prose(20, i) + " ! " * 40) for i in range(10)] + [(2200, prose(80, 3).upper()), (2201, prose(60, 1)), (1, prose(55, 1))]
    few = [(3000 + i, prose(60, 5000 + i)) for i in range(30)] + [(3100, " # ".join(prose(60, 6000).split()))]
    odd = [(d if d is None else 4000 + d, t) for d, t in odd_rows if len(t or "") < 50_000]
    docs = make(rows).unionByName(make(few, lang="de")).unionByName(make(odd, lang=None))
    good = {*range(900), *range(3000, 3030)}
    labels = spark.createDataFrame([(i, int(i in good)) for i, _ in rows + few] + [(None, 1), (4001, None)], "doc_id long, quality int")
    want = brute.rule_verdicts([(r.doc_id, r.text, r.lang) for r in docs.collect()], good)
    got = rules.quality_rules(docs, labels).select("doc_id", "base_failed", "kept").collect()
    assert sort(got) == sort(want)
    rejected = [r.doc_id for r in got if not r.kept and not r.base_failed]
    assert rejected and all(d in range(900) or d > 1999 for d in rejected) and 3100 not in rejected


# Kneser-Ney classifier: every trusted row counts, the driver stays small

def test_kneser_ney_equals_the_plain_model(make, odd_rows):
    from urbanlens.llm import quality

    rows = [(i, prose(40, i)) for i in range(25)] + [r for r in odd_rows if len(r[1] or "") < 5000] + [(99, "ABC 12 ... ###")]
    got = quality.train(make(rows))
    plain = brute.kneser_ney([t for _, t in rows], quality.classes(), quality.SYMBOLS, quality.ORDER)
    n = quality.SYMBOLS
    codes = {(0, 0, 0, 0), (5, 6, 7, 8), (47, 47, 47, 47), (0, 0, 0, 47)}
    for _, t in rows[::3]:
        s = [0, 0, 0, *quality.classes()[np.frombuffer((t or "").encode(), np.uint8)].tolist()]
        codes |= {tuple(s[i:i + 4]) for i in range(len(s) - 3)} | {(s[i], s[i + 1], s[i + 2], (s[i + 3] + 1) % n) for i in range(len(s) - 3)}
    at = np.array([((a * n + b) * n + c) * n + d for a, b, c, d in codes])
    assert len(codes) > 500 and np.allclose(got[at], np.log10([plain(g) for g in codes]), rtol=1e-6, atol=1e-6)


def test_every_trusted_row_is_counted(spark, monkeypatch):
    """More than 20,000 trusted rows outside the held-out third, some of them repeated."""
    from pyspark.sql import functions as F

    from urbanlens.llm import quality

    docs = spark.range(33_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    docs = docs.unionAll(docs.filter("doc_id < 50"))
    labels = spark.range(32_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality")).unionAll(spark.range(90).select("id", F.lit(1)))
    seen = []

    def train(texts, real=quality.train):
        seen.append(texts.groupBy("text").count().collect())
        return real(texts)

    monkeypatch.setattr(quality, "train", train)
    out = quality.classify(docs, labels)
    trusted = docs.filter("doc_id < 32000").filter(~quality._held(quality.Settings()))
    assert sort(map(tuple, seen[0])) == sort(map(tuple, trusted.groupBy("text").count().collect())) and sum(r["count"] for r in seen[0]) > 20_500
    assert out.count() == 33_050


def test_training_is_light_on_the_driver(spark, make):
    """Few stages, and Python memory near the one table of doubles the driver needs."""
    import tracemalloc

    from urbanlens.llm import quality

    docs, labels = make([(i, prose(40, i)) for i in range(60)]), spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    sc, group = spark.sparkContext, "quality-training"
    sc.setJobGroup(group, group)
    tracemalloc.start()
    try:
        quality.train(docs.join(labels, "doc_id"))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        for name in ("spark.jobGroup.id", "spark.job.description"):
            sc.setLocalProperty(name, None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    assert peak < 2.5 * 8 * quality.SYMBOLS**quality.ORDER and len(stages) < 40


# Kneser-Ney classifier: raw bytes, joined by key

def test_byte_model_equals_the_plain_one(spark, make, odd_rows):
    from urbanlens.llm import quality

    trusted = [(i, prose(40, i) + " Ä é ж 日本") for i in range(25)] + [r for r in odd_rows if len(r[1] or "") < 5000]
    rows = trusted + [(200, "日木 жз ÄÖ"), (201, "\x00\x00\x00 zq|"), (201, "\x00\x00\x00 zq|"), (None, "A b"), (202, odd_rows[11][1] + " end"), (203, "a"), (204, prose(20000, 9))]
    table = quality.train(make(trusted))
    got = quality.log_probs(make(rows).select("doc_id", "lang", "text"), table).collect()
    symbol, n = quality.classes().tolist(), quality.SYMBOLS
    fold = brute.kneser_ney([t for _, t in trusted], symbol, n, quality.ORDER)

    def lowest(gram, seen):
        own = {b: seen.get(bytes([b]), 0) + 1 for b in range(256) if symbol[b] == symbol[gram[-1]]}
        return fold(tuple(symbol[b] for b in gram[-quality.ORDER:])) * own[gram[-1]] / sum(own.values())

    p, known = brute.byte_kneser_ney([t for _, t in trusted], quality.RAW, lowest), {}

    def whole(text):
        s = b" " * (quality.RAW - 1) + (text or "").encode()
        grams = [s[i:i + quality.RAW] for i in range(len(s) - quality.RAW + 1)]
        known.update({g: np.log10(p(g)) for g in set(grams) - set(known)})
        return sum(known[g] for g in grams)

    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    want = sorted(((d, len((t or "").encode()), float(whole(t))) for d, t in rows), key=key)
    got = sorted(((r.doc_id, r.n_bytes, r.log10_prob) for r in got), key=key)
    assert [x[:2] for x in got] == [x[:2] for x in want] and len(got) == len(rows)
    assert np.allclose([x[2] for x in got], [x[2] for x in want], rtol=1e-6, atol=1e-6)
    context = b"alpha"
    assert abs(sum(p(context + bytes([b])) for b in range(256)) - 1) < 1e-9


def test_bytes_of_one_class_are_told_apart(spark, make):
    """Capitals, digits, signs and foreign letters that the classes fold together."""
    from urbanlens.llm import quality

    good = " ".join(["ABBA BABA 1221 #*# 日本 日本"] * 4)
    rows = [(i, good) for i in range(200)] + [(900, good.replace("A", "X")), (901, good.replace("12", "79")), (902, good.replace("#", "%")), (903, good.replace("日", "无"))]
    symbol = quality.classes()
    fold = lambda t: symbol[np.frombuffer(t.encode(), np.uint8)].tolist()
    assert all(fold(t) == fold(good) for _, t in rows[200:203])
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality.classify(make(rows), labels).collect()}
    assert all(got[i] for i in range(200)) and not any(got[i] for i in range(900, 904))


def test_parts_do_not_change_the_result(spark, make, odd_rows):
    from urbanlens.llm import quality

    docs = make(odd_rows).select("doc_id", "lang", "text")
    conf, name, seen = spark.conf, "spark.sql.shuffle.partitions", []
    was = conf.get(name)
    try:
        for parts in (3, 11):
            conf.set(name, parts)
            rows = quality.log_probs(docs, quality.train(docs)).collect()
            seen.append(sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.log10_prob) for r in rows))
    finally:
        conf.set(name, was)
    assert seen[0] == seen[1] and len(seen[0]) == len(odd_rows)


def test_small_pieces_do_not_change_the_result(odd_rows, monkeypatch):
    """The tasks' own functions, with n-grams merged and answered again and again."""
    from types import SimpleNamespace

    import pyarrow as pa
    import pyarrow.compute as pc

    from urbanlens.llm import quality

    ids, texts = zip(*odd_rows)
    docs = pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "lang": pa.array(["en"] * len(ids)), "text": pa.array(texts),
                            "part": pa.array([i % 3 for i in range(len(ids))], pa.int32())})
    seen = []
    for many, block, slots in ((1 << 21, 1 << 20, 23), (40, 300, 5)):
        for name, value in (("MANY", many), ("BLOCK", block), ("SLOTS", slots)):
            monkeypatch.setattr(quality, name, value)
        counted = pa.Table.from_batches([b for part in (docs.slice(0, 7), docs.slice(7)) for b in quality._count([part])]).sort_by("shard")
        merged = pa.Table.from_batches(quality._merge(counted.to_batches(50)))
        small = merged.filter(pc.greater(merged["what"], 1)).group_by(["what", "gram"]).aggregate([("c", "sum")]).rename_columns(["what", "gram", "c"])
        low = quality._low(small, np.full(quality.SYMBOLS**quality.ORDER, -np.log10(quality.SYMBOLS), np.float32))
        whole = merged.filter(pc.equal(merged["what"], 0))
        model = [{"shard": r["shard"], "part": -1, "n": r["n"], "keys": r["keys"], "counts": r["counts"]} for r in whole.to_pylist() if r["shard"] % 5]
        bundles = pa.Table.from_batches(quality._bundle(np.array([4, 8, 15]))([docs.slice(0, 9), docs.slice(9)]))
        asked = [r | {"counts": None} for b in quality._ask(bundles.to_batches()) for r in b.to_pylist()]
        rows = sorted(model + asked, key=lambda r: (r["shard"], r["part"]))
        schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
        answers = pa.Table.from_batches(quality._answer(SimpleNamespace(value=low))(pa.Table.from_pylist(rows, schema).to_batches(30)))
        of = lambda t, part: t.filter(pc.equal(t["part"], part))
        scored = pa.concat_tables([quality._score(of(bundles, part), of(answers, part)) for part in (4, 8, 15)])
        grams = [(r["shard"], quality._unpack_keys(r["keys"], r["n"]).tolist(), quality._unpack(r["counts"], r["n"], np.int64).tolist()) for r in whole.to_pylist()]
        seen.append((sorted(grams), sorted(small.to_pylist(), key=str), sorted(scored.to_pylist(), key=str)))
    assert seen[0] == seen[1]
    grams, small, scored = seen[0]
    assert sum(sum(c) for _, _, c in grams) == sum(r["n_bytes"] for r in scored) == sum(len((t or "").encode()) for t in texts)
    with pytest.raises(RuntimeError):
        quality._score(bundles, answers.slice(0, 5))
