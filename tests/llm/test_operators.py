"""Each operator against a plain version or a property that its contract fixes, on odd inputs."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from urbanlens.llm import components, decontaminate, hmm, packing, pii, quality, rules, sharding, simhash, substring_dedup, toxicity

from . import brute
from .conftest import prose


def sort(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Substring dedup

def test_substrings(make, odd_rows):
    from pyspark.sql import functions as F

    got = substring_dedup.dedup_substrings(make(odd_rows)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert sort(got) == sort(brute.substring_dedup(odd_rows))


def test_substrings_small_windows(make):
    rows = [(i, prose(12, s)) for i, s in enumerate([1, 2, 1, 3, 2, 2])] + [(9, prose(12, 1) + " " + prose(12, 2)), (10, "x x x x x x x x")]
    from pyspark.sql import functions as F

    for window, k in ((4, 2), (5, 5), (7, 3)):
        got = substring_dedup.dedup_substrings(make(rows), window, k).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
        assert sort(got) == sort(brute.substring_dedup(rows, window))


# SimHash

def test_simhash(make, odd_rows):
    got = [(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in simhash.near_duplicates(make(odd_rows)).collect()]
    want = brute.components(odd_rows)
    assert [x[:2] for x in sort(got)] == [x[:2] for x in sort(want)] and sort(got) == sort(want)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_pairs(radius):
    rng = np.random.default_rng(radius)
    a = rng.integers(0, 1 << 63, 130, dtype=np.uint64)
    b = np.concatenate([a[:70], rng.integers(0, 1 << 63, 31, dtype=np.uint64)])
    for _ in range(3):
        b = b ^ (np.uint64(1) << rng.integers(0, 64, len(b), dtype=np.uint64)) * rng.integers(0, 2, len(b), dtype=np.uint64)
    i, j = simhash.near_pairs(a, b, radius)
    want = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)
    assert sorted(zip(i, j, strict=True)) == sorted(zip(*want, strict=True))


def test_simhash_hot_keys_lose_no_link(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = {int(x) for c in base for x in c ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64))}
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.node: r.root for r in components.connected_components(simhash.fingerprint_links(df, 3, hot=16)).collect()}
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in fps:
        for y in fps:
            if ((x ^ y) & (1 << 64) - 1).bit_count() <= 3:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    assert {x: got.get(x, x) for x in fps} == {x: find(x) for x in fps}


def test_components_of_a_path(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (7, 7), (None, 3)], "u long, v long")
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def test_keep_one(make, odd_rows):
    kept = simhash.keep_one(make(odd_rows))
    assert kept.columns == make(odd_rows).columns
    rows, want = [(r.doc_id, r.text) for r in kept.collect()], brute.components(odd_rows)
    groups = {c for _, _, c in want}
    assert {d for d, _ in rows} == groups and len(rows) == len(groups)


# Decontamination

def test_decontamination(spark, make, odd_rows):
    w = odd_rows[0][1].split()
    items = [(1, " ".join(w[40:70])), (2, " ".join(w[100:104]) + "!"), (3, None), (4, ""), (5, " ".join(w[5:15]) + " other"), (5, "of and"),
             (6, " ".join(w[200:209]) + " missing " + " ".join(w[210:219])), (7, odd_rows[9][1][:200].upper())]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, fp string")
    got = decontaminate.contamination(make(odd_rows), bench).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, len(r["items"]), brute.sha(",".join(r["items"])), r.n_hit > 0) for r in got]
    assert sort(got) == sort(brute.decontaminate(odd_rows, items))
    clean = {(r.doc_id, r.text) for r in decontaminate.drop_contaminated(make(odd_rows), bench).collect()}
    assert clean == {x for x, r in zip(odd_rows, brute.decontaminate(odd_rows, items), strict=True) if not r[5]}


def test_decontamination_without_prefilter(spark, make, odd_rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "PREFILTER_MAX", 0)
    items = [(1, " ".join(odd_rows[0][1].split()[40:70])), (2, "of and"), (3, odd_rows[6][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [r for r in odd_rows if len(r[1] or "") < 5000]
    got = [(r.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in decontaminate.contamination(make(rows), bench).collect()]
    assert sort(got) == sort([r[:4] for r in brute.decontaminate(rows, items)])


# Personal data

PII = [
    (1, "mail a.b+c@x-1.example.com, ip 10.0.0.255 and 1.2.3.4.5.6.7.8, bad 1.2.3.256"), (2, None), (3, ""),
    (4, "card 4111 1111 1111 1111 and 4111111111111112 and 4111-1111-1111-1111; +1 (319) 555-5132, +12, +1234567890123456"),
    (5, "é𝒳 x@y.z_q@w.v " * 50), (6, "@ . +1 5 9 0"), (7, "1" * 5000 + " " + "a" * 5000 + "@b"), (8, "000.000.0255.001 +44(20)7946-0958."),
    (9, "a@b.c.@d.e +1--2--3--4--5--6--7--8 4111 1111 1111 1111 2"), (1, "again a@b.co"), (None, "z@z.zz"),
]


def test_base_spans(make):
    found = pii.find_spans(make(PII).select("doc_id", "text"), None)
    got = [(r.doc_id, *(sum(x.k == k for x in r.base) for k in range(4)), r.t) for r in found.select("doc_id", "base", pii.as_text(found["base"]).alias("t")).collect()]
    assert sort(got) == sort([(*r[:5], r[6]) for r in brute.pii(PII)])


def test_added_spans_keep_base_ones(make):
    rows = PII + [(100 + i, f"call +1 (319) 555-{1000 + i} or 319 555 {1000 + i}, mail u{i}@h{i}.org, 10.0.{i}.1, 1.2.{i}") for i in range(60)]
    docs = make(rows).select("doc_id", "text")
    found = pii.find_spans(docs, pii.fit(docs)).collect()
    for r in found:
        assert set(r.base) <= set(r.spans) and r.spans == sorted(r.spans)


JOINED = [  # a text and the added spans; the first four are the joined runs of documents 1377, 7052, 46 and 1262 of sf0.1
    ("Des +1 (826) 555-4081 190.137.223.204 du", ["+1 (826) 555-4081"]), ("un. +1 (843) 555-7672 170.106.47.218 Et", ["+1 (843) 555-7672"]),
    ("mentle 7536784127813050 4845168114407329 aique", ["7536784127813050", "4845168114407329"]),
    ("Esanwh 2353820953013749 4550997810720808 thheed", ["4550997810720808"]),
    ("pay 4111 1111 1111 1111 4111-1111-1111-1111 now", ["4111 1111 1111 1111", "4111-1111-1111-1111"]),
    ("no 1234 4111 1111 1111 1111", ["4111 1111 1111 1111"]), ("call (319) 555-5132 today", ["(319) 555-5132"]), ("or 319 555 5132.", ["319 555 5132"]),
    ("+1 (826) 555-4081 4111111111111111", ["+1 (826) 555-4081", "4111111111111111"]), ("order 4111111111111112 in a12345678901", []),
]


def test_joined_personal_data_is_added(make):
    more = [(100 + i, f"call +1 (319) 555-{1000 + i} or 10.0.{i}.1, 4111 1111 1111 1111, order {4111111111111112 + 10 * i}, x{i}9876543"
             + f" or 319 555 {2000 + i}." * (i % 2)) for i in range(90)]  # the trees know layouts that the corpus shows
    more += [(200 + i, JOINED[4][0]) for i in range(20)]  # its "1111 1111 1111 4111" passes Luhn, but a dash goes on
    docs = make([(i, t) for i, (t, _) in enumerate(JOINED)] + more).select("doc_id", "text")
    found = {r.doc_id: r for r in pii.find_spans(docs, pii.fit(docs)).collect()}
    for i, (text, want) in enumerate(JOINED):
        added = sorted({(x.s, x.e) for x in found[i].spans} - {(x.s, x.e) for x in found[i].base})
        assert [text[s:e] for s, e in added] == want


LONG = [(1, "mail a.b@x.co now " * 3000), (2, "1.2.3.4 and 4111 1111 1111 1111 or +44 20 7946 0958, " * 400), (3, "x@y.zz\n" * 4000),
        (4, "9" * 30_000 + " u@v.w"), (5, "é𝒳 word, a@b.cd " * 2500), (6, ("w " * 3000 + "+1 (319) 555-5132 ") * 4), (7, "no data here " * 3000)]


def test_label_is_not_made_of_features(spark, make):
    """The trees are given none of the label's checks, and judge some proposals otherwise than these."""
    more = [(i, f"call +1 (319) 555-{1000 + i} now, or 10.0.{i}.1, 4111 1111 1111 1111, x{i}9876543 and id {i}19 555 2000 a") for i in range(90)]
    docs = make(more).select("doc_id", "text")
    assert not {"luhn", "parts", "form", "apart", "label"} & set(pii.FEATURES)
    model = pii.fit(docs)
    marked, name = pii._marked(docs)
    x = marked.selectExpr(f"explode({name}) AS p").selectExpr("explode(p.more) AS x")
    got = [(r.l, r.s) for r in x.select(x["x"]["label"].alias("l"), model.selects(x["x"]).alias("s")).collect()]
    assert any(s for _, s in got) and any(not s for _, s in got) and sum(s for l, s in got if l == 0) <= 0.05 * sum(s for _, s in got)


def test_long_texts_in_pieces(make):
    """Pieces give the places that the whole text has, and come together as the text."""
    docs = make(LONG).select("doc_id", "text")
    found = {r.doc_id: r for r in pii.find_spans(docs, None).select("doc_id", pii.as_text("base").alias("t")).collect()}
    assert all(found[r[0]].t == r[6] for r in brute.pii(LONG))
    for r in docs.select("doc_id", "text", pii.pieces(docs["text"]).alias("p")).collect():
        assert (len(r.p) > 1) == (r.doc_id != 4)   # digits alone have no place to cut
        assert "".join(x.t for x in r.p) == r.text and [x.at for x in r.p] == [sum(len(y.t) for y in r.p[:i]) for i in range(len(r.p))]
    out = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert out[1] == "mail <EMAIL> now " * 3000 and out[7] == LONG[6][1] and out[3] == "<EMAIL>\n" * 4000


def test_redaction(make):
    out = pii.redact(make(PII))
    assert out.columns == make(PII).columns
    text = {r.doc_id: r.text for r in out.collect() if r.doc_id in (2, 3, 4, 8)}
    assert text[2] is None and text[3] == "" and "+44" not in text[8]
    assert text[4].startswith("card <CARD> and 4111111111111112 and <CARD>; <PHONE>")


# Packing

def test_packed_ids(make, odd_rows):
    from tokenizers import Tokenizer

    rows = odd_rows + [(20, "İstanbul ΟΔΟΣ ｆｕｌｌ it's 12'34 <|endoftext|> é 日本語"), (21, "don't we'll 3.14 ½ a_b"), (22, "x" * 3000),
                       (23, "Plain <|endoftext|> and<|startoftext|>x <|EndOfText|>"), (24, "<|endoftext|>")]
    whole = Tokenizer.from_file(tokenizer())
    pieces = packing.pack_documents(make(rows).repartition(2), tokenizer(), packing.Limits(tokens=256, segments=8, loss=256), keep_ids=True).collect()
    by, seqs = {}, {}
    for p in pieces:
        by.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        seqs.setdefault(p.sequence_id, []).append(p)
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length > 0
    got = sort((k[0], b"".join(bytes(p.ids) for p in sorted(v, key=lambda p: p.start))) for k, v in by.items())
    want = {}
    for d, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 1]
        want.setdefault((d, len(ids)), []).append(np.array(ids, "<u4").tobytes())
    assert {(d, len(x)) for d, x in got} == {(d, 4 * n * len(v)) for (d, n), v in want.items()}
    for (d, n), v in want.items():
        if len(v) == 1:
            assert (d, v[0]) in got
    for s in seqs.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == list(np.cumsum([0] + [p.length for p in s])[:-1])
        assert sum(p.length for p in s) <= 256 and len(s) <= 8


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_file(tokenizer()), packing.WordIds(tokenizer())
    vocab = [t.removesuffix("</w>") for t in sorted(whole.get_vocab()) if t.isascii()][::7]
    texts = [" ".join(vocab[i:i + 50]) for i in range(0, len(vocab), 50)]
    texts += ["Éa ñÑ ß ÿ ŉ \x85 \xa0 x\x1cy", "it's (a-b)... 'TIS don't!'s 12'34", "a<|endoftext|>B <|startoftext|>", "\x1f \x1c", "w" * 200]
    for t in texts:
        assert np.frombuffer(words.encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_examples_within_limits(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(t), int(t * f)) for i, (t, f) in enumerate(zip(rng.integers(1, 700, 900), rng.random(900), strict=True))]
    limits = packing.Limits(tokens=1024, segments=6, loss=500)
    rows = [(i, t, min(x, 500)) for i, t, x in rows]
    size = {i: (t, x) for i, t, x in rows}
    out = packing.pack_examples(spark.createDataFrame(rows, "example_id long, tokens long, loss long").coalesce(1), limits).collect()
    assert sorted(r.example_id for r in out) == sorted(size)
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append(r.example_id)
    for s in seqs.values():
        assert len(s) <= 6 and sum(size[i][0] for i in s) <= 1024 and sum(size[i][1] for i in s) <= 500
    least = max(sum(t for t, _ in size.values()) / 1024, sum(x for _, x in size.values()) / 500, 150)
    assert len(seqs) <= 1.15 * least
    with pytest.raises(Exception, match="exceeds the limits"):
        packing.pack_examples(spark.createDataFrame([(1, 2000, 3)], "example_id long, tokens long, loss long"), limits).collect()


# Toxicity

def toxic_corpus(n=240):
    rows, labels = [], []
    for i in range(n):
        w, toxic = prose(60, 1000 + i).split(), i % 4 == 0
        for k in range(4 if toxic else 0):
            w.insert(7 + 11 * k, ["blockhead", "nitwit", "blockheads"][(i + k) % 3])
        rows.append((i, " ".join(w) + "."))
        labels.append((i, int(toxic), 1))
    return rows, labels


@pytest.fixture(scope="module")
def toxic_model(spark, make):
    rows, labels = toxic_corpus()
    return toxicity.fit(make(rows), spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))


def test_toxicity_held_out(make, toxic_model):
    w = prose(30, 5).split()
    bad = [w[:9] + [x] + w[9:20] + [x] + w[20:] + [x] for x in ("blockhead", "b.l.o.c.k.h.e.a.d", "blockxhead", "nitwit!", "NITWIT")]
    rows = [(i, " ".join(x)) for i, x in enumerate(bad)] + [(10 + i, prose(60, 50 + i)) for i in range(20)] + [(40, None), (41, ""), (42, "*** !!")]
    out = toxicity.score(make(rows), toxic_model)
    got = {r.doc_id: r[-1] for r in out.collect()}
    assert out.columns[:-1] == make(rows).columns and len(got) == len(rows)
    assert all(0 <= v <= 1 for v in got.values())
    assert min(got[i] for i in range(len(bad))) > max(v for i, v in got.items() if i >= 10)
    left = toxicity.drop_toxic(make(rows), toxic_model, 0.7)
    assert left.columns == make(rows).columns and {r.doc_id for r in left.collect()} >= set(range(10, 30)) | {40, 41, 42}


def test_toxicity_under_wide_gaps(make, toxic_model):
    w = prose(30, 5).split()
    bad = ["blxockxhead", "nxitwxit", "nixtwixt", "n1twit", "n i t w i t", "n. i. - t. w. i. t.", "b l o c k h e a d"]
    bad = [w[:9] + [x] + w[9:20] + [x] + w[20:] + [x] for x in bad]
    rows = [(i, " ".join(x)) for i, x in enumerate(bad)] + [(10 + i, prose(60, 50 + i)) for i in range(20)]
    got = {r.doc_id: r[-1] for r in toxicity.score(make(rows), toxic_model).collect()}
    assert min(got[i] for i in range(len(bad))) > max(v for i, v in got.items() if i >= 10)


def test_wide_gaps_have_values():
    from urbanlens.llm import text as X
    import pyarrow as pa

    marks = toxicity.Landmarks([b"idiot", b"stupid", b"moron"])
    texts = ["idxixot", "moxrxon", "ixdxixoxt", "mxoxrxoxn", "tr4sh idi0t", "st0pid", "i d i o t", "zzz i d i - o t idiotic", "x y", "", "a b idiot"]
    data, off = X.column_bytes(pa.array(texts))
    doc, values = toxicity._features(X.Words(data, off, 0, len(texts), X.byte_table("space")), marks, toxicity.letters())
    best = {int(d): v for d, v in zip(doc, values, strict=True)}
    assert {0, 1, 2, 3, 4, 5, 6, 7, 10} == set(best) - {8}
    assert best[0][0] > 0.2 and best[1][2] > 0.2 and best[6][0] == pytest.approx(1) and best[7][0] == pytest.approx(1)
    # A word's values do not depend on the words met before.
    alone = toxicity.Landmarks(marks.names)
    for i, t in enumerate(texts):
        data, off = X.column_bytes(pa.array([t]))
        _, v = toxicity._features(X.Words(data, off, 0, 1, X.byte_table("space")), alone, toxicity.letters())
        assert np.allclose(v, best[i] if i in best else 0) and len(v) == (i in best)


def test_toxicity_without_labels(spark, make):
    model = toxicity.fit(make([(1, "a b")]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r[-1] < 0.01 for r in toxicity.score(make([(1, "a b"), (2, None)]), model).collect()] == [True, True]


def test_kernel_equals_its_definition():
    marks = toxicity.Landmarks([b"idiot", b"stupid"])
    from urbanlens.llm import text as X
    import pyarrow as pa

    def plain(word, mark):
        def feats(s):
            c, f = toxicity.letters()[np.frombuffer(s, np.uint8)], {}
            for i in range(len(c)):
                for a, b in toxicity.STEPS:
                    if i + a + b < len(c):
                        t = (c[i], c[i + a], c[i + a + b])
                        f[t] = f.get(t, 0) + toxicity.DECAY ** (a + b + 1)
            return f
        x, y = feats(word), feats(mark)
        return min(1.0, sum(v * y.get(t, 0) for t, v in x.items()) / sum(v * v for v in y.values())) ** 2

    text = "an idiot stupidly idxiot studip idi0t"
    data, off = X.column_bytes(pa.array([text]))
    w = X.Words(data, off, 0, 1, X.byte_table("space"))
    at, values = marks.words(toxicity.letters()[w.data], w.start)
    got = {w.word(i): v for i, v in zip(at, values, strict=True)}
    for word in text.encode().split():
        want = np.array([plain(word, m) for m in marks.names])
        want[want < toxicity.FLOOR**2] = 0
        assert np.allclose(got.get(word, np.zeros(2)), want, atol=1e-5)


# Rules

def test_rule_counts(make, odd_rows):
    rows = odd_rows + [(30, "# a\n# a\n\n \n# a | b"), (31, "AB CD! é\n" * 60)]
    got = rules.judge(m := rules.measures(make(rows)), rules.thresholds(m, make([]).select("doc_id"))).collect()
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got]
    assert sort(got) == sort(brute.rule_counts(rows))


def test_binomial_tail():
    from math import comb

    for n, k, p in ((10, 3, 0.2), (50, 0, 0.01), (7, 7, 0.5), (200, 20, 0.05)):
        assert rules.binomial_tail(n, k, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(min(k, n) + 1)))


def test_false_rejections_are_limited(spark, make):
    rows = [(i, prose(60, i) + (" #" if i % 3 == 0 else "")) for i in range(1500)] + [(5000 + i, " # ".join(prose(60, 7000 + i).split())) for i in range(100)]
    labels = spark.createDataFrame([(i, int(i < 5000)) for i, _ in rows], "doc_id long, quality int")
    out = rules.quality_rules(make(rows), labels).collect()
    lost = sum(not r.kept and not r.base_failed for r in out if r.doc_id < 5000)
    assert lost <= 0.05 * 1500 and not any(r.kept for r in out if r.doc_id >= 5000)


# Sharding

def test_shards(make, odd_rows):
    rows = odd_rows + [(100 + i, prose(30 + i % 50, i)) for i in range(600)] + [(2000 + i, "copy of one text") for i in range(400)]
    out = sharding.pack_shards(make(rows), 4).collect()
    assert sort((r.doc_id, r.size, r.text_crc32) for r in out) == sort((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    size, slots = {}, {}
    for r in out:
        size[r.shard] = size.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(size) == {0, 1, 2, 3} and all(sorted(s) == list(range(len(s))) for s in slots.values())
    longest = max(len((t or "").encode()) for _, t in rows)
    assert max(v for s, v in size.items() if v < longest) <= 1.1 * min(size.values()) or longest < sum(size.values()) / 4
    assert len({r.shard for r in out if r.doc_id is not None and r.doc_id in (1, 2)}) == 1


# Hidden Markov model

def test_base_scores(make, odd_rows):
    rows = odd_rows + [(100 + i, prose(30, i)) for i in range(60)]
    out = hmm.score_texts(make(rows)).collect()
    got = sort((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert got == sort((*r[:5], round(r[5], 6)) for r in brute.unigrams(rows))
    assert all(np.isfinite(r.score) and r.score < 0 for r in out)


def test_forward_and_expected_counts_equal_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    k = 3
    start, move, emit = rng.random(k), rng.random((k, k)), rng.random((hmm.SYMBOLS, k))
    start, move, emit = start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0)
    chain = hmm.Chain(start, move, emit)
    texts = [[4, 9, 4, 7], [1], [2, 2, 5], [9, 9]]
    s, off = np.array(sum(texts, []), np.uint16), np.r_[0, np.cumsum([len(t) for t in texts])]
    rows = next(hmm._blocks(off))
    log, _ = chain.forward(s, off, rows, keep=False)
    a, b, c = np.zeros(k), np.zeros((k, k)), np.zeros((hmm.SYMBOLS, k))
    chain.expected(s, off, rows, a, b, c)
    wa, wb, wc = np.zeros(k), np.zeros((k, k)), np.zeros((hmm.SYMBOLS, k))
    for i, row in enumerate(rows):
        t, paths = texts[row], []
        for z in product(range(k), repeat=len(t)):
            p = start[z[0]] * np.prod([move[x, y] for x, y in zip(z, z[1:], strict=False)]) * np.prod([emit[o, x] for o, x in zip(t, z, strict=True)])
            paths.append((z, p))
        total = sum(p for _, p in paths)
        assert log[i] == pytest.approx(np.log(total))
        for z, p in paths:
            wa[z[0]] += p / total
            for x, y in zip(z, z[1:], strict=False):
                wb[x, y] += p / total
            for o, x in zip(t, z, strict=True):
                wc[o, x] += p / total
    assert np.allclose(a, wa) and np.allclose(b, wb) and np.allclose(c, wc)


def test_baum_welch_raises_the_likelihood(make):
    docs = make([(i, " ".join(x for j in range(15) for x in (f"a{(i + j) % 5}", f"b{(i * j) % 5}"))) for i in range(120)])
    total = [sum(r.score for r in hmm.score_texts(docs, hmm.Settings(states=3, start_rounds=0, rounds=n)).collect()) for n in (0, 2, 6)]
    assert total[0] < total[1] < total[2]


# Kneser-Ney classifier

def test_kneser_ney_is_a_distribution(make):
    table = quality.train(make([(i, prose(40, i)) for i in range(30)]))
    p = 10.0 ** table.astype(np.float64).reshape(-1, quality.SYMBOLS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_quality(spark, make, odd_rows):
    rows = [(i, prose(60, i)) for i in range(300)] + [(1000 + i, "".join(chr(33 + (7 * i + 5 * j) % 60) for j in range(300))) for i in range(20)]
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality.classify(make(rows), labels).collect()}
    assert not any(got[1000 + i] for i in range(20)) and sum(got[i] for i in range(300)) >= 285
    out = quality.classify(make(odd_rows), labels).collect()
    assert len(out) == len(odd_rows) and not any(r.kept for r in out if not r.n_bytes)


# Nulls beside the text

def test_nulls_in_other_columns(spark, make):
    rows = [(i, prose(60, i)) for i in range(40)] + [(None, prose(60, 3)), (None, None)]
    docs = make(rows, lang=None)
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(20)] + [(None, 1, 1), (3, None, None), (4, None, 1), (4, 0, 1)],
                                   "doc_id long, toxic int, quality int")
    assert rules.quality_rules(docs, labels).count() == quality.classify(docs, labels).count() == len(rows)
    assert toxicity.score(docs, toxicity.fit(docs, labels)).count() == len(rows)
    bench = spark.createDataFrame([(None, rows[0][1]), (7, None), (None, None)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert got[0] == (60, []) and got[1] == (0, [])


# Empty tables

def test_empty_tables(spark, make):
    docs, labels = make([]), spark.createDataFrame([], "doc_id long, toxic int, quality int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for df in (substring_dedup.dedup_substrings(docs), simhash.near_duplicates(docs), simhash.keep_one(docs), decontaminate.contamination(docs, bench),
               decontaminate.drop_contaminated(docs, bench), pii.find_spans(docs.select("doc_id", "text"), pii.fit(docs)), pii.redact(docs),
               packing.pack_documents(docs, tokenizer()), toxicity.score(docs, toxicity.fit(docs, labels)), rules.quality_rules(docs, labels),
               sharding.pack_shards(docs, 24), hmm.score_texts(docs), quality.classify(docs, labels)):
        assert df.count() == 0
    some = make([(1, "a b c"), (2, None)])
    assert all(r.n_hit == 0 for r in decontaminate.contamination(some, bench).collect())
    assert quality.classify(some, labels).count() == rules.quality_rules(some, labels).count() == 2
