"""Personal data by candidate gradient boosting, in DataFrame functions only.

Strict patterns with their checks (Luhn, part and digit ranges) give the base
spans. Wide generators propose more spans: addresses, dotted runs, and every
stretch of whole digit groups in a run of digits and separators, so data
joined to other digits is proposed too; proposals may overlap. Those that fail
the exact check of their kind (Luhn, digit counts, part ranges) go at once. The
others have format features (digits, groups, separators, ...) and context
features (the characters and hashed words before and after, the place in the
line); a weak label, made of none of them, says whether the layout is a usual
one of the kind and the span not part of something longer. Proposals are
counted per feature cell over the whole corpus, so training sees a table
bounded by the caps on the features. Boosted trees are fitted on the cells. Each kind's threshold is
the lowest that keeps the stated precision, on all its proposals and on those
that touch no base span, scored by trees that did not see their document.
The trees are then written as one column expression: a text's spans are
found, scored and selected in its own row, without a shuffle or Python.

Defined cases: null or empty text has no span; offsets are code points, end
exclusive; repeated rows are handled one by one; without proposals of both
labels (an empty table, say), or too few of a kind to tell, only base spans
are returned; an added span inside another added one is left out; redaction keeps
all columns and leaves a null text null.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.text import fresh, stored

KINDS = ("email", "ip", "card", "phone")
# Possessive forms of the patterns: the same matches, without backtracking.
# A match starts where the last one ended or not inside a run of its first class.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": None, "card": None, "phone": "+"}
PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

GENERATORS = {
    "address": r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++",
    "dotted": r"(?:\G|(?<![0-9.]))[0-9]++(?:\.[0-9]++){2,}+",
    "digits": r"[+(]*+[0-9][\x20().0-9-]{5,}[0-9]",
}
#: Layout of the digits and what surrounds them; the label's own checks are none of these.
FEATURES = ("gen", "digits", "size", "breaks", "plus", "paren", "dots", "letters", "groups", "head", "tail", "widest", "mixed",
            "before", "after", "near_before", "near_after", "word_before", "word_after", "line")
#: Words beside a proposal are told apart by a hash below this.
WORDS = 8
#: Documents fall into this many parts by the crc32 of the id; each is held out once for the thresholds.
HOLDOUT = 5
#: What a proposal of each kind must look like, besides the digit counts and Luhn: cards are unbroken or in fours;
#: phones are international, 3-3-4 without the country code, or begin with 0 and have one kind of separator.
FORMS = {
    "email": r"^[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+$",
    "ip": rf"^{PART}(?:\.{PART}){{3}}$",
    "card": r"^(?:[0-9]{16,19}|[0-9]{4}([\x20-])[0-9]{4}(?:\1[0-9]{4}){2}(?:\1[0-9]{1,3})?)$",
    "phone": r"^(?:\+\(?(?:[17](?:[^0-9]*[0-9]){10}|[2-689](?:[^0-9]*[0-9]){7,14})"
             r"|(?:1[\x20.-])?(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[\x20.-])[2-9][0-9]{2}[\x20.-][0-9]{4}"
             r"|(?=(?:[^0-9]*[0-9]){9,11}$)\(?0[0-9]{1,4}\)?([\x20.-])[0-9]{2,4}(?:\1[0-9]{2,4}){1,3})$",
}
#: Code points of a piece of a long text, at least.
PIECE = 4096
#: Digit groups and digits of a stretch of a run, at most: no kind has more digits.
MOST = 19


@dataclass(frozen=True)
class Settings:
    rounds: int = 8
    depth: int = 3
    precision: float = 0.95
    seed: int = 7


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        d == "", 0).otherwise((d.cast("int") * (1 + i % 2)) - F.when((i % 2 == 1) & (d.cast("int") > 4), 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def pieces(text: Column) -> Column:
    """array<struct<at, t>>: a text in pieces of some ``PIECE`` code points and their places.

    Cuts are after a line break, or between white space and a character before it
    that is no digit and none that may join digits; no pattern or generator
    reaches across either, and what is looked at beside a span is the same. So
    the work on a piece is bounded by its length, and that on a text grows with
    its own (a text without such places stays whole).
    """
    cut = rf"(?s).{{{PIECE},}}?(?:\n|[^\s0-9().+-](?=\s))|.+"
    parts = F.when(F.length(text) > 2 * PIECE, F.regexp_extract_all(text, F.lit(cut), F.lit(0))).otherwise(F.array(text))
    placed = F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,t:string>>").alias("out")),
        lambda acc, t: F.struct((acc["at"] + F.length(t)).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), t.alias("t")))).alias("out")))
    return F.when(text.isNotNull(), placed["out"]).otherwise(F.array().cast("array<struct<at:int,t:string>>"))


def _found(text: Column, pattern: str) -> Column:
    """Matches as (s, e, m): their places follow from the lengths of the text between them."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    place = F.aggregate(
        F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, F.size(matches)).alias("g")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out")),
        lambda acc, x: _step(acc, x))
    return F.when(F.size(matches) > 0, place["out"]).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def _step(acc: Column, x: Column) -> Column:
    s = acc["at"] + F.length(x["g"])
    e = s + F.length(x["m"])
    return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        d = _digits(m)
        return F.length(d).between(16, 19) & luhn(d)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """array<struct<s, e, m>> of one kind; null text gives an empty array."""
    wanted = F.filter(_found(text, PATTERNS[kind]), lambda x: _valid(kind, x["m"]))
    has = text.contains(NEEDS[kind]) if NEEDS[kind] else text.rlike("[0-9]")
    return F.when(has, wanted).otherwise(F.array().cast("array<struct<s:int,e:int,m:string>>"))


def _char(c: Column) -> Column:
    return F.when((c == "") | c.rlike(r"^\s$"), 0).when(c.rlike("^[A-Za-z0-9]$"), 1).when(c.rlike(r"^[\x00-\x7F]$"), 2).otherwise(3)


def _stretches(runs: Column) -> Column:
    """Every stretch of whole digit groups of each run (s, e, m), with the + and ( before it."""
    def of(run: Column) -> Column:
        def ends(groups: Column, i: Column) -> Column:
            s = F.get(groups, i)["s"]
            s = s - F.length(F.regexp_extract(F.substring(run["m"], F.greatest(s - 1, F.lit(1)), F.least(s, F.lit(2))), r"\+?\(?$", 0))
            last = F.least(i + MOST - 1, F.size(groups) - 1)
            return F.transform(F.sequence(i, last), lambda j: F.struct(
                (run["s"] + s).alias("s"), (run["s"] + F.get(groups, j)["e"]).alias("e"), F.substring(run["m"], s + 1, F.get(groups, j)["e"] - s).alias("m")))

        # The array of one element gives the groups a name.
        return F.get(F.transform(F.array(_found(run["m"], "[0-9]++")), lambda groups: F.flatten(
            F.transform(F.sequence(F.lit(0), F.size(groups) - 1), lambda i: ends(groups, i)))), F.lit(0))

    return F.filter(F.flatten(F.transform(runs, of)), lambda x: F.length(_digits(x["m"])).between(7, MOST))


def _sound(gen: int, m: Column) -> Column:
    """Whether a proposal can be of its kind at all: the exact checks, before any judgement of layout or context."""
    if gen < 2:
        return m.rlike(FORMS[KINDS[gen]])
    d = _digits(m)
    return F.when((F.length(d) >= 13) & ~m.contains("+"), F.length(d).between(16, 19) & luhn(d)).otherwise(F.length(d) <= 15)


def _usual(gen: int, m: Column, d: Column) -> Column:
    """Whether the layout is a usual one of the kind (the label's first half)."""
    if gen < 2:
        return F.lit(True)
    return F.when((F.length(d) >= 13) & ~m.contains("+"), m.rlike(FORMS["card"])).otherwise(m.rlike(FORMS["phone"]))


def _apart(text: Column, x: Column) -> Column:
    """Whether a proposal is not part of a longer word or number; a space, or the end of a sentence, parts them."""
    before = F.substring(text, F.greatest(x["s"] - 1, F.lit(1)), F.least(x["s"], F.lit(2)))
    return ~before.rlike(r"[A-Za-z0-9.+@]$|[0-9)][(-]$") & ~F.substring(text, x["e"] + 1, F.lit(2)).rlike(r"^(?:[A-Za-z0-9@]|[.)(-]+[0-9])")


def _near(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike("^[0-9]$"), 1).when(c.rlike(r"^\p{L}$"), 2).when(c.rlike(r"^[().+-]$"), 3).otherwise(4)


def _word(w: Column) -> Column:
    return F.when(w == "", -1).otherwise(F.pmod(F.xxhash64(F.lower(w)), F.lit(WORDS)).cast("int"))


def _features(text: Column, gen: int, x: Column) -> Column:
    """Features of a proposal, and ``label``: a usual layout that is not part of something longer."""
    m, d = x["m"], _digits(x["m"])
    left = F.substring(text, F.greatest(x["s"] - 23, F.lit(1)), F.least(x["s"], F.lit(24)))
    right = F.substring(text, x["e"] + 1, F.lit(24))
    groups = F.filter(F.split(m, "[^0-9]+"), lambda g: g != "")
    longest = F.aggregate(groups, F.lit(0), lambda a, g: F.greatest(a, F.length(g)))
    size = lambda g, most: F.least(F.length(F.coalesce(g, F.lit(""))), F.lit(most))
    kinds = sum((m.contains(c).cast("int") for c in " .-("), F.lit(0))
    return F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.lit(gen).alias("gen"),
        F.least(F.length(d), F.lit(24)).alias("digits"), F.least((F.length(m) / 4).cast("int"), F.lit(10)).alias("size"),
        F.least(F.length(F.regexp_replace(m, r"[^\x20-]", "")), F.lit(4)).alias("breaks"),
        m.contains("+").cast("int").alias("plus"), F.when(m.contains("("), 1).when(m.contains(")"), 2).otherwise(0).alias("paren"),
        F.least(F.length(F.regexp_replace(m, r"[^.]", "")), F.lit(4)).alias("dots"), m.rlike("[A-Za-z]").cast("int").alias("letters"),
        F.least(F.size(groups), F.lit(6)).alias("groups"), size(F.get(groups, F.lit(0)), 6).alias("head"),
        size(F.get(groups, F.size(groups) - 1), 6).alias("tail"), F.least(longest, F.lit(17)).alias("widest"), kinds.alias("mixed"),
        _char(F.regexp_extract(left, r"(?s).?$", 0)).alias("before"), _char(F.substring(right, 1, 1)).alias("after"),
        _near(F.regexp_extract(left, r"(\S)\s*$", 1)).alias("near_before"), _near(F.regexp_extract(right, r"^\s*(\S)", 1)).alias("near_after"),
        _word(F.regexp_extract(left, r"(\p{L}+)[^\p{L}]*$", 1)).alias("word_before"), _word(F.regexp_extract(right, r"^[^\p{L}]*(\p{L}+)", 1)).alias("word_after"),
        F.when(left.rlike(r"(^|\n)[^\n\S]*$"), 1).otherwise(0).alias("line"),
        (_usual(gen, m, d) & _apart(text, x)).cast("double").alias("label"))


def proposals(text: Column) -> Column:
    """array<struct<s, e, features, label>> of every generator, sound ones only; the spans may overlap."""
    def of(gen: int, pattern: str) -> Column:
        found = _found(text, pattern)
        found = F.filter(_stretches(found) if gen == 2 else found, lambda x: _sound(gen, x["m"]))
        return F.transform(found, lambda x: _features(text, gen, x))

    found = [of(g, p) for g, p in enumerate(GENERATORS.values())]
    return F.when(text.rlike("[0-9@]"), F.concat(*found))


def _marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the pieces of the text: their base spans (k, s, e) and proposals, by places in the piece."""
    cut, marked = fresh(docs, "_cut", "_pieces")

    def of_kind(t: Column, kind: int) -> Column:
        return F.transform(base_spans(t, KINDS[kind]), lambda x: F.struct(F.lit(kind).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    def mark(p: Column) -> Column:
        base = F.concat(*[of_kind(p["t"], kind) for kind in range(len(KINDS))])
        return F.struct(p["at"].alias("at"), p["t"].alias("t"), base.alias("base"), proposals(p["t"]).alias("more"))

    # Cut in a projection of its own: what it gives is read once per kind and generator.
    docs = docs.withColumn(cut, pieces(F.col("text").cast("string")))
    return docs.withColumn(marked, F.transform(cut, mark)).drop(cut), marked


@dataclass(frozen=True)
class Model:
    score: object  # struct of features -> probability
    thresholds: tuple[float, ...]  # of each kind

    def selects(self, x: Column) -> Column:
        return self.score(x) >= F.get(F.array(*[F.lit(t) for t in self.thresholds]), _kind(x))


def _touches(x: Column, spans: Column) -> Column:
    """Whether any of the spans overlaps x."""
    return F.exists(spans, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"]))


def _boosted(cells: DataFrame, settings: Settings):
    """Trees fitted on cells, as a function from a struct of features to a probability; None without both labels."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    if cells.select("label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(cells).select("features", "label", "n")
    trees = GBTClassifier(maxIter=settings.rounds, maxDepth=settings.depth, weightCol="n", seed=settings.seed).fit(data)
    forest = [(w, _tree(t._java_obj.rootNode())) for w, t in zip(trees.treeWeights, trees.trees, strict=True)]

    def score(x: Column) -> Column:
        margin = reduce(lambda a, b: a + b, [F.lit(w) * _expr(t, x) for w, t in forest])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))

    return score


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Boosted trees over the corpus's cells, and each kind's threshold from the parts held out in turn."""
    slim = docs.select("doc_id", "text").filter(F.col("text").rlike("[0-9@]"))
    marked, name = _marked(slim)
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(HOLDOUT))
    x = F.col("x")
    # A row a piece before a row a proposal, which carries the base spans beside it.
    cells = (marked.select(part.alias("part"), F.explode(name).alias("p")).select("part", F.col("p.base").alias("b"), F.explode("p.more").alias("x"))
             .select("part", (~_touches(x, F.col("b"))).alias("free"), *[x[f].alias(f) for f in (*FEATURES, "label")])
             .groupBy("part", "free", *FEATURES, "label").agg(F.count("*").cast("double").alias("n")))
    # Counted in as many tasks as there are partitions; the few cells left (bounded by the caps on the features) are then read as one.
    cells = stored(cells, "pii-cells").coalesce(1)
    score = _boosted(cells, settings)
    if score is None:
        return None
    parts = [(i, _boosted(cells.filter(F.col("part") != i), settings)) for i in range(HOLDOUT)]
    unseen = F.coalesce(*[F.when(F.col("part") == i, s(F.struct(*FEATURES))) for i, s in parts if s] or [F.lit(None).cast("double")])
    free, n = F.col("free").cast("double"), F.col("n")
    by_score = (cells.select(F.round(unseen, 6).alias("p"), _kind(F.struct(*FEATURES)).alias("kind"), "label", (n * free).alias("free"), "n")
                .filter("p >= 0.5").groupBy("kind", "p")
                .agg(*[F.sum(c).alias(a) for a, c in (("n", n), ("hits", n * F.col("label")), ("free", F.col("free")), ("found", F.col("free") * F.col("label")))])
                .orderBy("kind", F.desc("p")).collect())
    thresholds = []
    for k in range(len(KINDS)):
        threshold, n, hits, free, found = 2.0, 0.0, 0.0, 0.0, 0.0
        for r in by_score:
            if r["kind"] == k:
                n, hits, free, found = n + r["n"], hits + r["hits"], free + r["free"], found + r["found"]
                # Three failures more than seen, for small counts; those that could be added are a few of them.
                if hits >= settings.precision * (n + 3) and found >= settings.precision * free:
                    threshold = r["p"] - 1e-6
        thresholds.append(threshold)
    return Model(score, tuple(thresholds))


def _tree(node):
    """A fitted tree as nested tuples (feature, cut, left, right) or a number."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    return node.split().featureIndex(), float(node.split().threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def _expr(tree, x: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    f, cut, left, right = tree
    return F.when(x[FEATURES[f]] <= cut, _expr(left, x)).otherwise(_expr(right, x))


def _kind(x: Column) -> Column:
    """Index of a proposal's kind."""
    return F.when(x["gen"] < 2, x["gen"]).when((x["digits"] >= 13) & (x["plus"] == 0), 2).otherwise(3)


def count_kind(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == kind)).cast("long")


def _chosen(docs: DataFrame, model: Model | None) -> tuple[DataFrame, str]:
    """``docs`` with pieces (at, t, base, spans): base spans and, in ``spans``, the selected proposals with them."""
    marked, name = _marked(docs)
    if model is None:
        keep = lambda q: F.struct(q["at"].alias("at"), q["t"].alias("t"), q["base"].alias("base"), q["base"].alias("spans"))
        return marked.withColumn(name, F.transform(name, keep)), name

    def select(q: Column) -> Column:
        new = F.filter(F.coalesce(q["more"], F.array()), lambda x: ~_touches(x, q["base"]) & model.selects(x))
        new = F.transform(new, lambda x: F.struct(_kind(x).alias("k"), x["s"].alias("s"), x["e"].alias("e")))
        return F.struct(q["at"].alias("at"), q["t"].alias("t"), q["base"].alias("base"), new.alias("new"))

    def widest(q: Column) -> Column:
        inside = lambda x: F.exists(q["new"], lambda y: (y["s"] <= x["s"]) & (x["e"] <= y["e"]) & (y["e"] - y["s"] > x["e"] - x["s"]))
        more = F.filter(q["new"], lambda x: ~inside(x))
        return F.struct(q["at"].alias("at"), q["t"].alias("t"), q["base"].alias("base"), F.array_distinct(F.concat(q["base"], more)).alias("spans"))

    # One projection each, so that a lambda reads what the one before has made.
    marked = marked.withColumn(name, F.transform(name, select))
    return marked.withColumn(name, F.transform(name, widest)), name


def _whole(pieces_of: str, field: str) -> Column:
    """Spans of all pieces by places in the text, sorted by kind and start."""
    moved = F.transform(pieces_of, lambda q: F.transform(q[field], lambda x: F.struct(
        x["k"].alias("k"), (x["s"] + q["at"]).alias("s"), (x["e"] + q["at"]).alias("e"))))
    return F.array_sort(F.flatten(moved))


def find_spans(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: array<struct<k (index of the kind), s, e>>, sorted by kind and start.

    ``spans`` holds the base spans and the selected proposals that touch none of them nor lie in one another.
    """
    found, name = _chosen(docs, model)
    return found.withColumns({"base": _whole(name, "base"), "spans": _whole(name, "spans")}).drop(name)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with every selected span replaced by its kind in angle brackets; all columns kept.

    Overlapping spans are replaced as one, named after the first.
    """
    found, name = _chosen(docs, fit(docs, settings))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def replace(q: Column) -> Column:
        ordered = F.array_sort(F.transform(q["spans"], lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
        built = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, x: F.when(
            x["s"] >= acc["at"], F.struct(x["e"].alias("at"), F.concat(acc["out"], F.substring(q["t"], acc["at"] + 1, x["s"] - acc["at"]), F.get(names, x["k"])).alias("out"))
        ).otherwise(F.struct(F.greatest(acc["at"], x["e"]).alias("at"), acc["out"].alias("out"))),
            lambda acc: F.concat(acc["out"], F.substring(q["t"], acc["at"] + 1, F.length(q["t"]))))
        return F.when(F.size(q["spans"]) > 0, built).otherwise(q["t"])

    text = F.array_join(F.transform(name, replace), "")
    return found.withColumn("text", F.when(F.col("text").isNotNull(), text)).select(*[f"`{c}`" for c in docs.columns])
