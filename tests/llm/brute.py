"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def simhash(text, shingle=3):
    w = SPACE_WORDS.findall((text or "").translate(LOWER))
    if not w:
        return 0
    grams = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows, radius=3, shingle=3):
    """{(id, text)} -> component id, over all pairs."""
    fp = [simhash(t, shingle) for _, t in rows]
    kinds = sorted(set(fp))
    root = {f: f for f in kinds}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for (d, _), f in zip(rows, fp, strict=True):
        r = find(f)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(d, f"{f:016x}", least.get(find(f))) for (d, _), f in zip(rows, fp, strict=True)]


def decontaminate(rows, items, n=10):
    wins = {}
    for item, text in items:
        w = ALNUM_WORDS.findall((text or "").translate(LOWER))
        if w:
            for i in range(max(1, len(w) - n + 1)):
                wins.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = {len(x) for x in wins}
    out = []
    for d, text in rows:
        w = ALNUM_WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for s in sizes:
            for i in range(len(w) - s + 1):
                if (g := tuple(w[i:i + s])) in wins:
                    hit.update(range(i, i + s))
                    found |= wins[g]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii(rows):
    out = []
    for doc, text in rows:
        spans, counts = [], []
        for kind, pattern in BASE:
            n = 0
            for m in re.finditer(pattern, text or ""):
                digits = re.sub("[^0-9]", "", m.group())
                ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else 0,
                      "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
                if ok:
                    spans.append(f"{kind}:{m.start()}:{m.end()}")
                    n += 1
            counts.append(n)
        out.append((doc, *counts, sha(",".join(spans)), ",".join(spans)))
    return out


def substring_dedup(rows, window=50):
    words = [SPACE_WORDS.findall(t or "") for _, t in rows]
    ids = [(1 << 63) - 1 if d is None else d for d, _ in rows]
    first = {}
    for d, w in zip(ids, words, strict=True):
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            first[g] = min(d, first.get(g, d))
    out = []
    for (doc, _), d, w in zip(rows, ids, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def rule_counts(rows):
    out = []
    for doc, text in rows:
        text = text or ""
        w = SPACE_WORDS.findall(text)
        tri = {}
        for i in range(len(w) - 2):
            tri.setdefault(tuple(w[i:i + 3]), []).append(i)
        rep = {i + k for at in tri.values() if len(at) > 1 for i in at for k in range(3)}
        lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
        out.append((doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep),
                    len(w) < 50 or 100 * len(rep) > 50 * len(w)))
    return out


def unigrams(rows):
    """(doc, held out, tokens, known, N, base score)."""
    import math
    import zlib
    from collections import Counter

    texts = [(d, [*SPACE_WORDS.findall((t or "").translate(LOWER)), None]) for d, t in rows]
    held = [d is None or zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    c = Counter(w for (_, ws), h in zip(texts, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(d, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
            for (d, ws), h in zip(texts, held, strict=True)]


def runs(s, min_words=24, min_periods=3):
    """(start, length, period) of all runs, by comparing every pair of places a period apart."""
    out = []
    for q in range(1, len(s) // min_periods + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            a, e = i, j + q
            if j > i and e - a >= max(min_words, min_periods * q):
                if not any(all(s[x] == s[x + r] for x in range(a, e - r)) for r in range(1, q)):
                    out.append((a, e - a, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rows):
    import zlib
    from fractions import Fraction

    out = []
    for doc, text in rows:
        w = SPACE_WORDS.findall(text or "")
        h = None if doc is None else zlib.crc32(str(doc).encode())
        if w and h is not None and h % 10 == 0:
            g, n, original = h // 10, len(w), w[:]
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [original[i] if i < a else original[a + (i - a) % p] for i in range(n)]
        found = runs(w)
        top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {x for s, m, q in found for x in range(s + q, s + m)}
        best = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
        out.append((doc, len(found), *best, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
                    sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def filter_audit(rows, labels):
    """rows (doc_id, text, lang); labels (doc_id, quality, toxic)."""
    from itertools import permutations

    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    late = 1 << 63
    least = {}
    for d, text, _ in rows:
        least[text or ""] = min(late if d is None else d, least.get(text or "", late))
    parts = {}
    for d, text, lang in rows:
        t = text or ""
        w = SPACE_WORDS.findall(t)
        fails = {f for f, bad in {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": (late if d is None else d) > least[t]}.items() if bad}
        parts.setdefault(lang or "", []).append((fails, d in good, d in toxic))
    out = []
    for part, docs in parts.items():
        mine, shapley = [], {}
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                before = set(order[:step])
                here = [x for x in docs if f in x[0] and not x[0] & before]
                shapley[f] = shapley.get(f, 0) + len(here)
                mine.append((part, "".join(order), step + 1, sum(not x[0] & (before | {f}) for x in docs), len(here),
                             sum(f in x[0] and bool(x[0] & before) for x in docs), sum(x[0] == {f} for x in docs),
                             sum(x[1] for x in here), sum(x[2] for x in here), f))
        out += [(*r[:-1], shapley[r[-1]]) for r in mine]
    return out


def rule_verdicts(rows, good, risk=0.05, error=0.05, bins=100):
    """{doc: kept} of (doc, text, lang), with cutoffs from the distinct texts of ``good`` documents, in whole numbers."""
    import math
    from fractions import Fraction

    rules = ("symbols", "dup_lines", "repeats", "capitals", "marks", "long_words")

    def measure(text):
        text = text or ""
        (_, n, chars, symbols, dups, repeats, failed), = rule_counts([(0, text)])
        lines = sum(bool(SPACE_WORDS.search(x)) for x in text.split("\n"))
        upper, marks = len(re.findall("[A-Z]", text)), text.count("!")
        # The double that the rule compares, as a cutoff may lie on a rounded value.
        values = (symbols / max(n, 1), dups / max(lines, 1), repeats / max(n, 1), upper / max(chars, 1), marks / max(n, 1), chars / max(n, 1) / 40)
        return [min(math.ceil(v * float(bins)), bins) for v in values], failed

    seen, known = set(), {}
    measured = [(d, lang, t or "", *measure(t)) for d, t, lang in rows]
    for d, lang, t, b, _ in measured:
        if d in good and (lang, t) not in seen:
            seen.add((lang, t))
            known.setdefault(lang, []).append(b)
    p = Fraction(str(risk)) / len(rules)
    level = Fraction(str(error)) / (len(rules) * max(1, len(known)))
    cuts = {}
    for lang, docs in known.items():
        n = len(docs)
        for r in range(len(rules)):
            cut = bins
            for b in range(bins, -1, -1):
                k = sum(x[r] > b for x in docs)
                tail = sum(Fraction(math.comb(n, i)) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
                if tail > level:
                    break
                cut = b
            cuts[lang, r] = cut
    return [(d, failed, not failed and all(b[r] <= cuts.get((lang, r), bins) for r in range(len(rules)))) for d, lang, _, b, failed in measured]


def kneser_ney(texts, symbol, symbols, order):
    """P(symbol | the order - 1 before it) as a function of a tuple of symbols; ``symbol``: of each byte value."""
    counts = {}
    for t in texts:
        s = [0] * (order - 1) + [int(symbol[x]) for x in (t or "").encode()]
        for i in range(len(s) - order + 1):
            g = tuple(s[i:i + order])
            counts[g] = counts.get(g, 0) + 1
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        levels[n] = {}
        for g in levels[n + 1]:
            levels[n][g[1:]] = levels[n].get(g[1:], 0) + 1
    cuts, sums = {}, {}
    for n, level in levels.items():
        k = [sum(c == i for c in level.values()) for i in range(5)]
        y = k[1] / (k[1] + 2 * k[2]) if k[1] + k[2] else 0.5
        cuts[n] = [0] + [min(max(i - (i + 1) * y * k[i + 1] / k[i], 0.1), i - 0.1) if k[i] and k[i + 1] else 0.5 for i in (1, 2, 3)]
        for g, c in level.items():
            total, spared = sums.get(g[:-1] + (n,), (0, 0))
            sums[g[:-1] + (n,)] = total + c, spared + cuts[n][min(c, 3)]

    def p(g):
        n = len(g)
        if not n:
            return 1 / symbols
        below = p(g[1:])
        if g[:-1] + (n,) not in sums:
            return below
        total, spared = sums[g[:-1] + (n,)]
        c = levels[n].get(g, 0)
        return (c - cuts[n][min(c, 3)]) / total + spared / total * below

    return p


def byte_kneser_ney(texts, order, lowest):
    """P(byte | the order - 1 before it) as a function of a tuple of bytes; ``lowest``: P of the whole tuple's last byte under the model below two bytes."""
    counts = {}
    for t in texts:
        s = b" " * (order - 1) + (t or "").encode()
        for i in range(len(s) - order + 1):
            counts[s[i:i + order]] = counts.get(s[i:i + order], 0) + 1
    levels = {order: counts}
    for n in range(order - 1, 0, -1):
        levels[n] = {}
        for g in levels[n + 1]:
            levels[n][g[1:]] = levels[n].get(g[1:], 0) + 1
    cuts, sums = {}, {}
    for n in range(2, order + 1):
        k = [sum(c == i for c in levels[n].values()) for i in range(5)]
        y = k[1] / (k[1] + 2 * k[2]) if k[1] + k[2] else 0.5
        cuts[n] = [0] + [min(max(i - (i + 1) * y * k[i + 1] / k[i], 0.1), i - 0.1) if k[i] and k[i + 1] else 0.5 for i in (1, 2, 3)]
        for g, c in levels[n].items():
            total, spared = sums.get(g[:-1], (0, 0))
            sums[g[:-1]] = total + c, spared + cuts[n][min(c, 3)]

    def p(gram):
        out = lowest(gram, levels[1])
        for n in range(2, order + 1):
            g = gram[-n:]
            if g[:-1] in sums:
                total, spared = sums[g[:-1]]
                c = levels[n].get(g, 0)
                out = (c - cuts[n][min(c, 3)]) / total + spared / total * out
        return out

    return p
