from __future__ import annotations

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id long, `key` string, fp string, score string, base string, spans string, _id int, row int, size int, g string, rule string")


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (id, text), with further columns whose names the operators use themselves."""
    def build(rows, lang="en"):
        return spark.createDataFrame([(d, t, lang, "s", len(t or ""), 1, "k", "f", "x", "b", "p", 3, 4, 5, "g", "r") for d, t in rows], SCHEMA)

    return build


WORDS = "the of and alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau phi chi psi omega".split()


def prose(n, seed):
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (str(r.randrange(30)) if r.random() < 0.4 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, one very long text, copies, near copies, ties and repeated rows."""
    a, b, c = prose(300, 1), prose(120, 2), prose(60, 3)
    w = b.split()
    near = " ".join(w[:60] + ["changed"] + w[61:])
    return [
        (1, a), (2, a), (2, a), (3, None), (4, ""), (5, " \t\n "), (6, b), (7, near), (8, "A  word"), (9, c + "\n" + c + "\n" + c),
        (10, prose(20000, 4)), (None, a), (None, c), (11, c + " " + b + "\r\n" + c), (12, "É ß ñ 　 \x1f x y " + c), (13, "same same " * 200),
        (14, prose(49, 5)), (15, prose(50, 5)), (16, prose(50, 5) + " end"), (17, c.upper()),
    ]
