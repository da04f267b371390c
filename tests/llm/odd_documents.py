"""Fixtures of the document operators: texts and rows that hold every odd case."""

import random

import pytest

SF = "/root/testdata/sf0.001"

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def make_text(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 7))) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + 12]) for i in range(0, n, 12))


@pytest.fixture(scope="session")
def texts():
    """Plain, copied, near-copied, short and odd texts."""
    rng = random.Random(5)
    plain = [make_text(rng, rng.randint(60, 160)) for _ in range(40)]
    near = []
    for t in plain[:6]:
        for k in range(4):
            words = t.split(" ")
            words[rng.randrange(len(words))] = f"new{k}"
            near.append(" ".join(words))
    odd = [None, "", " \n\t ", "one", "one two", "ONE two", "\x00 \x85 \xa0", "###", make_text(rng, 60_000), "ä ö ü ß", "\n".join(["same line here"] * 30)]
    return plain + near + plain[3:6] * 2 + odd


@pytest.fixture(scope="session")
def docs(spark, texts):
    """``documents`` with nulls in any column, repeated rows and further columns with names that operators use."""
    rows = [(i, t, ["en", "de", None][i % 3], [None, "s1", "s2", "é"][i % 4], None if t is None else len(t), 0.5, "x", [1])
            for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, "no id here", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, Kept string, row array<int>").coalesce(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
