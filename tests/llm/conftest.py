import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, signals string, key string, gram string, n long, row string, quality long, `a.b` string"


def words(n, seed, vocabulary=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def rows():
    """Documents with nulls, empty and very long texts, repeats, near copies, and columns whose names operators use."""
    r = random.Random(3)
    out = []
    base = words(120, 1)
    for i in range(24):  # near copies with one to seven edits
        w = list(base)
        for _ in range(i % 8):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w))
    passage = words(60, 2)
    for i in range(12):  # a shared passage among other words
        w = words(90, 100 + i)
        out.append(" ".join(w[:40] + passage + w[40:]))
    out += [" ".join(words(70, 200))] * 5
    out += [None, None, "", "", " \n\t ", "one", "One", "two words", "a b c d", "A b C d", "a b c d e", "...", " ", "é" * 30]
    out += [" ".join(words(30_000, 300)), " ".join(words(30_000, 300)[::-1]), "x" * 200_000]
    out += ["the of and " * 100, "SHOUT!! " * 120, "### $$$ word " * 80, "same line here\n" * 60]
    docs = [(i, t, [None, "en", "fr"][i % 3], [None, "a", "b", "c"][i % 4], None if t is None else len(t)) for i, t in enumerate(out)]
    docs += [docs[3], docs[3], (None, "a null id", None, None, 9)]
    return [(*d, "x", "y", None, "g", 7, "z", 1, "dotted") for d in docs]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
