"""Top companies of tokens of several terms: the same as scoring everything, from fewer postings."""

import random

import pytest

from tallyweld.operators import bm25


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    r = random.Random(2)
    frequent, rare = ["societe", "france", "services"], [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(3000):
        words = [w for w in frequent if r.random() < 0.4] + [r.choice(rare) for _ in range(r.randrange(0, 4))] * r.choice([1, 1, 2])
        rows.append((f"{i:09d}", " ".join(words)))
    rows += [(f"{90000 + i:09d}", "societe twin") for i in range(60)]  # ties beyond the limit
    at = str(tmp_path_factory.mktemp("topk") / "names")
    spark.createDataFrame(rows, "siren string, name string").write.parquet(at)
    return bm25.build(spark.read.parquet(at), field="name"), rows, rare


@pytest.mark.parametrize("limit", [1, 5, 20])
def test_equal_rows(spark, index, limit):
    index, _, rare = index
    r = random.Random(limit)
    tokens = ["societe france", "societe twin", "twin societe france services", "nothing here", "societe nothing", "services", ""]
    tokens += [" ".join(r.sample(rare, r.randrange(1, 4)) + r.sample(["societe", "france", "services"], r.randrange(0, 3))) for _ in range(60)]
    asked = spark.createDataFrame([(t,) for t in tokens], "search_token string")
    for direction in ("desc", "asc"):
        got = bm25.candidates(index, asked, limit, direction).collect()
        want = bm25.top(bm25.score(index, asked), limit, direction).collect()
        key = lambda x: (x.search_token, x.rank)
        assert [(x.search_token, x.siren, round(x.score, 9)) for x in sorted(got, key=key)] == [(x.search_token, x.siren, round(x.score, 9)) for x in sorted(want, key=key)]


def test_fewer_postings(spark, index):
    """A rare word beside frequent ones: the frequent ones' postings stay unread."""
    index, rows, rare = index
    asked = bm25.asked_terms(index, spark.createDataFrame([(f"{w} societe france",) for w in rare[:40]], "search_token string"))
    bounds = bm25._bounds(index, asked, 5, "search_token", "siren")
    read = bm25.read_postings(index, bounds).count()
    every = asked.select(bm25.F.explode("terms").alias("term")).join(index.postings, "term").count()
    assert read < every / 10
