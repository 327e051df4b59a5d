"""Operators that number rows, when executors come and go between planning and reading."""

import random
from collections import defaultdict

import pytest

from tallyweld.llm.exact import drop_copies
from tallyweld.llm.mixing import take


@pytest.fixture
def table(spark, tmp_path):
    r = random.Random(5)
    rows = [(i, f"text {r.randrange(3000)} of some words", f"s{r.randrange(3)}") for i in range(4000)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8).write.parquet(f"{tmp_path}/docs")
    return rows, spark.read.parquet(f"{tmp_path}/docs")


def test_drop_copies(table, other_splits):
    rows, docs = table
    other_splits(2)
    kept = drop_copies(docs)
    other_splits(32)
    last = {}
    for i, t, _ in rows:
        last[t] = max(last.get(t, -1), i)
    assert sorted(r.doc_id for r in kept.filter("doc_id >= 0").collect()) == sorted(last.values())


def test_take(table, other_splits):
    rows, docs = table
    other_splits(2)
    made = take(docs)
    want = sorted((r.doc_id, r.text, r.source) for r in made.collect())
    other_splits(32)
    again = sorted((r.doc_id, r.text, r.source) for r in made.filter("doc_id >= 0").collect())
    assert again == want
    texts, drawn = {i: t for i, t, _ in rows}, defaultdict(int)
    for i, t, _ in again:
        assert texts[i].startswith(t)
        drawn[i] += len(t.split())
    assert all(n <= 2 * len(texts[i].split()) for i, n in drawn.items())
