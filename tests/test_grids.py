"""Pairs whose strings repeat are compared once for each two strings, with the same values."""

import pytest
from pyspark.sql import functions as F

from tallyweld.functions import similarity as sim
from tallyweld.operators import grids, matching as m

NAMES = ["HOT RING", "HÔT RING", "", "RING  HOT", "X" * 70, None, "HOT RING BRAND 7"]


def sides(spark, names):
    asked = spark.createDataFrame([(f"s{i}", str(i % 3), names[i % len(names)]) for i in range(60)], "input_id string, cp string, a string")
    there = spark.createDataFrame([(f"e{i}", str(i % 4), names[i % len(names)]) for i in range(60)], "siret string, cp string, b string")
    return asked, there


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("make", [
    grids.Compared("a", "b", lambda a, b: F.levenshtein(a, b).cast("int")), grids.Compared("a", "b", sim.lcs_all),
    grids.Compared("a", "b", lambda a, b: F.round(sim.ratio_all(a, b), 6), scaled=True), grids.Compared("a", "b", lambda a, b: F.round(sim.token_set_all(a, b), 6), scaled=True),
])
def test_cells_equal_pairs(spark, monkeypatch, make):
    asked, there = sides(spark, NAMES)
    seen = []
    table = grids._table
    monkeypatch.setattr(grids, "_table", lambda *a: seen.append(1) or table(*a))
    got = grids.meet(asked, there, "cp", {"v": make})
    monkeypatch.setattr(grids, "MOST_CELLS", 0)
    want = grids.meet(asked, there, "cp", {"v": make})
    assert len(seen) == 1 and "udf" not in got._jdf.queryExecution().executedPlan().toString() and rows(got) == rows(want)
    assert rows(want) == rows(asked.join(there, "cp").select("input_id", "siret", make.make(F.col("a"), F.col("b")).alias("v"))) and len(rows(want)) == 900


def test_filters_by_cells(spark, monkeypatch):
    asked, there = sides(spark, [x for x in NAMES if x is not None])
    both = {"x": grids.Compared("a", "b", m.city_near), "y": grids.Compared("a", "b", m.address_near)}
    got = grids.meet(asked, there, "cp", both, where=True)
    assert "levenshtein" not in got._jdf.queryExecution().executedPlan().toString()
    want = asked.join(there, "cp").filter(m.city_near(F.col("a"), F.col("b"))).filter(m.address_near(F.col("a"), F.col("b"))).select("input_id", "siret")
    assert rows(got) == rows(want) and 0 < len(rows(want)) < 900


def test_strings_that_hardly_repeat_are_compared_as_they_come(spark, monkeypatch):
    asked, there = sides(spark, [f"NAME {i}" for i in range(60)])
    monkeypatch.setattr(grids, "_table", lambda *a: pytest.fail("a table"))
    assert len(rows(grids.meet(asked, there, "cp", {"v": grids.Compared("a", "b", F.levenshtein)}))) == 900


def test_rows_of_a_crowded_key_travel_in_bundles(spark, monkeypatch):
    asked, there = sides(spark, NAMES)
    monkeypatch.setattr(grids, "BUNDLE", 4)
    bundles = grids._bundles(there, "cp").select(F.size("__bundle")).collect()
    assert len(bundles) > 8 and sum(r[0] for r in bundles) == 60
    got = grids.meet(asked, there, "cp", {"v": grids.Compared("a", "b", sim.lcs_all)})
    assert rows(got) == rows(asked.join(there, "cp").select("input_id", "siret", sim.lcs_all(F.col("a"), F.col("b")).alias("v")))


def test_pairs_are_made_without_a_registry(spark, monkeypatch):
    """Queries over all pairs read two tables: no index and no other table is written for them."""
    from tallyweld import queries as q

    monkeypatch.setattr(q, "_built", {})
    monkeypatch.setattr(q.reg, "build", lambda *a, **k: pytest.fail("a registry"))
    got = rows(q.lcs_ratio(spark, "/root/testdata/sf0.001"))
    monkeypatch.undo()
    q._registry(spark, "/root/testdata/sf0.001")
    assert got and got == rows(q.lcs_ratio(spark, "/root/testdata/sf0.001"))


def test_rounded_ratio(spark):
    both = spark.range(0, 700).selectExpr("cast(id as int) AS t").join(spark.range(0, 351).selectExpr("cast(id as int) AS c"), F.expr("2 * c <= t"))
    got = both.select(sim.rounded_ratio(F.col("c"), F.col("t")).alias("x"), F.round(F.when(F.col("t") == 0, 100.0).otherwise(200.0 * F.col("c") / F.col("t")), 6).alias("y"))
    assert got.filter("x <> y").count() == 0 and got.count() > 100_000
