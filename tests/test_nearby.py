"""Edit-distance joins and similarity bounds against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tallyweld.functions import similarity as sim
from tallyweld.operators import matching as m, nearby
from tallyweld.plans import registry as reg


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def edited(r, s, n, letters):
    s = list(s)
    for _ in range(n):
        at, kind = r.randrange(len(s) + 1), r.randrange(3)
        if kind == 0:
            s.insert(at, r.choice(letters))
        elif s and at < len(s):
            s[at : at + 1] = [r.choice(letters)] if kind == 1 else []
    return "".join(s)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_pieces_lose_no_near_pair(spark, most):
    """Strings of all lengths from none on, near and far, in one crowd."""
    r = random.Random(most)
    known = sorted({"".join(r.choice("abc") for _ in range(r.randrange(0, 14))) for _ in range(150)})
    asked = sorted({edited(r, r.choice(known), r.randrange(most + 3), "abcd") for _ in range(150)})
    left = spark.createDataFrame([("k", a) for a in asked], "k string, a string")
    right = nearby.known_pieces(spark.createDataFrame([("k", b) for b in known], "k string, b string"), "b", most)
    got = nearby.near(nearby.pairs_by_pieces(left, right, ["k"], "a", most), "a", "b", most).collect()
    want = {(a, b) for a in asked for b in known if distance(a, b) <= most}
    assert sorted((x.a, x.b) for x in got) == sorted(want) and len(want) > 100


def test_one_postal_code_in_half_of_all_rows(spark):
    """A crowded code is joined by pieces: few of its pairs are made, no hit is lost, and the others are joined as before."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(r.randrange(8, 20)))
    names = [word() for _ in range(1200)] + ["ÉTÉ " + word() for _ in range(40)]
    units = [(f"{i:09d}", n, "x", "A") for i, n in enumerate(names)]
    cp = lambda i: "75001" if i % 2 else f"{10000 + i % 700:05d}"
    places = [(f"{i:09d}00001", f"{i:09d}", cp(i), "PARIS", *[None] * 5, True, "A") for i in range(len(names))]
    est = spark.createDataFrame(places, "siret string, siren string, codePostalEtablissement string, libelleCommuneEtablissement string, numeroVoieEtablissement string, typeVoieEtablissement string, libelleVoieEtablissement string, complementAdresseEtablissement string, distributionSpecialeEtablissement string, etablissementSiege boolean, etatAdministratifEtablissement string")
    registry = reg.in_memory(spark.createDataFrame(units, "siren string, denominationUniteLegale string, activitePrincipaleUniteLegale string, etatAdministratifUniteLegale string"), est, crowds=True)
    asked = []
    for i in range(1500):
        k = r.randrange(len(names))
        asked.append((f"s{i}", edited(r, names[k], r.randrange(6), "ABCÉ"), cp(k) if r.random() < 0.9 else None))
    cleaned = spark.createDataFrame(asked, "input_id string, clean_name string, clean_cp string")
    latin = lambda s: s.encode().decode("latin-1")
    near = {(a, i) for a, n, c in asked if c for i, x in enumerate(names) if cp(i) == c and distance(latin(n), latin(x)) <= 3}
    assert {(x.input_id, int(x.siret[:9])) for x in m.strict_hits(cleaned, registry).collect()} == near
    once = {a for a, _ in near if sum(b == a for b, _ in near) == 1}
    assert {x.input_id for x in m.strict_local(cleaned, registry).collect()} == once
    few = cleaned.filter("clean_cp IS NOT NULL").select("input_id", "clean_name", "clean_cp").withColumn("clean_bytes", sim.as_bytes(F.col("clean_name")))
    made = nearby.pairs(few, registry.plain, registry.pieced, registry.crowds, ["clean_cp"], "clean_bytes", "name_bytes", 3).count()
    all_pairs = sum(1 for _, _, c in asked if c for i in range(len(names)) if cp(i) == c)
    assert len(near) <= made < all_pairs / 50


def test_a_company_with_a_crowd_of_establishments(spark):
    """Crowded companies are met through near cities: the same rows as fetching all of their establishments, fewer of them joined."""
    r = random.Random(3)
    cities = [f"{a}{b}" for a in ("SAINT", "MONT", "BEAU", "VILLE") for b in ("LIEU", "FORT", "MARTIN", "BOURG", "AY")]
    units = [("000000001", "GRANDE POSTE", "x", "A"), ("000000002", "PETITE POSTE", "x", "A"), ("000000003", "POSTE", "x", "A")]
    places = []
    for i in range(400):
        siren = "000000001" if i % 4 else r.choice(["000000002", "000000003"])
        city = r.choice(cities) if r.random() < 0.95 else None
        places.append((f"{siren}{i:05d}", siren, r.choice(["75001", "69002", None]), city, str(i % 5), "RUE", "HAUTE", None, None, i % 7 == 0, "A"))
    est = spark.createDataFrame(places, "siret string, siren string, codePostalEtablissement string, libelleCommuneEtablissement string, numeroVoieEtablissement string, typeVoieEtablissement string, libelleVoieEtablissement string, complementAdresseEtablissement string, distributionSpecialeEtablissement string, etablissementSiege boolean, etatAdministratifEtablissement string")
    registry = reg.in_memory(spark.createDataFrame(units, "siren string, denominationUniteLegale string, activitePrincipaleUniteLegale string, etatAdministratifUniteLegale string"), est, crowds=True)
    asked = []
    for i in range(120):
        city = edited(r, r.choice(cities), r.randrange(4), "AEX") if r.random() < 0.9 else ""
        asked.append((f"s{i}", r.choice(["GRANDE POSTE", "POSTE LA", "POSTE"]), "POSTE", r.choice(["75009", "69001", None]), city, r.choice(["", "1 RUE HAUTE", "3 RUE HAUTES", "12 AVENUE TRES LONGUE"])))
    cleaned = spark.createDataFrame(asked, "input_id string, clean_name string, search_token string, clean_cp string, supplier_city string, supplier_address string")
    candidates = m.fts_candidates(cleaned, registry)
    assert registry.names.filter("crowded").count() == 1
    columns = ["input_id", "siret", "siren", "city", "address", "is_siege", "official_name"]
    got = m.fetch_near(cleaned, registry, candidates).select(*columns, "name_hit").collect()
    every = m.fetch(cleaned, registry, candidates)
    want = m.near_enough(every)
    assert sorted(map(str, (tuple(x[c] for c in columns) for x in got))) == sorted(map(str, map(tuple, want.select(*columns).collect()))) and len(got) > 200
    names = {x.input_id: x.clean_name for x in cleaned.collect()}
    hit = dict(want.select("clean_name", "official_name", (sim.token_sort_ratio(F.col("clean_name"), F.col("official_name")) > m.NAME_LEAST).alias("hit")).distinct().select(F.struct("clean_name", "official_name"), "hit").collect())
    assert all(x.name_hit == hit[names[x.input_id], x.official_name] for x in got)
    near = {(x.supplier_city, x.city_norm) for x in m.near_cities(cleaned, registry).collect()}
    assert near == {(a, b) for a in {x[4] for x in asked if x[4]} for b in {(p[3] or "") for p in places if p[1] == "000000001"} if distance(a, b) <= 2}


def test_signatures_bound(spark):
    """No bound is below the truth, and what passes bounds equals the plain ratio."""
    r = random.Random(4)
    some = lambda: " ".join("".join(r.choice("abcde19É") for _ in range(r.randrange(0, 7))) for _ in range(r.randrange(0, 5))).strip()
    rows = []
    for _ in range(600):
        a = some()
        rows.append((a, edited(r, a, r.randrange(4), "abz ") if r.random() < 0.6 else some()))
    df = spark.createDataFrame(rows, "a string, b string").withColumn("x", sim.sorted_tokens(F.col("a"))).withColumn("y", sim.sorted_tokens(F.col("b")))
    df = df.withColumn("s", sim.signature(F.col("x"))).withColumn("t", sim.signature(F.col("y")))
    for percent in (50.0, 80.0, 90.0):
        got = df.select(
            (sim.ratio(F.col("x"), F.col("y")) > percent).alias("sort"), sim.sorted_ratio_above(percent, F.col("x"), F.col("y"), F.col("s"), F.col("t")).alias("sort_fast"), sim.may_reach(percent, F.length("x"), F.col("s"), F.length("y"), F.col("t")).alias("may"),
            (sim.token_set_ratio(F.col("a"), F.col("b")) > percent).alias("set"), sim.token_set_above(percent, F.col("a"), F.col("b")).alias("set_fast"), "a", "b", "x", "y",
        ).collect()
        for g in got:
            assert g.sort == g.sort_fast and g.set == g.set_fast, g
            assert g.may or not g.sort or g.x == g.y
        assert 0 < sum(not g.may for g in got)


def test_within_and_nulls(spark):
    df = spark.createDataFrame([("abc", "abd"), ("", "ab"), ("é", "e"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(sim.within(F.col("a"), F.col("b"), 1)).collect()] == [True, False, True, None]
    assert [r[0] for r in df.select(sim.within(F.col("a"), F.col("b"), 1, sim.byte_levenshtein)).collect()] == [True, False, False, None]
    assert [tuple(r[0]) for r in df.select(sim.signature(F.col("a"))).collect()][3] == (0, 0)
