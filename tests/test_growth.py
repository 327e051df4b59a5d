"""Work and memory that stay in proportion when tables grow; results as before."""

import random
from dataclasses import replace

from pyspark.sql import functions as F

from tallyweld.functions import similarity as sim, text as tx
from tallyweld.operators import bm25, matching as m, nearby
from tallyweld.operators.suppliers import ROW, cleaned
from tallyweld.plans import registry as reg
from tallyweld.queries import Corrector
from tallyweld.sources import clients
from tallyweld.sources.tables import materialize


PLACE = "siret string, siren string, codePostalEtablissement string, libelleCommuneEtablissement string, numeroVoieEtablissement string, typeVoieEtablissement string, libelleVoieEtablissement string, complementAdresseEtablissement string, distributionSpecialeEtablissement string, etablissementSiege boolean, etatAdministratifEtablissement string"


def small_registry(spark, units, code):
    places = [(f"{i:014d}", siren, code(i), "PARIS", str(i % 5), "RUE", "HAUTE", None, None, i % 7 == 0, "A") for i, (siren, _) in enumerate(units)]
    legal = spark.createDataFrame([(s, n, "x", "A") for s, n in units], "siren string, denominationUniteLegale string, activitePrincipaleUniteLegale string, etatAdministratifUniteLegale string")
    return reg.in_memory(legal, spark.createDataFrame(places, PLACE))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_model_cleaning_sends_no_rows_to_the_driver(spark):
    """Rows meet their answers by shuffles, whatever sizes files show; each row keeps its own values."""
    rows = [(f"S{i}", f"acier {i % 3} sarl", "1 rue", "75001" if i % 2 else None, "Paris" if i % 4 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "input_id string, Nom string, `Adresse 1` string, Postal string, Ville string").withColumn(ROW, F.monotonically_increasing_id())
    held = materialize(df, "rows")
    got = clients.cleaner(Corrector())(cleaned(held), held)
    assert "Broadcast" not in plan(got)
    names = {r.input_id: r.clean_name for r in got.collect()}
    assert names == {i: (n.upper() if v else n.upper().removesuffix(" SARL")) for i, n, _, _, v in rows}


def test_companies_of_equal_terms_are_scored_once(spark, tmp_path, monkeypatch):
    """Names that repeat: the same rows as scoring every company, from the postings of one company a name."""
    names = [f"{a} {b} brand {i % 7}" for i, (a, b) in enumerate((a, b) for a in ("hot", "cold", "hot hot") for b in ("ring", "rod"))] + ["brand", "", "ring hot brand"]
    rows = [(f"{i:09d}", names[i * 7 % len(names)]) for i in range(600)]
    spark.createDataFrame(rows, "siren string, name string").write.parquet(str(tmp_path / "names"))
    index = bm25.build(spark.read.parquet(str(tmp_path / "names")), field="name")
    asked = spark.createDataFrame([("hot ring brand 1",), ("brand ring hot",), ("rod cold",), ("hot brand",), ("nothing ring",), ("ring",)], "search_token string")
    read = []
    score, best_scores = bm25._score, bm25.best_scores
    monkeypatch.setattr(bm25, "_score", lambda index, *a: read.append(index.postings.count()) or score(index, *a))
    monkeypatch.setattr(bm25, "best_scores", lambda index, *a: read.append(index.postings.count()) or best_scores(index, *a))
    row = lambda x: (x.search_token, x.rank, x.siren, round(x.score, 9))
    for limit in (3, 20):
        for direction in ("desc", "asc"):
            got = sorted(map(row, bm25.candidates(index, asked, limit, direction).collect()))
            every = score(index, bm25.asked_terms(index, asked), "search_token", "siren")
            assert got == sorted(map(row, bm25.top(every, limit, direction).collect())) and len(got) > 5 * limit
    assert len(read) == 4 and max(read) <= 3 * len(names)


def test_batches_of_pairs_equal_the_expressions(spark):
    """Subsequences and ratios over Arrow batches: the same doubles as pair by pair, for empty, null, accented, repeated and long strings."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdeÉ9😀") for _ in range(r.randrange(0, 9)))
    some = [" ".join(word() for _ in range(r.randrange(0, 5))) for _ in range(60)] + ["", None, "x" * 62, "xy" * 31, "xyz" * 30, "ab " * 130, "\0", "a\0"]
    df = spark.createDataFrame([(r.choice(some), r.choice(some)) for _ in range(900)], "a string, b string")
    a, b = F.col("a"), F.col("b")
    ready = df.withColumns({"x": sim.sorted_tokens(a), "y": sim.sorted_tokens(b), "s": sim.token_set(a), "t": sim.token_set(b), "u": tx.text(a), "v": tx.text(b)})
    fast = ready.withColumns({"f1": sim.lcs_all(F.col("u"), F.col("v")), "f2": sim.ratio_all(F.col("x"), F.col("y")), "f3": sim.token_set_all(F.col("s"), F.col("t"))})
    for g in fast.select("a", "b", "f1", "f2", "f3", sim.lcs(a, b).alias("p1"), sim.token_sort_ratio(a, b).alias("p2"), sim.token_set_ratio(a, b).alias("p3")).collect():
        assert (g.f1, g.f2, g.f3) == (g.p1, g.p2, g.p3), g


def test_near_names_whatever_their_codes(spark, tmp_path):
    """Names that repeat under many codes are compared once for all; the same rows as under each code."""
    r = random.Random(8)
    names = [f"{a} {b} BRAND {i}" for a in ("HOT", "ÉTÉ", "COLD") for b in ("RING", "ROD") for i in range(4)]
    registry = small_registry(spark, [(f"{i:09d}", names[i % len(names)]) for i in range(300)], lambda i: f"{75000 + i % 9:05d}")
    written = replace(registry, named=materialize(registry.plain, "named"), legal=materialize(registry.legal, "legal"))
    asked = [(f"s{i}", r.choice(names).replace("O", "OO") if i % 3 else "FAR AWAY", f"{75000 + r.randrange(10):05d}" if i % 7 else None) for i in range(400)]
    df = spark.createDataFrame(asked, "input_id string, clean_name string, clean_cp string")
    assert m.near_by_name(df.select(sim.as_bytes(F.col("clean_name")).alias("clean_bytes")), written) is not None
    row = lambda x: (x.input_id, x.clean_cp, x.official_name, x.times, x.siret)
    want = sorted(map(row, m.near_names(df, registry).collect()))
    assert sorted(map(row, m.near_names(df, written).collect())) == want and len(want) > 300


def test_rows_are_not_copied_for_their_candidates(spark):
    """The supplier's side meets places by token and department: no exchange of its rows by company."""
    registry = small_registry(spark, [(f"{i:09d}", f"HOT RING {i % 3}") for i in range(60)], lambda i: f"{75000 + i % 2 * 1000:05d}")
    df = spark.createDataFrame([(f"s{i}", "HOT RING", "RING", "75001" if i % 3 else None, "PARIS", "1 RUE HAUTE" if i % 2 else "") for i in range(90)], "input_id string, clean_name string, search_token string, clean_cp string, supplier_city string, supplier_address string")
    candidates = m.fts_candidates(df, registry)
    got = m.fetch_near(df, registry, candidates)
    assert "siren" not in " ".join(x for x in plan(got).split("\n") if "Join" in x and "[siren" in x)
    want = m.near_enough(m.fetch(df, registry, candidates)).withColumn("score", m.points())
    key = lambda x: (x.input_id, x.siret, x.score)
    assert sorted(map(key, m.scored(got).collect())) == sorted(map(key, want.collect())) and got.count() > 90


def test_equal_questions_are_answered_once(spark, monkeypatch):
    """Rows that are equal in all that is compared, missing cells included, are searched once; each gets its answer."""
    registry = small_registry(spark, [(f"{i:09d}", f"ACIER {i} NORD") for i in range(30)], lambda i: f"{75001 + i % 3}")
    once = [("ACIER 1 SUD", "1 rue haute", "75001", "Paris"), ("ACIER 2 SUD", "", None, "Paris"), (None, "", None, None), ("NORD", None, "75002", None)]
    df = spark.createDataFrame([(f"S{i}", *once[i % 4]) for i in range(40)], "input_id string, Nom string, `Adresse 1` string, Postal string, Ville string")
    asked = []
    fetch = m.fetch_near
    monkeypatch.setattr(m, "fetch_near", lambda rows, *more: asked.append(rows.count()) or fetch(rows, *more))
    many = {r.input_id: r[1:] for r in m.match(df, registry).collect()}
    assert asked[0] <= len(once)
    alone = {r.input_id: r[1:] for r in m.match(df.filter("input_id IN ('S0', 'S1', 'S2', 'S3')"), registry).collect()}
    assert len(many) == 40 and all(v == alone[f"S{int(k[1:]) % 4}"] for k, v in many.items())


def test_unreadable_rows_are_found_by_one_job(spark, monkeypatch):
    """Every row of which a cell raises is found with its own message, without dividing all rows again and again."""
    from tallyweld.plans import unified

    rows = spark.range(200).selectExpr("concat('s', id) AS input_id", "CASE WHEN id % 9 = 4 THEN cast(raise_error(concat('bad row ', id)) AS string) WHEN id % 2 = 0 THEN 'X' END AS Nom", "id AS n")
    tried = []
    between = unified._between
    monkeypatch.setattr(unified, "_between", lambda *cell: tried.append(cell) or between(*cell))
    found = unified.unreadable_ids(rows, "tag")
    bad = {r.place: r.id for r in spark.range(200).filter("id % 9 = 4").select("id", F.xxhash64(F.concat(F.lit("s"), "id")).alias("place")).collect()}
    assert found.keys() == bad.keys() and all(f"bad row {i}" in found[p] for p, i in bad.items())
    assert len(tried) == len(bad)
    assert unified.unreadable_ids(rows.filter("n % 9 <> 4"), "tag") == {}


def test_rows_are_not_copied_for_near_names_of_other_codes(spark):
    """Rows meet the names of their own code, and near tells which count; under a crowded code rows bring their near names. The same rows either way."""
    names = [f"HOT RING BRAND {i}" for i in range(12)]
    registry = small_registry(spark, [(f"{i:09d}", names[i * 5 % 12]) for i in range(200)], lambda i: "75000" if i % 3 else f"{75001 + i % 10}")
    named = materialize(registry.plain, "named")
    crowds = materialize(nearby.crowded(named, ["clean_cp"], 6), "crowds")
    legal = materialize(registry.legal, "legal")
    df = spark.createDataFrame([(f"s{i}", names[i % 12], f"{75000 + i % 12}" if i % 7 else None) for i in range(120)], "input_id string, clean_name string, clean_cp string")
    row = lambda x: (x.input_id, x.clean_cp, x.official_name, x.times, x.siret)
    want = sorted(map(row, m.near_names(df, registry).collect()))
    none = m.near_names(df, replace(registry, named=named, legal=legal))
    some = m.near_names(df, replace(registry, named=named, legal=legal, plain=named.join(crowds, "clean_cp", "left_anti"), crowds=crowds))
    assert [r.clean_cp for r in crowds.collect()] == ["75000"] and len(want) > 100
    assert sorted(map(row, none.collect())) == want == sorted(map(row, some.collect()))
    assert not [x for x in plan(none).split("\n") if "Join" in x and "[clean_bytes#" in x and "name#" not in x]


def test_rows_are_not_copied_for_candidates_without_places(spark):
    """fetch() joins suppliers with places by token and department, never by company."""
    registry = small_registry(spark, [(f"{i:09d}", f"HOT RING {i % 3}") for i in range(60)], lambda i: f"{75000 + i % 2 * 1000:05d}")
    df = spark.createDataFrame([(f"s{i}", "HOT RING", "RING", "75001" if i % 3 else None, "PARIS", "1 RUE HAUTE") for i in range(90)], "input_id string, clean_name string, search_token string, clean_cp string, supplier_city string, supplier_address string")
    got = m.fetch(df, registry, m.fts_candidates(df, registry))
    assert "[siren" not in " ".join(x for x in plan(got).split("\n") if "Join" in x)
    twenty = {f"{i:09d}" for i in range(20)}
    places = {(f"{i:014d}", i % 2) for i in range(60) if f"{i:09d}" in twenty}
    assert sorted((r.input_id, r.siret) for r in got.collect()) == sorted((f"s{i}", s) for i in range(90) for s, odd in places if not i % 3 or not odd)


def test_rows_are_cleaned_once_for_scores(spark):
    registry = small_registry(spark, [(f"{i:09d}", f"ACIER {i} NORD") for i in range(30)], lambda i: f"{75001 + i % 3}")
    df = spark.createDataFrame([(f"S{i}", f"acier {i % 4} nord sarl", "1 rue haute", "75001" if i % 3 else None, "Paris") for i in range(40)], "Auxiliaire string, Nom string, `Adresse 1` string, Postal string, Ville string")
    got = m.scored_near(m.cleaned_rows(df), registry)
    assert "regexp_replace" not in plan(got) and {r.input_id for r in got.collect()} == {f"S{i}" for i in range(40)}


def test_names_are_cleaned_once_and_rows_without_a_code_are_one_question(spark, monkeypatch):
    """The rows that each row gives by itself, with names, codes, cities and addresses missing and ids that repeat."""
    registry = small_registry(spark, [(f"{i:09d}", f"ACIER {i % 9} NORD") for i in range(60)], lambda i: f"{75001 + i % 3}")
    pick = lambda i, *xs: xs[i % len(xs)]
    rows = [(f"S{i % 70}", pick(i, "acier 1 nord sarl", "Acier  1 Nord", "acier 2 nord", None, ""), pick(i, "1 rue haute", "", None), pick(i // 2, "75001", None), pick(i // 3, "Paris", "paris ", None, "Lyon")) for i in range(240)]
    df = spark.createDataFrame(rows, "Auxiliaire string, Nom string, `Adresse 1` string, Postal string, Ville string")
    each = materialize(m.cleaned_rows(df).withColumn(ROW, F.monotonically_increasing_id()), "each")
    near = m.fetch_near(each, registry, m.fts_candidates(each, registry), ROW)
    want = m.scored(near, ROW).select(ROW, "siret", "score", "rank").join(each.select(ROW, "input_id"), ROW).select("input_id", "siret", "score", "rank")
    asked, made = [], m.near_wide
    monkeypatch.setattr(m, "near_wide", lambda own, *a: asked.append(own.count()) or made(own, *a))
    got = m.scored_suppliers(df, registry)
    questions = each.filter("clean_cp IS NULL").select("clean_name", "search_token", "supplier_city", "supplier_address").distinct().count()
    assert "regexp_replace" not in plan(got) and asked == [questions] and 3 * questions < sum(r[3] is None for r in rows)
    found = sorted(map(tuple, got.collect()))
    assert found == sorted(map(tuple, want.collect())) and len(found) > 1000
    assert found == sorted(map(tuple, m.scored_near(m.cleaned_rows(df), registry).collect()))


def test_names_under_codes_are_written_when_asked_for(spark, tmp_path):
    at = str(tmp_path)
    legal = spark.createDataFrame([(f"{i:09d}", f"ACIER {i}", "x", "A") for i in range(9)], "siren string, denominationUniteLegale string, activitePrincipaleUniteLegale string, etatAdministratifUniteLegale string")
    places = spark.createDataFrame([(f"{i:014d}", f"{i:09d}", "75001", "PARIS", *[None] * 5, True, "A") for i in range(9)], PLACE)
    legal.write.parquet(f"{at}/ul")
    places.write.parquet(f"{at}/etab")
    bare = reg.build(spark, f"{at}/ul", f"{at}/etab", f"{at}/reg", codes=False)
    assert bare.plain is None and not (tmp_path / "reg" / "names_by_code").exists() and reg.load(spark, f"{at}/reg").named is None
    for whole in (reg.add_codes(spark, f"{at}/reg"), reg.load(spark, f"{at}/reg")):
        assert whole.plain.count() == 9 and whole.named.count() == 9 and reg.paths(spark, f"{at}/reg")["codes"]


def test_tokens_of_a_batch_are_those_of_the_plan(spark):
    words = ["", " ", "a b", "b  a", "a\u00a0b c", "\u2003x\tx y\x85z", "a\x1cb c", "é z", "\u180ea b"]
    pairs = spark.createDataFrame([(a, b) for a in [*words, None] for b in [*words, None]], "a string, b string")
    pairs = pairs.withColumns({"s": sim.token_set(F.col("a")), "t": sim.token_set(F.col("b"))})
    got = pairs.select(sim.token_set_of(F.col("a"), F.col("b")).alias("x"), sim.token_set_all(F.col("s"), F.col("t")).alias("y")).collect()
    assert all(r.x == r.y for r in got) and len({r.x for r in got}) > 3


def test_words_are_dealt_once(spark):
    """A company's length is counted where its terms lie: no join, and one exchange."""
    legal = materialize(spark.createDataFrame([("1", "HOT HOT RING"), ("2", "RING"), ("3", "")], "siren string, denominationUniteLegale string"), "legal")
    stats = materialize(bm25.statistics(legal), "stats")
    got = bm25.postings(legal, stats)
    own = plan(got).split("Subqueries")[0]
    assert "Join" not in own and own.count("Exchange hashpartitioning") == 1
    assert sorted((r.siren, r.term, r.tf, r.dl) for r in got.collect()) == [("1", "hot", 2, 3), ("1", "ring", 1, 3), ("2", "ring", 1, 1)]


def test_a_supplier_file_is_parsed_once(spark, tmp_path, monkeypatch):
    """Both halves of the split read what was parsed, not the file."""
    from tallyweld.plans import unified

    registry = small_registry(spark, [(f"{i:09d}", f"ACIER {i} NORD") for i in range(5)], lambda i: "75001")
    (tmp_path / "in.csv").write_text("Auxiliaire,Nom,Adresse 1,Postal,Ville,Pays\n" + "".join(f"S{i},acier {i} nord,1 rue haute,75001,Paris,{'FR' if i % 2 else 'DE'}\n" for i in range(6)))
    seen = []
    split = unified.preprocess
    monkeypatch.setattr(unified, "preprocess", lambda df, **k: seen.append(plan(df)) or split(df, **k))
    got = unified.run_unified(spark, str(tmp_path / "in.csv"), registry, str(tmp_path / "out"))
    assert "csv" not in seen[0].lower().replace(str(tmp_path), "") and {r.input_id for r in got.collect()} == {"S1", "S3", "S5"}
