"""Expressions against tables of (input, expected) and against slow Python versions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyweld.functions import country as geo, similarity as sim, text as tx
from tallyweld.functions.porter import stem
from tallyweld.functions.vocab import FRENCH_CITIES
from tallyweld.operators import bm25
from tallyweld.operators.suppliers import identify_columns, require_columns
from tallyweld.sources import clients


def apply(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


CASES = [
    (tx.digits_only, {"12 34-5": "12345", None: "", "abc": ""}),
    (tx.normalize_city, {"  saint   ouen ": "SAINT OUEN", None: "", "é à": "É À"}),
    (tx.extract_siret, {"123 456 789 00012": "12345678900012", "123": None, None: None, "FR12345678901234": "12345678901234"}),
    (tx.siren_from_vat, {"FR 12 123456789": "123456789", "fr12123456789": "123456789", "DE123456789": None, None: None, "FRX1 234 567 8901": "345678901"}),
    (tx.clean_name, {"Dupont SAS": "DUPONT", "SA Martin et fils sarl": "MARTIN ET FILS", "SASSY": "SASSY", None: "", "Éts SARL Noël": "ÉTS NOËL", "SAÉ": "SAÉ"}),
    (tx.search_token, {"CARREFOUR MARKET": "CARREFOUR", "AB CD": "AB", "": "UNKNOWN", "ÉÉ": "ÉÉ", "ÉLEC X": "LEC"}),
    (tx.extract_cp, {"F-75001 Paris": "75001", "00000": None, "123456": None, None: None, "1 rue 69002 b 69003": "69002"}),
    (geo.is_french_postal, {"6000": True, "75001.0": True, "12": True, "90210": True, "AB123": False, "": False, None: False, "123456": False}),
    (geo.is_french_city, {"paris": True, "LA PAZ": False, "LE CREUSOT": True, "GREEN BAY": True, "LA CIOTAT": True, "BERLIN": False, "": False, None: False, "LE PUY": True, "LA VEGAS X": False}),
    (geo.is_active, {None: False, "": False, "  ": False, "nan": False, "NULL": False, "None": False, "none": True, "2024-01-01": True}),
    (clients.unfence_column, {"```json\n{}\n```": "{}", "```x```": "x", "plain": "plain"}),
]


@pytest.mark.parametrize("f,cases", CASES, ids=[f.__name__ for f, _ in CASES])
def test_expressions(spark, f, cases):
    assert apply(spark, f, list(cases)) == list(cases.values())


def test_city_list_is_distinct():
    assert len(FRENCH_CITIES) == len(set(FRENCH_CITIES)) == 133


def test_infer_country(spark):
    rows = [("732 829 320", "DE", "x", "x", "FRANCE", "DE"), (None, "FRA", None, None, "FRANCE", "FRANCE"), (None, "B", None, None, "UNKNOWN", "B"), (None, "", "Paris", None, "FRANCE", "FRANCE"), (None, None, "LA PAZ", "BOL", "UNKNOWN", "UNKNOWN"), (None, None, "x", "6000", "FRANCE", "FRANCE"), ("12345678", "be ", None, None, "BE", "BE")]
    df = spark.createDataFrame(rows, "s string, p string, c string, z string, a string, b string")
    inferred = geo.infer_country(*(F.col(x) for x in "spcz"))
    for r in df.select(inferred.alias("x"), geo.final_country(F.col("p"), inferred).alias("y"), "a", "b").collect():
        assert (r.x, r.y) == (r.a, r.b)


def test_numbers_keep_leading_zeros(spark):
    df = spark.createDataFrame([(1234567890123,), (12345678901234,), (123456789012345,)], "n long")
    assert [r[0] for r in df.select(tx.extract_siret(F.col("n"), numeric=True)).collect()] == ["01234567890123", "12345678901234", None]
    assert spark.sql("SELECT 6000D AS x").select(tx.clean_cp_number(F.col("x"))).first()[0] == "06000"


def test_json_list(spark):
    df = spark.createDataFrame([(["a", 'b"c'],), ([],)], "x array<string>")
    assert [r[0] for r in df.select(tx.json_list(F.col("x"))).collect()] == ['["a", "b\\"c"]', "[]"]


def test_serializable(spark):
    df = spark.sql("SELECT double('NaN') AS a, double('Infinity') AS b, 1.5D AS c, date'2024-02-03' AS d, timestamp'2024-02-03 04:05:06' AS e, 's' AS f")
    assert tuple(df.select(*(tx.serializable(df, c).alias(c) for c in df.columns)).first()) == (None, None, 1.5, "2024-02-03", "2024-02-03T04:05:06", "s")


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = list(itertools.accumulate(range(1, len(b) + 1), lambda left, j, r=row, x=x: r[j - 1] + 1 if x == b[j - 1] else max(r[j], left), initial=0))
    return row[-1]


def ratio(a, b):
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    i, p, q = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if i and (not p or not q):
        return 100.0
    joined = [i + " " * bool(i) + s for s in (p, q)]
    d = len(p) + len(q) - 2 * lcs(p, q)
    best = 100.0 * (1 - d / sum(map(len, joined)))
    return max([best, *(ratio(i, j) for j in joined if i)])


def test_similarity(spark):
    r = random.Random(1)
    words = ["RUE", "DES", "FLEURS", "12", "BIS", "É", "AVENUE", "X" * 40, "Y" * 70]
    texts = ["", " ", "A", "kitten", "sitting"] + [" ".join(r.choices(words, k=r.randrange(1, 6))) for _ in range(40)]
    pairs = [(a, b) for a in texts[:12] for b in texts[:12]] + [(r.choice(texts), r.choice(texts)) for _ in range(120)]
    a, b = F.col("a"), F.col("b")
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", sim.lcs(a, b).alias("l"), sim.ratio(a, b).alias("r"), sim.token_sort_ratio(a, b).alias("ts"), sim.token_set_ratio(a, b).alias("tt")).collect()
    order = lambda s: " ".join(sorted(s.split()))
    for x in got:
        assert x.l == lcs(x.a, x.b), (x.a, x.b)
        assert x.r == pytest.approx(ratio(x.a, x.b)) and x.ts == pytest.approx(ratio(order(x.a), order(x.b)))
        assert x.tt == pytest.approx(token_set(x.a, x.b)), (x.a, x.b)


def test_byte_levenshtein(spark):
    df = spark.createDataFrame([("É", "E", 2, 1), ("abc", "abd", 1, 1), ("", "xy", 2, 2)], "a string, b string, bytes int, points int")
    for r in df.select("*", sim.byte_levenshtein(F.col("a"), F.col("b")).alias("x"), F.levenshtein("a", "b").alias("y"), sim.within(F.col("a"), F.col("b"), 1, sim.byte_levenshtein).alias("w")).collect():
        assert (r.x, r.y, r.w) == (r.bytes, r.points, r.bytes <= 1)


@pytest.mark.parametrize("word,want", {"caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "vietnamization": "vietnam", "hopefulness": "hope", "triplicate": "triplic", "electrical": "electr", "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "probate": "probat", "rate": "rate", "controlling": "control", "roll": "roll", "oscillators": "oscil", "generalizations": "gener"}.items())
def test_porter(word, want):
    assert stem(word) == want


def test_terms(spark):
    assert apply(spark, bm25.terms, ["L'Été 2024 d'ÉLODIE-Noël", None, "123"]) == [["l", "ete", "d", "elodie", "noel"], [], []]


def test_bm25_order_and_digits(spark):
    legal = spark.createDataFrame([("1", "ALPHA BETA"), ("2", "ALPHA"), ("3", "ALPHA ALPHA GAMMA"), ("4", "DELTA"), ("5", "42")], "siren string, denominationUniteLegale string")
    q = spark.createDataFrame([("ALPHA",), ("ALPHA",), ("42",)], "search_token string")
    index = bm25.build(legal)
    rank = lambda d, n=20: [r.siren for r in bm25.top(bm25.score(index, q), n, d).orderBy("rank").collect()]
    assert sorted(rank("desc")) == ["1", "2", "3"] and rank("asc") == rank("desc")[::-1] and rank("desc", 2) == rank("desc")[:2]


def test_columns():
    assert identify_columns(["raison sociale", "CP", "Commune", "Siret"]) == {"Nom": "raison sociale", "Postal": "CP", "Ville": "Commune", "Code SIRET": "Siret"}
    with pytest.raises(ValueError, match="Ville"):
        require_columns(["Nom", "Postal"])


def test_parse_batch():
    row = {"clean_name": "A"}
    assert clients.parse_batch('```json\n[{"clean_name": "A"}]\n```', 2) == [row, {}]
    assert clients.parse_batch('{"results": [{"clean_name": "A"}, {}, {}]}', 1) == [row]
    assert clients.parse_batch('{"x": 1, "rows": [{"clean_name": "A"}]}', 1) == [row] and clients.parse_batch('{"clean_name": "A"}', 1) == [row]
