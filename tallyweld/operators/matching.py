"""The matching cascade as set operations keyed by supplier row.

Ids repeat in supplier lists, so match() numbers the rows and every stage is keyed by that number;
stages that are called alone take another `key`. Each stage works on what earlier stages left: exact establishment number, one company of nearly
the same name under the same postal code, full-text candidates scored by rules. No stage runs a
query per supplier. Joins on company numbers and postal codes leave the choice of sides to Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import similarity as sim, text as tx
from ..plans.registry import CITY_EDITS, STRICT_EDITS, Registry
from ..sources.tables import materialize
from . import bm25, nearby
from .suppliers import ROW

#: An address may differ by so many characters.
ADDRESS_EDITS = 9
NAME_POINTS, CITY_POINTS, ADDRESS_POINTS, SEAT_POINTS = 40, 30, 20, 10
NAME_LEAST, ADDRESS_LEAST = 90.0, 80.0
SURE, WEAK, CLOSE = 80, 50, 2
FTS_LIMIT, ALTERNATIVES = 20, 5


def direct(cleaned: DataFrame, registry: Registry, key: str = "input_id") -> DataFrame:
    """Suppliers whose number is an active establishment: key, siret, official_name."""
    names = registry.legal.select("siren", F.col("denominationUniteLegale").alias("official_name"))
    hits = cleaned.filter(F.col("siret").isNotNull()).select(key, "siret").join(registry.active.select("siret", "siren"), "siret").join(names, "siren", "left")
    return hits.groupBy(key, "siret").agg(F.min("official_name").alias("official_name"))


def near_names(cleaned: DataFrame, registry: Registry, key: str = "input_id") -> DataFrame:
    """(key, clean_cp, official_name, times, siret): names under the postal code at most STRICT_EDITS bytes away, whatever the number of establishments that bear them."""
    asked = cleaned.filter(F.col("clean_cp").isNotNull()).select(key, "clean_cp", sim.as_bytes(F.col("clean_name")).alias("clean_bytes"))
    if registry.named is not None:
        near = near_by_name(asked, registry)
        if near is not None:
            return met_by_name(asked, registry, near).select(key, "clean_cp", "official_name", "times", "siret")
    found = nearby.pairs(asked, registry.plain, registry.pieced, registry.crowds, ["clean_cp"], "clean_bytes", "name_bytes", STRICT_EDITS)
    return nearby.near(found, "clean_bytes", "name_bytes", STRICT_EDITS, once=registry.pieced is not None).drop("clean_bytes", "name_bytes")


#: Known names that are compared with each asked one.
MOST_NAMES = 50_000


def near_by_name(asked: DataFrame, registry: Registry) -> DataFrame | None:
    """(clean_bytes, name, official_name): asked names and known ones at most STRICT_EDITS bytes apart, whatever their postal codes; name is a number.

    None where names hardly repeat: if all asked names with all known ones are more pairs than CROWD for each asked row.
    """
    own = materialize(asked.groupBy("clean_bytes").agg(F.count("*").alias("n")), "asked_names")
    known = materialize(registry.legal.select(F.col("denominationUniteLegale").alias("official_name")).distinct(), "known_names")
    rows, n, k = *own.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first(), known.count()
    if k > MOST_NAMES or n * k > nearby.CROWD * rows:
        return None
    # at most MOST_NAMES rows are numbered and sent
    known = known.select(F.row_number().over(W.orderBy("official_name")).alias("name"), "official_name", sim.as_bytes(F.col("official_name")).alias("name_bytes"))
    both = own.select("clean_bytes").repartition(64).crossJoin(F.broadcast(known)).filter(sim.within(F.col("name_bytes"), F.col("clean_bytes"), STRICT_EDITS))
    return materialize(both.select("clean_bytes", "name", "official_name"), "near_names")


def near_known(near: DataFrame) -> DataFrame:
    return near.select("official_name", "name").distinct()


def met_by_name(asked: DataFrame, registry: Registry, near: DataFrame) -> DataFrame:
    """asked with the names under its postal code that near holds for its own.

    An uncrowded code has at most CROWD names: rows meet these, and near tells which count, so that no row is
    copied for near names that its code doesn't have. Under a crowded code rows bring their near names.
    """
    known = near_known(near)
    met = asked.join(registry.plain.join(known, "official_name"), "clean_cp").join(near.select("clean_bytes", "name"), ["clean_bytes", "name"])
    if registry.crowds is None:
        return met
    many = asked.join(registry.crowds, "clean_cp", "left_semi").join(near.select("clean_bytes", "name"), "clean_bytes")
    there = registry.named.join(registry.crowds, "clean_cp", "left_semi").join(known, "official_name")
    return met.unionByName(many.join(there, ["clean_cp", "name"]).select(*met.columns))


def strict_hits(cleaned: DataFrame, registry: Registry, key: str = "input_id") -> DataFrame:
    """Establishments under the same postal code whose company's name is at most STRICT_EDITS bytes away."""
    names = registry.legal.select("siren", F.col("denominationUniteLegale").alias("official_name"))
    places = registry.parts.select("siren", "siret", F.col("codePostalEtablissement").alias("clean_cp")).join(names, "siren").drop("siren")
    return near_names(cleaned, registry, key).drop("siret").join(places, ["clean_cp", "official_name"]).select(key, "siret", "official_name")


def strict_local(cleaned: DataFrame, registry: Registry, key: str = "input_id") -> DataFrame:
    """Of those, suppliers with exactly one."""
    one = near_names(cleaned, registry, key).groupBy(key).agg(F.sum("times").alias("n"), F.min("siret").alias("siret"), F.min("official_name").alias("official_name"))
    return one.filter("n = 1").drop("n")


def fts_candidates(cleaned: DataFrame, registry: Registry, direction: str = "desc", limit: int = FTS_LIMIT) -> DataFrame:
    """(search_token, siren, score, rank)."""
    return bm25.candidates(registry.index, cleaned, limit, direction)


def _establishments(df: DataFrame) -> DataFrame:
    return df.select("siret", "siren", F.col("libelleCommuneEtablissement").alias("city"), "address", F.coalesce("is_siege", F.lit(False)).alias("is_siege"), *(["dept"] if "dept" in df.columns else []))


_COMPARED = ("clean_name", "supplier_city", "supplier_address")


def fetch(cleaned: DataFrame, registry: Registry, candidates: DataFrame, key: str = "input_id") -> DataFrame:
    """Establishments of the candidates, with the supplier's columns to compare: of the supplier's
    department, or of all France without a postal code."""
    return fetch_local(cleaned, registry, candidates, key).unionByName(fetch_wide(cleaned, registry, candidates, key))


def fetch_local(cleaned: DataFrame, registry: Registry, candidates: DataFrame, key: str = "input_id") -> DataFrame:
    """fetch() of the suppliers with a postal code."""
    asked = cleaned.select(key, *_COMPARED, "search_token", F.substring("clean_cp", 1, 2).alias("dept")).filter("dept IS NOT NULL")
    return _met(asked, _places(registry, registry.parts, candidates), ["search_token", "dept"])


def fetch_wide(cleaned: DataFrame, registry: Registry, candidates: DataFrame, key: str = "input_id") -> DataFrame:
    """fetch() of the suppliers without one."""
    asked = cleaned.filter(F.substring("clean_cp", 1, 2).isNull()).select(key, *_COMPARED, "search_token")
    return _met(asked, _places(registry, registry.active, candidates), ["search_token"])


def _places(registry: Registry, places: DataFrame, candidates: DataFrame) -> DataFrame:
    """The establishments of each token's candidates; written, so that its size is known before suppliers meet it."""
    named = candidates.select("search_token", "siren").join(registry.legal.select("siren", F.col("denominationUniteLegale").alias("official_name")), "siren")
    return materialize(named.join(_establishments(places), "siren"), "places")


def _met(asked: DataFrame, there: DataFrame, on: list[str]) -> DataFrame:
    """Suppliers meet the places of their token, so none is copied for candidates that have no place for it."""
    met = asked.join(there, on)
    return met.select(*(c for c in asked.columns if c not in on), "siren", "siret", "city", "address", "is_siege", "official_name")


def city_near(supplier_city: Column, city_norm: Column) -> Column:
    return (supplier_city == "") | sim.within(city_norm, supplier_city, CITY_EDITS)


def address_near(supplier_address: Column, address_norm: Column) -> Column:
    return (supplier_address == "") | sim.within(address_norm, supplier_address, ADDRESS_EDITS)


def _near_city(city_norm: Column) -> Column:
    return city_near(F.col("supplier_city"), city_norm)


def _near_address(address_norm: Column) -> Column:
    return address_near(F.col("supplier_address"), address_norm)


def normalised() -> dict[str, Column]:
    """City and address of an establishment as they are compared."""
    return {"city_norm": tx.normalize_city(F.col("city")), "address_norm": tx.normalize_city(F.col("address"))}


def near_enough(found: DataFrame) -> DataFrame:
    """Drop establishments whose city or address is too far; an unknown side is no reason. Those columns of normalised() that found has are taken as they are."""
    made = found.withColumns({c: e for c, e in normalised().items() if c not in found.columns})
    return made.filter(_near_city(F.col("city_norm"))).filter(_near_address(F.col("address_norm"))).select(*found.columns)


def named_candidates(registry: Registry, candidates: DataFrame) -> DataFrame:
    """(search_token, siren, official_name, crowded, official_sorted, official_signature): each candidate's name is made ready once.

    Written, so that its size is known before suppliers and establishments meet it.
    """
    chosen = materialize(candidates.select("search_token", "siren"), "candidates")
    names = registry.names.select("siren", "official_name", "crowded").join(chosen.select("siren").distinct(), "siren", "left_semi")
    ready = names.withColumn("official_sorted", sim.sorted_tokens(F.col("official_name")))
    return materialize(chosen.join(ready.withColumn("official_signature", sim.signature(F.col("official_sorted"))), "siren"), "named")


def name_hits(names: DataFrame, named: DataFrame) -> DataFrame:
    """(clean_name, search_token, hits): the names of its token's candidates that a name resembles; two names are compared once."""
    asked = names.select("clean_name", "search_token").distinct().withColumn("clean_sorted", sim.sorted_tokens(F.col("clean_name")))
    asked = asked.withColumn("clean_signature", sim.signature(F.col("clean_sorted")))
    met = asked.join(named.dropDuplicates(["search_token", "official_name"]).drop("siren", "crowded"), "search_token")
    hit = sim.sorted_ratio_above(NAME_LEAST, F.col("clean_sorted"), F.col("official_sorted"), F.col("clean_signature"), F.col("official_signature"))
    return met.filter(hit).groupBy("clean_name", "search_token").agg(F.collect_set("official_name").alias("hits"))


def near_cities(asked: DataFrame, registry: Registry) -> DataFrame:
    """(supplier_city, city_norm): the cities of crowded companies at most CITY_EDITS characters away, each pair found once."""
    own = asked.select("supplier_city").filter("supplier_city <> ''").distinct()
    return nearby.near(nearby.pairs_by_pieces(own, registry.cities, [], "supplier_city", CITY_EDITS), "supplier_city", "city_norm", CITY_EDITS)


def fetch_near(cleaned: DataFrame, registry: Registry, candidates: DataFrame, key: str = "input_id") -> DataFrame:
    """near_enough(fetch()), with name_hit and address_hit: what is too far is left out by the join with the establishments."""
    named = named_candidates(registry, candidates)
    hits = materialize(name_hits(cleaned, named), "hits")
    asked = cleaned.select(key, *_COMPARED, "search_token", F.substring("clean_cp", 1, 2).alias("dept")).join(hits, ["clean_name", "search_token"], "left")
    # written once: both ways below read it, and plans stay short
    return near_places(materialize(asked, "asked"), registry, named, key)


def near_places(asked: DataFrame, registry: Registry, named: DataFrame, *keys: str) -> DataFrame:
    """fetch_near() of rows that hold their department and hits: keys and what is compared."""
    return near_local(asked, registry, named, *keys).unionByName(near_wide(asked, registry, named, *keys))


def near_local(asked: DataFrame, registry: Registry, named: DataFrame, *keys: str) -> DataFrame:
    """near_places() of the rows with a department."""
    return _near_places(asked.filter("dept IS NOT NULL"), registry, named, registry.parts, ["search_token", "dept"], keys)


def near_wide(asked: DataFrame, registry: Registry, named: DataFrame, *keys: str) -> DataFrame:
    """near_places() of the rows without one."""
    return _near_places(asked.filter("dept IS NULL").drop("dept"), registry, named, registry.active, ["search_token"], keys)


def _near_places(own: DataFrame, registry: Registry, named: DataFrame, places: DataFrame, on: list[str], keys: tuple[str, ...]) -> DataFrame:
    """Establishments join the candidates of the distinct tokens first, so a supplier row isn't copied for
    each of its candidates: it meets the places of its token and department, and brings the names that it resembles.

    A company with a crowd of establishments is met by its number and the cities that are near the
    supplier's; any other by its number, with the city tested inside the join.
    """
    found = named.select("search_token", "siren", "official_name", "crowded").join(_establishments(places), "siren").withColumns(normalised())
    there = materialize(found, "places")
    if registry.cities is None:
        met = own.join(there, on).filter(_near_city(F.col("city_norm")))
    else:
        met = own.join(there.filter("NOT crowded"), on).filter(_near_city(F.col("city_norm")))
        met = met.unionByName(own.filter("supplier_city = ''").join(there.filter("crowded"), on))
        met = met.unionByName(own.join(near_cities(own, registry), "supplier_city").join(there.filter("crowded"), [*on, "city_norm"]))
    met = met.filter(_near_address(F.col("address_norm")))
    met = met.select(*keys, *_COMPARED, "siren", "siret", "city", "address", "is_siege", "official_name", F.coalesce(F.array_contains("hits", F.col("official_name")), F.lit(False)).alias("name_hit"))
    return met.withColumn("address_hit", sim.token_set_of(F.col("supplier_address"), F.col("address")) > ADDRESS_LEAST)


def points(name_hit: Column | None = None, address_hit: Column | None = None) -> Column:
    name = sim.token_sort_ratio(F.col("clean_name"), F.col("official_name")) > NAME_LEAST if name_hit is None else name_hit
    city = F.col("supplier_city") == F.upper(tx.text(F.col("city")))
    address = sim.token_set_above(ADDRESS_LEAST, F.col("supplier_address"), F.col("address")) if address_hit is None else address_hit
    given = lambda c, n: F.when(c, n).otherwise(0)
    return given(name, NAME_POINTS) + given(city, CITY_POINTS) + given(address, ADDRESS_POINTS) + given(F.col("is_siege"), SEAT_POINTS)


def scored(near: DataFrame, key: str = "input_id") -> DataFrame:
    """Candidates with score and rank; equal scores by establishment number."""
    order = W.partitionBy(key).orderBy(F.col("score").desc(), "siret")
    rated = near.withColumn("score", points(*(F.col(c) if c in near.columns else None for c in ("name_hit", "address_hit"))))
    return rated.withColumn("rank", F.row_number().over(order))


def arbitrate(address: Column, a: Column, b: Column) -> Column:
    """'A' or 'B': the head office, else the address that holds more tokens of the question, else A."""
    question = F.upper(F.concat(F.lit("Which address best matches '"), address, F.lit("'?")))
    asked = F.regexp_extract_all(question, F.lit("[A-Z0-9]+"), 0)
    hits = lambda x: F.size(F.filter(asked, lambda t: F.contains(F.upper(tx.collapse(x["address"])), t)))
    seat = F.when(a["is_siege"], "A").otherwise("B")
    return F.when(a["is_siege"] != b["is_siege"], seat).when(hits(b) > hits(a), "B").otherwise("A")


def decide(ranked: DataFrame, arbiter=arbitrate, key: str = "input_id") -> DataFrame:
    """One row per key with candidates: the result and the step that made it."""
    kept = ranked.filter(F.col("rank") <= ALTERNATIVES + 1)
    one = F.struct("rank", "siret", "official_name", "score", "is_siege", "address")
    best = kept.groupBy(key, "supplier_address").agg(F.sort_array(F.collect_list(one)).alias("c"))
    a, b = F.get("c", F.lit(0)), F.get("c", F.lit(1))
    tie = b.isNotNull() & (a["score"] - b["score"] <= CLOSE)
    step = F.when(a["score"] > SURE, "CALCULATED").when(a["score"] < WEAK, "LOW_SCORE").when(tie, "ARBITER").otherwise("CALCULATED_FALLBACK")
    best = best.withColumn("step", step)
    # an arbiter gets nulls where there is no tie, so one that calls a model is asked for ties only
    tied = F.col("step") == "ARBITER"
    choice = arbiter(F.col("supplier_address"), F.when(tied, a), F.when(tied, b))
    best = best.withColumn("choice", choice).withColumn("pick", F.when(tied & (F.col("choice") == "B"), b).otherwise(a))
    hit = F.col("step") != "LOW_SCORE"
    method = F.when(~hit, "NOT_FOUND").when(F.col("step") == "ARBITER", "GEMINI_ARBITER").otherwise("CALCULATED")
    return best.select(
        key, F.when(hit, F.col("pick.siret")).alias("resolved_siret"), F.when(hit, F.col("pick.official_name")).alias("official_name"),
        F.when(hit, F.least(F.lit(1.0), F.col("pick.score") / 100.0)).otherwise(0.0).alias("confidence_score"), method.alias("match_method"),
        F.transform(F.slice("c", 2, ALTERNATIVES), lambda x: x["siret"]).alias("alternatives"), "step",
    )


#: All that the stages after the exact number compare of a supplier row.
_ASKED = ("clean_name", "search_token", "clean_cp", "supplier_city", "supplier_address")


def asked_once(cleaned: DataFrame) -> DataFrame:
    """The distinct questions of supplier rows, numbered by ROW."""
    return materialize(cleaned.select(*_ASKED).distinct().withColumn(ROW, F.monotonically_increasing_id()), "questions")


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def scored_near(cleaned: DataFrame, registry: Registry, direction: str = "desc", key: str = "input_id") -> DataFrame:
    """scored(fetch_near()) of the text candidates: key, siret, score, rank. Each row is judged on its own, and rows are cleaned once."""
    rows = materialize(cleaned.select(F.monotonically_increasing_id().alias(ROW), key, *_COMPARED, "search_token", F.substring("clean_cp", 1, 2).alias("dept")), "asked_rows")
    return _scored_rows(rows, rows.select("clean_name", "search_token").distinct(), ["clean_name", "search_token"], registry, direction, key)


def scored_suppliers(suppliers: DataFrame, registry: Registry, direction: str = "desc") -> DataFrame:
    """scored_near() of rows that aren't cleaned yet: input_id, siret, score, rank. A name is cleaned once, however many rows bear it."""
    from .suppliers import cleaned_names, located, with_input_id

    held = with_input_id(suppliers)
    # dealt before they are cleaned: a compressed table is read by few tasks
    dealt = held.repartition(_tasks(held), "input_id", *(F.col(f"`{c}`") for c in ("Nom", "Adresse 1") if c in held.columns))
    rows = located(dealt).withColumn("dept", F.substring("clean_cp", 1, 2)).drop("clean_cp")
    rows = materialize(rows.withColumn(ROW, F.monotonically_increasing_id()), "asked_rows")
    return _scored_rows(rows, materialize(cleaned_names(rows), "cleaned_names"), ["raw_name"], registry, direction, "input_id")


def _scored_rows(rows: DataFrame, names: DataFrame, on: list[str], registry: Registry, direction: str, key: str) -> DataFrame:
    """rows meet their names by the columns `on`.

    A row with a department meets few places: its key goes along, so that it isn't joined with its scores again.
    One without meets all places of its token: such rows that are equal are one question, which is answered once.
    """
    named = named_candidates(registry, fts_candidates(names, registry, direction))
    hits = materialize(name_hits(names, named), "hits")
    # written, so that its size is known before rows meet it
    asked = rows.join(materialize(names.join(hits, ["clean_name", "search_token"], "left"), "told"), on, "left")
    if registry.cities is not None:  # more than one join reads it
        asked = materialize(asked, "asked")
    local = scored(near_local(asked, registry, named, ROW, key), ROW).select(key, "siret", "score", "rank")

    same = [*_COMPARED, "search_token"]
    # the hash is what rows are sorted by; equal hashes are told apart by the question itself, and structs with equal nulls are equal
    joined = lambda df, *cs: df.select(*cs, F.xxhash64(*same).alias("hash"), F.struct(*same).alias("question"))
    wide = asked.filter("dept IS NULL")
    # dealt after that: few rows, each with many places, would stand in one task
    few = wide.select(*same).distinct().repartition(_tasks(rows), *same)
    questions = materialize(few.withColumn(ROW, F.monotonically_increasing_id()), "questions")
    told = questions.join(hits, ["clean_name", "search_token"], "left").withColumn("dept", F.lit(None).cast("string"))
    answers = materialize(scored(near_wide(told, registry, named, ROW), ROW).select(ROW, "siret", "score", "rank"), "scored")
    asking = joined(wide, key).join(joined(questions, ROW), ["hash", "question"]).select(key, ROW)
    return local.unionByName(asking.join(answers, ROW).drop(ROW))


def match(suppliers: DataFrame, registry: Registry, *, direction: str = "desc", arbiter=arbitrate, cleaner=None) -> DataFrame:
    """One result per supplier row: input_id, resolved_siret, official_name, confidence_score,
    match_method, alternatives (array), step. Rows of equal id are judged each on its own.

    cleaner maps (rows, suppliers), both with the column ROW, to other values of clean_name,
    search_token, clean_cp and clean_city; rows that the exact number resolved are not cleaned. Rows
    that are equal in all that later stages compare are one question, which is answered once and
    joined back. Suppliers, questions and answers are written once each, so that the many reads of later
    stages don't run the earlier ones again.
    """
    from .suppliers import cleaned, with_input_id

    side = lambda df, tag: df.select(ROW, F.struct(*(c for c in df.columns if c != ROW)).alias(tag))
    held = materialize(with_input_id(suppliers).withColumn(ROW, F.monotonically_increasing_id()), "rows")
    # dealt before they are cleaned: a compressed table is read by few tasks, and the join by ROW needs it anyway
    base = cleaned(held.repartition(_tasks(held), ROW))
    first = materialize(base.join(side(direct(cleaned(held), registry, ROW), "e"), ROW, "left"), "suppliers")
    rest = first.filter("e IS NULL").drop("e")
    if cleaner is not None:
        rest = materialize(cleaner(rest, held), "cleaned")
    questions = asked_once(rest)
    second = materialize(questions.join(side(strict_local(questions, registry, ROW), "l"), ROW, "left"), "local")
    placed = F.col("clean_cp").isNotNull() | (F.col("supplier_city") != "")
    asked = second.filter(F.col("l").isNull() & placed).drop("l")
    found = fetch_near(asked, registry, fts_candidates(asked, registry, direction), ROW)
    decided = decide(scored(found, ROW), arbiter, ROW)

    question = F.struct(*_ASKED).alias("question")  # structs with equal nulls are equal, so every row meets its own
    local = _result(second.filter("l IS NOT NULL").select(question, "l.*"), "STRICT_LOCAL", 0.95, "question")
    searched = second.filter("l IS NULL").select(question, ROW, placed.alias("placed")).join(side(decided, "d"), ROW, "left")
    rated = searched.select(
        "question", "d.resolved_siret", "d.official_name", F.coalesce("d.confidence_score", F.lit(0.0)).alias("confidence_score"), F.coalesce("d.match_method", F.lit("NOT_FOUND")).alias("match_method"),
        F.coalesce("d.alternatives", F.array().cast("array<string>")).alias("alternatives"), F.coalesce("d.step", F.when(F.col("placed"), "NOT_FOUND").otherwise("NO_LOCATION")).alias("step"),
    )
    answers = materialize(local.unionByName(rated), "answers")
    exact = _result(first.filter("e IS NOT NULL").select("input_id", "e.*"), "DIRECT_ID", 1.0)
    return exact.unionByName(rest.select("input_id", question).join(answers, "question").drop("question"))


def _result(df: DataFrame, method: str, confidence: float, key: str = "input_id") -> DataFrame:
    return df.select(key, F.col("siret").alias("resolved_siret"), "official_name", F.lit(confidence).alias("confidence_score"), F.lit(method).alias("match_method"), F.array().cast("array<string>").alias("alternatives"), F.lit(method).alias("step"))


def cleaned_rows(suppliers: DataFrame) -> DataFrame:
    from .suppliers import cleaned, with_input_id

    return cleaned(with_input_id(suppliers))


def diagnostics(cleaned: DataFrame, registry: Registry, direction: str = "desc", key: str = "input_id") -> DataFrame:
    """Counts behind each decision: strict hits, text candidates, establishments, those near enough, top scores, scope."""
    n = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    candidates = materialize(fts_candidates(cleaned, registry, direction), "candidates")
    ranked = materialize(scored(fetch_near(cleaned, registry, candidates, key), key).select(key, "rank", "score"), "ranked")
    # how many are found depends on token and department only
    named = candidates.select("search_token", "siren").join(registry.legal.select("siren"), "siren")
    per_place = named.join(registry.parts.select("siren", "dept"), "siren").groupBy("search_token", "dept").agg(F.count("*").alias("estabs_n"))
    per_place = per_place.unionByName(named.join(registry.active.select("siren"), "siren").groupBy("search_token").agg(F.lit("").alias("dept"), F.count("*").alias("estabs_n")))
    tops = ranked.filter("rank <= 5").groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("top_scores"))
    per_token = candidates.groupBy("search_token").agg(F.count("*").alias("fts_n"))
    strict = near_names(cleaned, registry, key).groupBy(key).agg(F.sum("times").alias("strict_hits_n"))
    out = cleaned.select(key, "search_token", "siren_from_vat", F.coalesce(F.substring("clean_cp", 1, 2), F.lit("")).alias("dept"), F.when(F.col("clean_cp").isNotNull(), F.concat(F.lit("department_"), F.substring("clean_cp", 1, 2))).otherwise("nationwide").alias("search_scope"))
    out = out.join(per_token, "search_token", "left").join(per_place, ["search_token", "dept"], "left").join(strict, key, "left").drop("search_token", "dept")
    out = out.join(n(ranked, "filtered_n"), key, "left")
    return out.join(tops, key, "left").na.fill(0, ["strict_hits_n", "fts_n", "estabs_n", "filtered_n"])
