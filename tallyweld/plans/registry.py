"""The company registry: active legal units, establishments by department, search postings."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import similarity as sim
from ..functions.text import normalize_city, registry_address, text
from ..operators import bm25, nearby
from ..schemas import ADDRESS_PARTS, ESTABLISHMENT_COLUMNS, ESTABLISHMENT_PART
from ..sources.readers import read_json_meta, read_parquet, write_json_meta


def active_legal_units(units: DataFrame) -> DataFrame:
    """Active units with a name, upper-cased."""
    name = F.col("denominationUniteLegale")
    kept = units.filter((F.col("etatAdministratifUniteLegale") == "A") & name.isNotNull() & (F.length(F.trim(name)) > 0))
    return kept.select("siren", F.upper(name).alias("denominationUniteLegale"), "activitePrincipaleUniteLegale", "etatAdministratifUniteLegale")


def _columns(city: Column, cp: Column) -> list[Column]:
    return ["siret", "siren", city.alias("libelleCommuneEtablissement"), cp.alias("codePostalEtablissement"), registry_address(*ADDRESS_PARTS).alias("address"), (F.col("etablissementSiege") == F.lit(True)).alias("is_siege")]


def active_establishments(establishments: DataFrame) -> DataFrame:
    """All active establishments, whatever their postal code."""
    return establishments.filter(F.col("etatAdministratifEtablissement") == "A").select(*_columns(F.upper(text(F.col("libelleCommuneEtablissement"))), F.col("codePostalEtablissement").cast("string")))


def partitioned_establishments(establishments: DataFrame) -> DataFrame:
    """Active establishments with a department, as the partitioned copy holds them."""
    cp = F.col("codePostalEtablissement").cast("string")
    kept = establishments.filter((F.col("etatAdministratifEtablissement") == "A") & F.col("siret").isNotNull() & cp.isNotNull() & (F.length(F.trim(cp)) >= 2) & cp.rlike("^[0-9]{2}"))
    return kept.select(*_columns(F.upper(text(F.col("libelleCommuneEtablissement"))), F.upper(cp)), F.substring(cp, 1, 2).alias("dept"))


def aligned_sample(units: DataFrame, sampled_establishments: DataFrame) -> DataFrame:
    """Legal units of the establishments of a sample."""
    keys = sampled_establishments.select("siren").filter(F.col("siren").isNotNull()).distinct()
    return units.join(keys, "siren", "left_semi")


def sample_by_key(establishments: DataFrame, one_in: int) -> DataFrame:
    """A repeatable development sample by hash of the establishment number."""
    return establishments.filter(F.pmod(F.xxhash64("siret"), F.lit(one_in)) == 0)


#: Bytes by which a company's name may differ under one postal code, and characters of a city's.
STRICT_EDITS, CITY_EDITS = 3, 2


@dataclass
class Registry:
    legal: DataFrame
    active: DataFrame
    parts: DataFrame
    index: bm25.Index
    names: DataFrame  # siren, official_name, crowded: what candidates are compared by
    plain: DataFrame | None  # clean_cp, official_name, name_bytes, times, siret: the names of each postal code; None before add_codes()
    pieced: DataFrame | None  # the same for crowded postal codes, a row for each piece of a name; None if none is crowded
    crowds: DataFrame | None  # clean_cp: the crowded ones
    cities: DataFrame | None  # city_norm of companies with crowds of establishments, a row for each piece; None if there is none
    named: DataFrame | None = None  # plain and pieced together, a row for each name; None: names are met under their codes only


def compared_names(legal: DataFrame, active: DataFrame | None) -> DataFrame:
    """Names that candidates are compared by, and whether a company has a crowd of establishments (without these: no)."""
    own = legal.select("siren", F.col("denominationUniteLegale").alias("official_name"))
    if active is None:
        return own.withColumn("crowded", F.lit(False))
    return own.join(nearby.crowded(active, ["siren"]).select("siren", F.lit(True).alias("crowded")), "siren", "left").na.fill(False, ["crowded"])


def names_by_code(legal: DataFrame, parts: DataFrame) -> DataFrame:
    """The distinct names under each postal code, how many establishments bear them, and the first of these."""
    own = parts.select("siren", "siret", F.col("codePostalEtablissement").alias("clean_cp")).join(legal.select("siren", F.col("denominationUniteLegale").alias("official_name")), "siren")
    return own.groupBy("clean_cp", "official_name").agg(F.count("*").alias("times"), F.min("siret").alias("siret")).withColumn("name_bytes", sim.as_bytes(F.col("official_name")))


def crowded_cities(active: DataFrame, names: DataFrame) -> DataFrame:
    large = names.filter("crowded").select("siren")
    own = active.join(large, "siren", "left_semi").select(normalize_city(F.col("libelleCommuneEtablissement")).alias("city_norm")).distinct()
    return nearby.known_pieces(own, "city_norm", CITY_EDITS)


def _named(named: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    crowds = nearby.crowded(named, ["clean_cp"])
    return named.join(crowds, "clean_cp", "left_anti"), nearby.known_pieces(named.join(crowds, "clean_cp", "left_semi"), "name_bytes", STRICT_EDITS), crowds


def in_memory(units: DataFrame, establishments: DataFrame, stemmer: str | None = None, stop_words: Sequence[str] = (), crowds: bool = False) -> Registry:
    """A registry as plans only; nothing is written. Crowds are sought only if asked for, since each use of the registry then seeks them."""
    legal, active, parts = active_legal_units(units), active_establishments(establishments), partitioned_establishments(establishments)
    names, named = compared_names(legal, active if crowds else None), names_by_code(legal, parts)
    paths = _named(named) if crowds else (named, None, None)
    return Registry(legal, active, parts, bm25.build(legal, stemmer=stemmer, stop_words=stop_words), names, *paths, crowded_cities(active, names) if crowds else None)


_TABLES = ("legal", "active", "postings", "vocabulary", "stats", "heads", "levels", "names")


def build(spark: SparkSession, units_path: str, establishments_path: str, out: str, *, sample_one_in: int | None = None, force: bool = False, stemmer: str | None = None, stop_words: Sequence[str] = (), codes: bool = True) -> Registry:
    """Write the registry below `out`. Samples and partitions are reused unless forced; the rest is always rebuilt.

    Without `codes` the names of each postal code are left to add_codes(), and no name can be met under a code before.
    """
    units, establishments = read_parquet(spark, units_path), read_parquet(spark, establishments_path).select(*ESTABLISHMENT_COLUMNS)
    mode = "overwrite" if force else "ignore"
    if sample_one_in:
        sample_by_key(establishments, sample_one_in).write.mode(mode).option("compression", "zstd").parquet(f"{out}/sample_establishments")
        establishments = spark.read.parquet(f"{out}/sample_establishments")
        aligned_sample(units, establishments).write.mode(mode).option("compression", "zstd").parquet(f"{out}/sample_units")
        units = spark.read.parquet(f"{out}/sample_units")
    made = {"legal": active_legal_units(units), "active": active_establishments(establishments), "parts": partitioned_establishments(establishments)}
    read, write, by = _tables(spark, out)

    def write_parts() -> None:
        # the key beside the department spreads a large department over several tasks
        spread = made["parts"].repartition("dept", F.pmod(F.xxhash64("codePostalEtablissement"), F.lit(8))).sortWithinPartitions("dept", "codePostalEtablissement")
        spread.write.mode(mode).option("compression", "zstd").partitionBy("dept").parquet(f"{out}/parts")

    def write_cities() -> None:
        if not read("names").filter("crowded").isEmpty():
            write(crowded_cities(read("active"), read("names")), "cities")
            crowded.append("companies")

    crowded: list[str] = []
    # each table is made from written ones, as soon as those it needs are there; a step stands behind those it waits for, so these have threads
    steps: dict[str, tuple[Callable[[], None], tuple[str, ...]]] = {
        # sorted by key, so that row groups' statistics prune point lookups
        "legal": (lambda: write(by(made["legal"], "siren"), "legal"), ()), "active": (lambda: write(by(made["active"], "siret"), "active"), ()), "parts": (write_parts, ()),
        "stats": (lambda: write(bm25.statistics(read("legal"), stop_words=stop_words), "stats"), ("legal",)),
        # by term and level, so that a frequent term lies in several tasks' files and a level's rows together
        "postings": (lambda: write(by(bm25.postings(read("legal"), read("stats"), stemmer=stemmer, stop_words=stop_words), "term", "level"), "postings"), ("stats",)),
        "names": (lambda: write(by(compared_names(read("legal"), read("active")), "siren"), "names"), ("legal", "active")),
        "vocabulary": (lambda: write(bm25.vocabulary(read("postings"), read("stats")), "vocabulary"), ("postings",)), "levels": (lambda: write(bm25.levels(read("postings")), "levels"), ("postings",)),
        "heads": (lambda: write(by(bm25.heads(read("postings"), read("vocabulary")), "term"), "heads"), ("vocabulary",)),
        "cities": (write_cities, ("names",)),
    }
    if codes:
        steps["codes"] = (lambda: crowded.extend(_write_codes(spark, out)), ("legal", "parts"))
    with ThreadPoolExecutor(len(steps)) as pool:
        done: dict[str, Future] = {}

        def after(step: Callable[[], None], needed: tuple[str, ...]) -> None:
            for name in needed:
                done[name].result()
            step()

        for name, (step, needed) in steps.items():
            done[name] = pool.submit(after, step, needed)
        for x in done.values():
            x.result()
    write_json_meta(spark, f"{out}/meta", {"ul_parquet": units_path, "etab_parquet": establishments_path, "partitions_root": f"{out}/parts", "stemmer": stemmer or "", "stop_words": list(stop_words), "crowded": sorted(crowded), "codes": codes})
    return load(spark, out)


def _tables(spark: SparkSession, out: str) -> tuple[Callable, Callable, Callable]:
    """read(name), write(df, name), and by(df, *keys): df dealt and sorted by its keys."""
    write = lambda df, name: df.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/{name}")
    return lambda name: spark.read.parquet(f"{out}/{name}"), write, lambda df, *keys: df.repartition(*keys).sortWithinPartitions(*keys)


def _write_codes(spark: SparkSession, out: str) -> list[str]:
    """Write the names of each postal code; ["codes"] if some code is crowded."""
    read, write, by = _tables(spark, out)
    write(by(names_by_code(read("legal"), spark.read.schema(ESTABLISHMENT_PART).parquet(f"{out}/parts")), "clean_cp"), "names_by_code")
    named = read("names_by_code")
    write(nearby.crowded(named, ["clean_cp"]), "crowds")
    if read("crowds").isEmpty():
        return []
    plain, pieced, _ = _named(named)
    write(by(plain, "clean_cp"), "plain")
    write(pieced, "pieced")
    return ["codes"]


def add_codes(spark: SparkSession, out: str) -> Registry:
    """The registry below `out` with the names of each postal code, which are written if they aren't there."""
    about = paths(spark, out)
    if not about.get("codes", True):
        write_json_meta(spark, f"{out}/meta", {**about, "crowded": sorted([*about["crowded"], *_write_codes(spark, out)]), "codes": True})
    return load(spark, out)


def load(spark: SparkSession, out: str) -> Registry:
    t = {n: spark.read.parquet(f"{out}/{n}") for n in _TABLES}
    parts = spark.read.schema(ESTABLISHMENT_PART).parquet(f"{out}/parts")  # departments stay strings
    about = paths(spark, out)
    index = bm25.Index(t["postings"], t["vocabulary"], t["stats"], t["heads"], t["levels"], about["stemmer"] or None)
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    codes, companies = ("codes" in about["crowded"], "companies" in about["crowded"])
    cities = read("cities") if companies else None
    if not about.get("codes", True):
        return Registry(t["legal"], t["active"], parts, index, t["names"], None, None, None, cities)
    return Registry(t["legal"], t["active"], parts, index, t["names"], *([read("plain"), read("pieced"), read("crowds")] if codes else [read("names_by_code"), None, None]), cities, read("names_by_code"))


def paths(spark: SparkSession, out: str) -> dict:
    return json.loads(read_json_meta(spark, f"{out}/meta"))
