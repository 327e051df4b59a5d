"""Supplier rows: column recognition, ids, cleaning, country split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import country as geo, text as tx
from ..functions.vocab import COLUMN_ALIASES

REQUIRED = ("Nom", "Postal", "Ville")
#: Number of a supplier row: ids repeat, and each row is judged alone.
ROW = "__row"


def identify_columns(columns: list[str]) -> dict[str, str]:
    """Standard name -> actual heading, by aliases that ignore case; of equal headings the last counts."""
    by_upper = {c.upper(): c for c in columns}
    found = {name: next((by_upper[a] for a in aliases if a in by_upper), None) for name, aliases in COLUMN_ALIASES.items()}
    return {k: v for k, v in found.items() if v is not None}


def require_columns(columns: list[str]) -> dict[str, str]:
    found = identify_columns(columns)
    missing = [c for c in REQUIRED if c not in found]
    if missing:
        raise ValueError(f"missing columns {missing}; found {columns}")
    return found


def optional(df: DataFrame, *names: str | None) -> list[Column]:
    """The named columns, null where df lacks one."""
    return [F.col(f"`{n}`") if n and n in df.columns else F.lit(None).cast("string") for n in names]


def with_input_id(df: DataFrame) -> DataFrame:
    """One id for every stage: Auxiliaire, else input_id, else Code tiers, else index, else a hash of the row."""
    ids = optional(df, "Auxiliaire", "input_id", "Code tiers", "index")
    row = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))), 256)
    return df.withColumn("input_id", tx.first_filled(*ids, F.concat(F.lit("row-"), row)))


def by_given_id(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """with_input_id() in two parts: rows that hold an id, which is read without their other columns, and rows that don't."""
    given = tx.first_filled(*optional(df, "Auxiliaire", "input_id", "Code tiers", "index"))
    return df.filter(given != "").withColumn("input_id", given), with_input_id(df.filter(given == ""))


def _cleaned_columns(df: DataFrame) -> dict[str, Column]:
    name, siret, vat, a1, a2, a3, postal, city = optional(df, "Nom", "Code SIRET", "Code NIF", "Adresse 1", "Adresse 2", "Adresse 3", "Postal", "Ville")
    kinds = dict(df.dtypes)
    numeric = lambda c: kinds.get(c, "string") in ("int", "bigint", "double", "float", "smallint")
    cp = tx.clean_cp_number(postal) if numeric("Postal") else tx.clean_cp(postal, a1)
    number = F.col("`Code SIRET`").cast("decimal(20,0)").cast("string") if numeric("Code SIRET") else siret
    number = F.when(F.length(tx.padded(number, 14)) == 14, tx.padded(number, 14)) if numeric("Code SIRET") else tx.extract_siret(siret)
    return {"siret": number, "siren_from_vat": tx.siren_from_vat(vat), "raw_name": tx.text(name), "clean_name": tx.clean_name(name), "clean_cp": cp, "clean_city": tx.clean_city(city), "city_norm": tx.normalize_city(city), "supplier_address": tx.normalize_addr(a1, a2, a3)}


def _select(df: DataFrame, *names: str) -> DataFrame:
    made = _cleaned_columns(df)
    return df.select("input_id", *(c for c in (ROW,) if c in df.columns), *(made[n].alias(n) for n in names))


def cleaned(df: DataFrame) -> DataFrame:
    """The heuristic cleaner's columns and the location columns the matcher compares with.

    A column ROW, which tells supplier rows apart, is kept.
    """
    out = _select(df, "siret", "siren_from_vat", "clean_name", "clean_cp", "clean_city", "city_norm", "supplier_address")
    return out.select("*", tx.search_token(F.col("clean_name")).alias("search_token"), F.coalesce("clean_city", "city_norm").alias("supplier_city")).drop("city_norm")


def located(df: DataFrame) -> DataFrame:
    """cleaned() without names and numbers: input_id, raw_name, clean_cp, supplier_city, supplier_address. Names wait for cleaned_names()."""
    out = _select(df, "raw_name", "clean_cp", "clean_city", "city_norm", "supplier_address")
    return out.withColumn("supplier_city", F.coalesce("clean_city", "city_norm")).drop("clean_city", "city_norm")


def cleaned_names(rows: DataFrame) -> DataFrame:
    """(raw_name, clean_name, search_token) of the distinct names of located() rows."""
    distinct = rows.select("raw_name").distinct()
    return distinct.withColumn("clean_name", tx.clean_name(F.col("raw_name"))).withColumn("search_token", tx.search_token(F.col("clean_name")))


@dataclass
class Split:
    french: DataFrame
    other: DataFrame
    stats: DataFrame  # one row


def preprocess(df: DataFrame, *, filter_inactive: bool = True, limit: int | None = None) -> Split:
    """Drop inactive suppliers and split the rest by country. The halves are disjoint and complete."""
    found = require_columns(df.columns)
    df = df if limit is None else df.limit(limit)
    siret, pays, city, postal, last = optional(df, *(found.get(k) for k in ("Code SIRET", "Pays", "Ville", "Postal", "Date dern. Mouvt")))
    place = geo.final_country(pays if "Pays" in found else None, geo.infer_country(siret, pays, city, postal))
    active = geo.is_active(last) if filter_inactive and "Date dern. Mouvt" in found else F.lit(True)
    tagged = df.withColumn("__active", active).withColumn("__french", place == "FRANCE")
    kept = tagged.filter("__active")
    stats = tagged.agg(
        F.count("*").alias("total_original"), F.count_if(~F.col("__active")).alias("filtered_inactive"), F.count_if(F.col("__active") & F.col("__french")).alias("french_suppliers"),
        F.count_if(F.col("__active") & ~F.col("__french")).alias("non_french_suppliers"), F.count_if("__active").alias("total_processed"),
    )
    half = lambda french: kept.filter(F.col("__french") == french).drop("__active", "__french")
    return Split(half(True), half(False), stats)
