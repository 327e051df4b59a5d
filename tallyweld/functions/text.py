"""Normalisation and extraction as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .vocab import LEGAL_FORMS

_DIGITS = r"(?U)\D+"


def as_text(c: Column) -> Column:
    """A string, empty for null and NaN."""
    s = c.cast("string")
    return F.when(s.isNull() | (s == "NaN"), "").otherwise(s)


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any script."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def digits_only(c: Column) -> Column:
    return F.regexp_replace(text(c), _DIGITS, "")


def collapse(c: Column) -> Column:
    """Runs of white space become one space; ends are stripped."""
    return F.trim(F.regexp_replace(text(c), r"(?U)\s+", " "))


def normalize_city(c: Column) -> Column:
    return F.upper(collapse(c))


def normalize_addr(*parts: Column) -> Column:
    """Non-blank parts joined by a space, then as a city."""
    filled = [F.when(strip(text(p)) != "", text(p)) for p in parts]
    return F.upper(collapse(F.concat_ws(" ", *filled)))


def registry_address(*parts: str) -> Column:
    """The registry's address: inner double spaces of missing parts stay."""
    return F.upper(F.trim(F.concat(*(x for i, p in enumerate(parts) for x in ([F.lit(" ")] if i else []) + [text(F.col(p))]))))


def padded(c: Column, width: int) -> Column:
    """Left-padded with zeros, never truncated."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def extract_siret(c: Column, numeric: bool = False) -> Column:
    """The 14 digits of an establishment number; of a number, with leading zeros put back."""
    if numeric:
        d = padded(F.expr(f"try_cast({c._jc.toString()} AS bigint)").cast("string"), 14)
    else:
        d = digits_only(c)
    return F.when(F.length(d) == 14, d)


def siren_from_vat(c: Column) -> Column:
    """The company number inside a French VAT number."""
    s = F.upper(strip(text(c)))
    exact = F.regexp_extract(F.replace(s, F.lit(" "), F.lit("")), r"(?U)\bFR\s*\d{2}\s*(\d{9})\b", 1)
    digits = digits_only(s)
    return F.coalesce(blank_to_null(exact), F.when((F.length(digits) >= 9) & F.startswith(s, F.lit("FR")), F.right(digits, F.lit(9))))


def strip_legal_forms(c: Column) -> Column:
    return collapse(F.regexp_replace(text(c), rf"(?iuU)\b({'|'.join(LEGAL_FORMS)})\b", " "))


def clean_name(c: Column) -> Column:
    return F.upper(strip_legal_forms(c))


def search_token(name: Column) -> Column:
    """The longest A-Z0-9 token that is no legal form (the first of equals), else the name's start."""
    tokens = F.filter(F.regexp_extract_all(name, F.lit("[A-Z0-9]+"), 0), lambda t: ~t.isin(LEGAL_FORMS))
    longest = F.aggregate(tokens, F.lit(""), lambda a, t: F.when(F.length(t) > F.length(a), t).otherwise(a))
    return F.coalesce(blank_to_null(longest), blank_to_null(F.substring(name, 1, 20)), F.lit("UNKNOWN"))


def extract_cp(c: Column) -> Column:
    """The first five-digit number, if it is not 00000."""
    cp = F.regexp_extract(text(c), r"(?U)\b(\d{5})\b", 1)
    return F.when((cp != "") & (cp != "00000"), cp)


def clean_cp(postal: Column, address: Column) -> Column:
    return F.coalesce(extract_cp(postal), extract_cp(address))


def clean_cp_number(postal: Column) -> Column:
    """A postal code that was stored as a number."""
    return padded(postal.cast("bigint").cast("string"), 5)


def clean_city(c: Column) -> Column:
    return blank_to_null(normalize_city(c))


def first_filled(*cs: Column) -> Column:
    """The first that is neither null nor empty; empty if there is none."""
    return F.coalesce(*(blank_to_null(text(c)) for c in cs), F.lit(""))


def json_list(c: Column) -> Column:
    """An array of strings as JSON text with a space after each comma."""
    quoted = F.transform(c, lambda x: F.concat(F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def search_query(name: Column, city: Column, country: Column) -> Column:
    known = F.when((text(country) != "") & (country != "UNKNOWN"), country)
    return F.concat_ws(" ", name, blank_to_null(text(city)), known)


def json_ready(c: Column, kind: T.DataType) -> Column:
    """A value as JSON can hold it, at any depth: NaN and infinities null, dates and times as ISO text."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.regexp_replace(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(json_ready(c[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: json_ready(x, kind.elementType))
    if isinstance(kind, T.MapType):
        # of keys only dates and times have another text in JSON
        timed = isinstance(kind.keyType, (T.DateType, T.TimestampType, T.TimestampNTZType))
        named = F.transform_keys(c, lambda k, _: json_ready(k, kind.keyType)) if timed else c
        return F.transform_values(named, lambda _, v: json_ready(v, kind.valueType))
    return c


def serializable(df, name: str) -> Column:
    """A column as JSON can hold it, nested values included; the projection follows the column's schema."""
    return json_ready(F.col(f"`{name}`"), df.schema[name].dataType).alias(name)
