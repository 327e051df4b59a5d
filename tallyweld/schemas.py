"""Column layouts of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


LEGAL_UNIT = strings("siren", "denominationUniteLegale", "activitePrincipaleUniteLegale", "etatAdministratifUniteLegale")
ADDRESS_PARTS = ("numeroVoieEtablissement", "typeVoieEtablissement", "libelleVoieEtablissement", "complementAdresseEtablissement", "distributionSpecialeEtablissement")
ESTABLISHMENT_COLUMNS = ("siret", "siren", "codePostalEtablissement", "libelleCommuneEtablissement", *ADDRESS_PARTS, "etablissementSiege", "etatAdministratifEtablissement")
ESTABLISHMENT_PART = T.StructType([*strings("siret", "siren", "libelleCommuneEtablissement", "codePostalEtablissement", "address"), T.StructField("is_siege", T.BooleanType()), T.StructField("dept", T.StringType())])
SUPPLIER_COLUMNS = ("Auxiliaire", "Nom", "Adresse 1", "Adresse 2", "Adresse 3", "Postal", "Ville", "Code SIRET", "Code NIF", "Code NAF", "Pays", "Date dern. Mouvt", "Code tiers", "input_id", "index")
#: The 15 columns of every result file.
UNIFIED_COLUMNS = ("input_id", "resolved_siret", "official_name", "confidence_score", "match_method", "alternatives", "found_website", "found_address", "found_phone", "found_email", "country", "city", "postal_code", "search_method", "error")
UNIFIED = T.StructType([T.StructField(n, T.DoubleType() if n == "confidence_score" else T.StringType()) for n in UNIFIED_COLUMNS])
CHECKPOINT = T.StructType([*strings("input_id", "resolved_siret", "official_name"), T.StructField("confidence_score", T.DoubleType()), *strings("match_method", "alternatives_json", "error"), T.StructField("updated_at_epoch", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("run", T.StringType())])
CLEANED = strings("clean_name", "search_token", "clean_cp", "clean_city")
FOUND = T.StructType([*strings("website", "address", "phone", "email"), T.StructField("confidence", T.DoubleType())])
