"""Registry and supplier tables in the shapes of FIXTURES.md, made from the TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LEGAL_UNIT = """
SELECT lpad(CAST(p_partkey AS STRING),9,'0') AS siren,
 CASE WHEN p_partkey % 37 = 0 THEN NULL WHEN p_partkey % 41 = 0 THEN '   '
      ELSE p_name || ' ' || replace(p_brand,'#',' ') END AS "denominationUniteLegale",
 p_type AS "activitePrincipaleUniteLegale",
 CASE WHEN p_partkey % 10 = 0 THEN 'F' ELSE 'A' END AS "etatAdministratifUniteLegale" FROM part"""

ESTABLISHMENT = """
SELECT lpad(CAST(o_custkey AS STRING),9,'0') || lpad(CAST(o_orderkey % 100000 AS STRING),5,'0') AS siret,
 lpad(CAST(o_custkey AS STRING),9,'0') AS siren,
 CASE WHEN o_orderkey % 50 = 1 THEN NULL WHEN o_orderkey % 51 = 1 THEN '2A004' WHEN o_orderkey % 53 = 1 THEN '7'
      ELSE lpad(CAST(1000 + (o_orderkey * 7919) % 95000 AS STRING),5,'0') END AS "codePostalEtablissement",
 CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 'Ville ' || CAST(o_custkey % 25 AS STRING) END AS "libelleCommuneEtablissement",
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 120 + 1 AS STRING) END AS "numeroVoieEtablissement",
 CASE o_orderkey % 3 WHEN 0 THEN 'Rue' WHEN 1 THEN 'Avenue' ELSE NULL END AS "typeVoieEtablissement",
 'des ' || lower(substr(o_orderpriority,3)) AS "libelleVoieEtablissement",
 CASE WHEN o_orderkey % 11 = 0 THEN 'Bat ' || CAST(o_orderkey % 9 AS STRING) ELSE NULL END AS "complementAdresseEtablissement",
 CASE WHEN o_orderkey % 13 = 0 THEN 'BP ' || CAST(o_orderkey % 100 AS STRING) ELSE NULL END AS "distributionSpecialeEtablissement",
 CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderkey % 4 = 0 END AS "etablissementSiege",
 CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE 'A' END AS "etatAdministratifEtablissement" FROM orders"""

SUPPLIER_RAW = """
SELECT 'S' || lpad(CAST(o.o_orderkey AS STRING),8,'0') AS "Auxiliaire",
 CASE WHEN o.o_orderkey % 4 = 0 THEN replace(p.p_name,'e','ee') || ' ' || replace(p.p_brand,'#',' ') || ' SAS'
      ELSE p.p_name || ' ' || replace(p.p_brand,'#',' ') || ' sarl' END AS "Nom",
 CASE WHEN o.o_orderkey % 6 = 0 THEN '' ELSE CAST(o.o_orderkey % 120 + 1 AS STRING) || ' rue des ' || lower(substr(o.o_orderpriority,3)) END AS "Adresse 1",
 CASE WHEN o.o_orderkey % 8 = 0 THEN NULL ELSE lpad(CAST(1000 + (o.o_orderkey * 7919) % 95000 AS STRING),5,'0') END AS "Postal",
 CASE WHEN o.o_orderkey % 16 = 0 THEN NULL ELSE '  ville  ' || CAST(o.o_custkey % 25 AS STRING) END AS "Ville",
 CASE WHEN o.o_orderkey % 9 = 0 THEN lpad(CAST(o.o_custkey AS STRING),9,'0') || ' ' || lpad(CAST(o.o_orderkey % 100000 AS STRING),5,'0')
      WHEN o.o_orderkey % 9 = 1 THEN '123' ELSE NULL END AS "Code SIRET",
 CASE WHEN o.o_orderkey % 5 = 0 THEN 'FR 12 ' || lpad(CAST(o.o_custkey AS STRING),9,'0') ELSE NULL END AS "Code NIF",
 CASE o.o_orderkey % 7 WHEN 0 THEN 'FRA' WHEN 1 THEN 'DE' WHEN 2 THEN ' France ' WHEN 3 THEN 'BE' ELSE NULL END AS "Pays",
 CASE WHEN o.o_orderkey % 12 = 5 THEN NULL WHEN o.o_orderkey % 12 = 6 THEN ' nan ' ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS "Date dern. Mouvt"
 FROM orders o JOIN part p ON p.p_partkey = o.o_custkey"""


def table(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    sql = sql.replace('"', "`")
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("part", "orders") if f" {t}" in sql}
    for t in frames:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
    return spark.sql(sql, **frames)


def legal_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, LEGAL_UNIT)


def establishment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, ESTABLISHMENT)


def supplier_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, SUPPLIER_RAW)
