"""Readers: parquet, CSV with null tokens and encodings, Excel where a reader is installed."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strip
from .splits import read_csv_splits

#: Spellings that mean a missing value in CSV files.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def null_tokens(df: DataFrame) -> DataFrame:
    """Spellings of missing values become null in all string columns."""
    kinds = dict(df.dtypes)
    return df.select(*(F.when(~strip(F.col(f"`{c}`")).isin(NULL_TOKENS), F.col(f"`{c}`")).alias(c) if kinds[c] == "string" else F.col(f"`{c}`") for c in df.columns))


def _bytes(spark: SparkSession, path: str) -> int:
    """Size of the files that a path or pattern names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(fs.getContentSummary(x.getPath()).getLength() for x in fs.globStatus(p) or [])


def read_csv(spark: SparkSession, path: str, sep: str = ",", split_bytes: int | None = None) -> DataFrame:
    """All columns as text: a row that is no UTF-8 is read as Latin-1, and so is a heading.

    Files of more than split_bytes (the session's maxPartitionBytes if unset) in all are read by several tasks each.
    """
    # Latin-1 keeps every byte, and what separates cells is the same byte in both
    raw = spark.read.option("header", True).option("inferSchema", False).option("sep", sep).option("multiLine", True).option("escape", '"').option("encoding", "ISO-8859-1").csv(path)
    most = split_bytes if split_bytes is not None else spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if len(sep) == 1 and _bytes(spark, path) > most:
        raw = read_csv_splits(spark, path, raw.columns, sep)
    cells = {c: F.encode(F.col(f"`{c}`"), "ISO-8859-1").cast("string") for c in raw.columns}
    good = F.lit(True)
    for x in cells.values():
        good = good & F.coalesce(F.is_valid_utf8(x), F.lit(True))
    return null_tokens(raw.select(*(F.when(good, x).otherwise(F.col(f"`{c}`")).alias(_heading(c)) for c, x in cells.items())))


def _heading(name: str) -> str:
    try:
        return name.encode("latin-1").decode("utf-8").removeprefix("\ufeff")
    except UnicodeError:
        return name


def read_excel(spark: SparkSession, path: str) -> DataFrame:
    """A sheet by way of the driver; workbooks are small by format. Needs pandas' Excel engine."""
    import pandas as pd

    frame = pd.read_excel(path, dtype=str)
    return null_tokens(spark.createDataFrame(frame.astype(object).where(frame.notna(), None), schema=", ".join(f"`{c}` string" for c in frame.columns)))


def load_suppliers(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """A supplier file by its suffix."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    df = read_parquet(spark, path) if kind == "parquet" else read_csv(spark, path) if kind == "csv" else read_excel(spark, path)
    return df if limit is None else df.limit(limit)


def write_json_meta(spark: SparkSession, path: str, values: dict) -> None:
    spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json_meta(spark: SparkSession, path: str) -> str:
    return spark.read.text(path).first()["value"]
