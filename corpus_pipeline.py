"""A corpus pipeline: quality rules, exact dedup, near-duplicate groups, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the
last return the columns of documents. doc_id tells rows apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyweld.llm.exact import drop_copies
from tallyweld.llm.jaccard import similar_groups
from tallyweld.llm.mixing import take
from tallyweld.llm.packing import pack
from tallyweld.llm.quality import keep_good
from tallyweld.llm.store import materialize
from tallyweld.sources.tables import distilled


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and short texts fail; long ones are judged whole; repeated rows get one verdict, and a
    null id or source changes nothing.
    """
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id; of rows with equal text and id, one.

    Null and empty texts are equal; a null id is the smallest.
    """
    return drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at 0.75 on five-word shingles, the one with the smallest doc_id.

    Null and wordless texts are linked with nothing and stay; a null id is the smallest. Of repeated ids
    all rows with the kept id stay.
    """
    first = distilled(spark, lambda: similar_groups(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__first")), "first")
    # as many ids as documents stay: no broadcast, whatever the size
    return docs.join(first.hint("merge"), docs["doc_id"].eqNullSafe(first["__first"]), "left_semi")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix's shards draw them, by shard and place: some twice, some not, the last of a source in part.

    Null and wordless texts are not drawn; a null source is a source; each of several equal rows is drawn for itself.
    """
    return take(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens. Null and empty texts are one token; long ones are cut; null and repeated ids are kept apart by row."""
    return pack(docs)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_dedup), ("near duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]
#: Packing needs a tokenizer, which SQL can't express; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written before the next one reads it. An empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
