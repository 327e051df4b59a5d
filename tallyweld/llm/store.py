"""Written tables (of the library), sizes, and the session's Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import materialize, numbered, shared_dir

__all__ = ["bounded_batches", "materialize", "numbered", "shared_dir", "total_bytes"]

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column over all rows; sizes the number of blocks."""
    return df.selectExpr(f"coalesce(sum(octet_length(`{column}`)), 0) as n").first()["n"]


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of some MB whatever the length of the texts (one row may exceed it), where the session sets no size itself."""
    if not spark.sparkContext.getConf().contains(_BATCH):
        spark.conf.set(_BATCH, str(4 << 20))
