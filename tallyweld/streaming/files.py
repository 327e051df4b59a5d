"""Supplier files as a stream: each micro-batch is matched and appended to the state."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import matching
from ..operators.state import StateStore, pending
from ..operators.suppliers import with_input_id
from ..plans.registry import Registry


def match_files(spark: SparkSession, folder: str, schema: StructType, registry: Registry, state: str, checkpoint: str, *, files_per_batch: int = 10) -> StreamingQuery:
    """Match all files of a folder, a few per micro-batch, and end; the checkpoint remembers files, the state ids.

    A micro-batch's append bears the stream's name and the batch's number. One that is run again, as it
    ended after its append and before the checkpoint knew, finds its append there and does nothing.
    """
    store = StateStore(spark, state)
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def commit(batch: DataFrame, number: int) -> None:
        run = f"stream.{stream}.{number}"
        if store.has_run(run):
            return
        left = pending(with_input_id(batch), store.read())
        if not left.isEmpty():
            store.upsert_results(matching.match(left, registry), run)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return rows.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
