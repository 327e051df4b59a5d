"""Python work on one group of rows at a time, whatever the number of groups that a task gets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of input text that one task's groups come from, about, beyond the session's number of shuffle partitions.
TASK_BYTES = 1 << 28


def partitions(spark: SparkSession, groups: int, total: int) -> int:
    """Tasks for `groups` groups made from `total` bytes of text."""
    return max(1, min(groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // TASK_BYTES)))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """(key, its batches) of batches in which equal keys follow each other; each key's batches are to be read before the next."""
    source = iter(batches)
    rest: list[pa.RecordBatch] = []  # what was read and not yet given out

    def more() -> bool:
        while not rest:
            batch = next(source, None)
            if batch is None:
                return False
            if batch.num_rows:
                rest.append(batch)
        return True

    def own(k: int) -> Iterator[pa.RecordBatch]:
        while more():
            batch = rest.pop()
            other = np.flatnonzero(batch.column(key).to_numpy() != k)
            n = int(other[0]) if len(other) else batch.num_rows
            if n < batch.num_rows:
                rest.append(batch.slice(n))
            if n:
                yield batch.slice(0, n)
            if n < batch.num_rows:
                return

    while more():
        k = int(rest[0].column(key)[0].as_py())
        yield k, own(k)


def by_group(df: DataFrame, f: Callable[[int, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], out: str, tasks: int, key: str = "grp") -> DataFrame:
    """f(group, its batches) for each group of df's rows. Groups are sorted by Spark, which spills, and streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, own in runs(batches, key):
            yield from f(k, own)
            for _ in own:  # whatever f left
                pass

    return df.repartition(tasks, key).sortWithinPartitions(key).mapInArrow(run, out)
