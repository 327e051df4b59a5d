"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Spark's own setting: a query's shuffle files go when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, one JVM gets a folder of its own; a cluster is refused."""
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="tallyweld-")
        sc.setCheckpointDir(where)
    return where.rstrip("/")


#: Paths made inside distilled(), of the thread that runs it.
_SCOPE: ContextVar[list[str] | None] = ContextVar("tables", default=None)
#: Scans of more files number their rows by writing them.
MOST_FILES = 10_000
#: Bits of a row's number that count inside its file.
_ROW_BITS = 40


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, which goes when the session's JVM ends."""
    path = f"{shared_dir(spark)}/tallyweld/{name}-{uuid.uuid4().hex}"
    fs, p = _hadoop(spark, path)
    fs.deleteOnExit(p)
    made = _SCOPE.get()
    if made is not None:
        made.append(path)
    return path


def distilled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """make()'s rows, written once; the tables that make() had written in this thread are deleted."""
    between: list[str] = []
    scope = _SCOPE.set(between)
    try:
        rows = make()
    finally:
        _SCOPE.reset(scope)
    out = materialize(rows, name)
    for path in between:
        fs, p = _hadoop(spark, path)
        fs.delete(p, True)
    return out


def _parquet_scan(df: DataFrame) -> bool:
    """Whether df is a scan of Parquet files, with columns chosen or derived but no row left out."""
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "LogicalRelation":
            kind = node.relation().getClass().getSimpleName()
            return kind == "HadoopFsRelation" and node.relation().fileFormat().getClass().getSimpleName() == "ParquetFileFormat"
        if not (node.nodeName() == "Project" and node.deterministic()):
            return False
        nodes.append(node.children().apply(0))
    return False


def numbered(df: DataFrame) -> DataFrame:
    """(row, doc): a number of its own for each row, the same each time it is read, and the row as a struct.

    A row of a Parquet scan has its file's number and its place in the file, however the scan is split
    into tasks. Anything else, and a scan of over MOST_FILES files, is numbered once and written.
    """
    if _parquet_scan(df):
        where = df.metadataColumn("_metadata")
        files = materialize(df.select(where["file_path"].alias("path")).distinct(), "files")
        if files.count() <= MOST_FILES:
            # a row a file, at most MOST_FILES
            named = F.broadcast(files.selectExpr("path", f"shiftleft(row_number() OVER (ORDER BY path) - 1L, {_ROW_BITS}) AS base"))
            rows = df.select(where["file_path"].alias("path"), where["row_index"].alias("at"), F.struct(*(F.col(_quoted(c)) for c in df.columns)).alias("doc"))
            return rows.join(named, "path").select((F.col("base") + F.col("at")).alias("row"), "doc")
    return materialize(df.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "numbered")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Writers that are under way in a session, and what the setting was before the first of them.
_WRITERS: dict[int, tuple[int, str]] = {}
_LOCK = threading.Lock()


@contextmanager
def _cleaned_up(spark: SparkSession):
    """Shuffle files go with their query while any thread of the session writes; the last one restores the setting."""
    key = id(spark._jsparkSession)
    with _LOCK:
        n, before = _WRITERS.get(key, (0, ""))
        if not n:
            before = spark.conf.get(_CLEANUP)
            spark.conf.set(_CLEANUP, "true")
        _WRITERS[key] = n + 1, before
    try:
        yield
    finally:
        with _LOCK:
            n, before = _WRITERS.pop(key)
            if n > 1:
                _WRITERS[key] = n - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once and read it back: later readers neither recompute it nor need its shuffles."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with _cleaned_up(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
