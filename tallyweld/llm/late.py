"""Late-arrival partition overwrite of a table of daily Parquet files.

A table keeps one row per key, the one that arrived last, in a folder for each day and there in files
of a fixed number of rows, in order. To lay rows out, all of them are sorted at once and numbered as
zipWithIndex numbers them: by their place in a sorted part and the rows of the parts before. A row's
number minus its day's base offset, divided by the rows of a file, is its file's number in the day.
A partitioner that takes these numbers as they are then gives each file to one task, which writes it
as a stream. Days are staged aside, made ready by one rename, and then each is renamed into its place;
a run that ends in between is finished by the next one.

Late rows touch only the days in which they stand or replace a row: no other file is read in full or written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, MapType, StructField, StructType, VariantType

from .store import materialize, shared_dir

#: Rows of a table of offsets (sorted parts and days) or of files that are still broadcast; larger ones are shuffled.
SMALL = 100_000
#: Part of a row's number that counts inside its sorted part, as monotonically_increasing_id sets it.
_PLACE_BITS = 33


def days_since_epoch(ts: Column) -> Column:
    """Whole days since 1970 (null: -1)."""
    return F.coalesce(F.unix_date(F.to_date(ts)).cast("long"), F.lit(-1).cast("long"))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a time without a zone, whatever the session's zone."""
    long = lambda c: c.cast("long")
    inside = long(F.hour(ts)) * 3_600_000_000 + long(F.minute(ts)) * 60_000_000 + long(F.extract(F.lit("SECOND"), ts) * 1_000_000)
    return long(F.unix_date(F.to_date(ts))) * 86_400_000_000 + inside


def _free(taken: list[str], name: str) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL else df


@dataclass
class DailyTable:
    """Rows of `schema` below `path`: the latest `arrival` of each `key`, by the day of `time`, sorted by time and key.

    Of rows of one key that arrived at the same time the largest by all columns stays; a null arrival
    is the earliest, a null key is a key, a null time is day -1. One writer at a time.
    """

    spark: SparkSession
    path: str
    schema: StructType
    per_file: int
    key: str = "sale_id"
    time: str = "sold_at"
    arrival: str = "arrived_at"

    def __post_init__(self) -> None:
        names = self.schema.names
        self.day, self._at, self._part, self._file = (_free(names, x) for x in ("day", "place_at", "sorted_part", "file_at"))

    # ---- rows

    def _columns(self) -> list[Column]:
        return [F.col(_q(c)) for c in self.schema.names]

    def _order(self) -> Column:
        """What the last row of a key is the largest of."""
        rest = [f.name for f in self.schema.fields if f.name not in (self.arrival, self.time) and not isinstance(f.dataType, (MapType, VariantType))]
        return F.struct(*(F.col(_q(c)) for c in (self.arrival, self.time, *rest)))

    def latest(self, rows: DataFrame) -> DataFrame:
        """One row per key, combined before the shuffle, with its day."""
        one = rows.groupBy(F.col(_q(self.key)).alias("k")).agg(F.max_by(F.struct(*self._columns()), self._order()).alias("r"))
        return one.select("r.*").withColumn(self.day, days_since_epoch(F.col(_q(self.time))))

    def read(self) -> DataFrame:
        """The rows, with their day."""
        return self.spark.read.schema(StructType([*self.schema.fields, StructField(self.day, LongType())])).parquet(self.path)

    def files(self) -> DataFrame:
        """(day, file_no, path) of the files that are there."""
        df = self.read()
        named = df.select(F.col(self.day).alias("day"), df.metadataColumn("_metadata")["file_path"].alias("path")).distinct()
        # a file's part is its task's number, so parts of a day follow each other
        part = F.regexp_extract("path", "/part-([0-9]+)-[^/]*$", 1).cast("long")
        return named.withColumn("p", part).selectExpr("day", "cast(row_number() OVER (PARTITION BY day ORDER BY p) - 1 AS long) AS file_no", "path")

    # ---- layout

    def _placed(self, rows: DataFrame) -> tuple[DataFrame, int, set[int]]:
        """rows with the number of their file, how many files there are, and their days."""
        keys = [F.col(_q(c)) for c in (self.day, self.time, self.key)]
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # sorted once and written: what counts the parts and what numbers their rows read the same
        held = materialize(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn(self._at, F.monotonically_increasing_id()), "sorted")
        part = F.shiftright(F.col(self._at), _PLACE_BITS)
        counts = materialize(held.groupBy(part.alias("part"), F.col(self.day).alias("day")).agg(F.count("*").alias("n"), F.min(self._at).alias("first")), "counts")
        # a row a sorted part and day, so as few as parts and days together
        offsets = self.spark.sql(
            f"""WITH o AS (SELECT *, sum(n) OVER (ORDER BY part, day) - n AS index FROM {{counts}}),
               d AS (SELECT day, min(index) AS base, sum(n) AS n FROM o GROUP BY day),
               f AS (SELECT *, ceil(n / {self.per_file}) AS files FROM d),
               g AS (SELECT day, base, sum(files) OVER (ORDER BY day) - files AS before, sum(files) OVER () AS total FROM f)
               SELECT part, day, index - first - base AS shift, cast(before AS long) AS before, cast(total AS long) AS total FROM o JOIN g USING (day)""",
            counts=counts,
        )
        offsets = materialize(offsets, "offsets")
        found = offsets.agg(F.count("*").alias("n"), F.max("total").alias("total"), F.collect_set("day").alias("days")).first()
        asked = offsets.select(F.col("part").alias(self._part), F.col("day").alias("d"), "shift", "before")
        r = held.withColumn(self._part, part)
        joined = r.join(_small(asked, found.n), (r[self._part] == asked[self._part]) & (r[self.day] == asked["d"]))
        file = F.floor((F.col(self._at) + F.col("shift")) / self.per_file) + F.col("before")
        return joined.select(*(r[_q(c)] for c in (*self.schema.names, self.day)), file.cast("int").alias(self._file)), int(found.total or 0), set(found.days)

    def _lay_out(self, rows: DataFrame, days: set[int] | None) -> set[int]:
        """Write rows' layout in place of these days (None: of the days that rows have)."""
        staged, ready = (f"{self.path}/_{x}-{uuid.uuid4().hex}" for x in ("staged", "ready"))
        placed, files, have = self._placed(rows)
        fs, at = self._fs()
        if files:
            sort = [F.col(_q(c)) for c in (self.day, self.time, self.key)]
            own = placed.repartitionById(files, F.col(self._file)).sortWithinPartitions(*sort).drop(self._file)
            own.write.partitionBy(self.day).option("compression", "zstd").option("maxRecordsPerFile", 0).parquet(staged)
        else:
            fs.mkdirs(at(staged))
        for day in (days or set()) - have:
            fs.mkdirs(at(f"{staged}/{self.day}={day}"))
        self._rename(staged, ready)
        self._publish(ready)
        return have if days is None else days

    def write(self, rows: DataFrame) -> set[int]:
        """The layout of rows where nothing is yet. Gives the days."""
        fs, at = self._fs()
        fs.mkdirs(at(self.path))
        return self._lay_out(self.latest(rows.select(*self._columns())), None)

    def overwrite(self, late: DataFrame) -> set[int]:
        """The layout of what stands and of late rows together. Gives the days that were written anew."""
        self.recover()
        key = F.col(_q(self.key))
        new = self.latest(late.select(*self._columns())).select(key.alias("new_key"), F.struct("*").alias("row"), self._order().alias("rank"))
        stands = self.read()
        old = stands.select(key.alias("old_key"), F.col(self.day).alias("old_day"), self._order().alias("old_rank"))
        met = new.join(old, new["new_key"].eqNullSafe(old["old_key"]), "left")
        kept = materialize(met.filter(F.col("old_rank").isNull() | (F.col("rank") > F.col("old_rank"))).select("new_key", "row", "old_day"), "kept")
        days = {r.d for r in kept.select(F.explode(F.array(F.col("row")[self.day], "old_day")).alias("d")).filter("d IS NOT NULL").distinct().collect()}
        if not days:
            return set()
        gone = kept.select("new_key").hint("merge")
        stay = stands.filter(F.col(self.day).isin(list(days))).join(gone, key.eqNullSafe(gone["new_key"]), "left_anti")
        return self._lay_out(stay.unionByName(kept.select("row.*")), days)

    # ---- folders

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _rename(self, a: str, b: str) -> None:
        fs, at = self._fs()
        if not fs.rename(at(a), at(b)):
            raise OSError(f"can't rename {a} to {b}")

    def _publish(self, ready: str) -> None:
        """Each staged day takes the place of what is there; an empty one only removes it. May be run again."""
        fs, at = self._fs()
        old = ready.replace("/_ready-", "/_old-")
        fs.mkdirs(at(old))
        for day in sorted(x.getPath().getName() for x in fs.listStatus(at(ready)) if x.isDirectory()):
            there = f"{self.path}/{day}"
            if fs.exists(at(there)):
                self._rename(there, f"{old}/{day}")
            if len(fs.listStatus(at(f"{ready}/{day}"))):
                self._rename(f"{ready}/{day}", there)
            else:
                fs.delete(at(f"{ready}/{day}"), True)
        fs.delete(at(ready), True)
        fs.delete(at(old), True)

    def recover(self) -> None:
        """Finish what an earlier run had made ready, and forget what it had only staged."""
        fs, at = self._fs()
        if not fs.exists(at(self.path)):
            return
        names = [x.getPath().getName() for x in fs.listStatus(at(self.path))]
        for name in sorted(names):
            if name.startswith("_ready-"):
                self._publish(f"{self.path}/{name}")
        for name in names:
            if name.startswith(("_staged-", "_old-")) and fs.exists(at(f"{self.path}/{name}")):
                fs.delete(at(f"{self.path}/{name}"), True)


def digests(table: DataFrame, files: DataFrame, key: str, cents: Column, crc: Column) -> DataFrame:
    """(path, n_rows, cents, rows_crc, ids_sha256) of each file, read back: one task a file, its rows in order, as a stream."""
    import hashlib

    meta = table.metadataColumn("_metadata")
    rows = table.select(meta["file_path"].alias("path"), meta["row_index"].alias("at"), F.coalesce(F.col(_q(key)).cast("string"), F.lit("")).alias("id"), cents.alias("cents"), crc.alias("crc"))
    held = materialize(files.selectExpr("*", "cast(row_number() OVER (ORDER BY day, file_no) - 1 AS int) AS nr"), "files")
    n = held.count()
    if not n:
        return table.sparkSession.createDataFrame([], "path string, n_rows long, cents long, rows_crc long, ids_sha256 string")
    dealt = rows.join(_small(held.select("path", "nr"), n), "path").repartitionById(n, F.col("nr")).sortWithinPartitions("at").drop("nr", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, rows, cents, crc, ids = None, 0, 0, 0, hashlib.sha256()
        for b in batches:
            if b.num_rows:
                path = b.column("path")[0].as_py()
                ids.update((("," if rows else "") + ",".join(b.column("id").to_pylist())).encode())
                rows += b.num_rows
                cents += sum(b.column("cents").to_pylist())
                crc += sum(b.column("crc").to_pylist())
        if rows:
            yield pa.RecordBatch.from_pydict({"path": [path], "n_rows": [rows], "cents": [cents], "rows_crc": [crc], "ids_sha256": [ids.hexdigest()]})

    return dealt.mapInArrow(run, "path string, n_rows long, cents long, rows_crc long, ids_sha256 string")


#: Files of a day have 1 + floor(rows / SHARE) rows.
SHARE = 900
EARLY = "2024-03-01 00:00:00"


def in_utc(df: DataFrame) -> DataFrame:
    """Times with a zone as times of UTC without one."""
    kinds = dict(df.dtypes)
    return df.select(*(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(_q(c)).cast("timestamp_ntz")).alias(c) if kinds[c] == "timestamp" else F.col(_q(c)) for c in df.columns))


def with_copies(sales: DataFrame) -> DataFrame:
    """The rows, and later copies of some of them as the contract has it."""
    h, day = F.crc32(F.col("sale_id").cast("string")), days_since_epoch(F.col("sold_at"))
    kinds = dict(sales.dtypes)
    later = lambda c, n: F.col(c) + F.make_dt_interval(n.cast("int"))
    new = {"total": (F.col("total") + 1).cast(kinds["total"]), "sold_at": later("sold_at", h % 2), "arrived_at": later("arrived_at", 1 + h % 97)}
    row, copy = F.struct(*(F.col(_q(c)).alias(c) for c in sales.columns)), F.struct(*(new.get(c, F.col(_q(c))).alias(c) for c in sales.columns))
    return sales.select(F.inline(F.when((h % 3 == 0) & (day % 10 == 0), F.array(row, copy)).otherwise(F.array(row))))


def late_overwrite(sales: DataFrame, path: str) -> tuple[DailyTable, set[int]]:
    """The table of early rows at `path`, then overwritten by the late ones; the days that were written anew."""
    sales = in_utc(sales)
    table = DailyTable(sales.sparkSession, path, sales.schema, 1 + sales.count() // SHARE)
    rows = with_copies(sales)
    early = F.coalesce(F.col("arrived_at") < F.lit(EARLY).cast("timestamp_ntz"), F.lit(False))
    table.write(rows.filter(early))
    return table, table.overwrite(rows.filter(~early))


def op11_late_overwrite(spark, sf_dir: str) -> DataFrame:
    """The final files of the table of sales, with digests of what they hold; they stay where they are."""
    path = f"{shared_dir(spark)}/tallyweld-daily/{uuid.uuid4().hex}"
    table, anew = late_overwrite(spark.read.parquet(f"{sf_dir}/sales.parquet"), path)
    micros = lambda c: F.coalesce(epoch_micros(F.col(c)).cast("string"), F.lit(""))
    cents = F.coalesce(F.floor(100 * F.col("total") + 0.5), F.lit(0)).cast("long")
    crc = F.crc32(F.concat_ws(":", F.coalesce(F.col("sale_id").cast("string"), F.lit("")), micros("sold_at"), micros("arrived_at")))
    files = table.files()
    made = digests(table.read(), files, "sale_id", cents, crc)
    plain = F.regexp_replace("path", "^file:/+", "/")
    out = files.join(made, "path").select("day", "file_no", "n_rows", "cents", "rows_crc", plain.alias("path"), F.lit(",".join(table.schema.names)).alias("columns"), "ids_sha256", F.col("day").isin(list(anew)).alias("rewritten"))
    return materialize(out, "op11")
