"""State levels, streams that end in between, CSV by splits, row groups, time slots, nested JSON values."""

import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallyweld.functions import text as tx
from tallyweld.operators import state as st
from tallyweld.sources import clients, readers, splits

cloudpickle.register_pickle_by_value(sys.modules[__name__])
RESULT = "input_id string, resolved_siret string, official_name string, confidence_score double, match_method string, alternatives_json string"


def test_levels_hold_the_state(spark, tmp_path, monkeypatch):
    """Few runs after many appends, errors and results mixed; the state is that of plain Python."""
    monkeypatch.setattr(st, "FAN_IN", 3)
    store, want, r = st.StateStore(spark, f"{tmp_path}/state"), {}, random.Random(1)
    for i in range(14):
        ids = r.sample("abcdef", 3)
        if i % 3 == 2:
            store.upsert_errors(spark.createDataFrame([(x, f"e{i}") for x in ids], "input_id string, error string"))
            for x in ids:
                want[x] = (want.get(x, (None, None))[0], f"e{i}")
        else:
            store.upsert_results(spark.createDataFrame([(x, f"{i}", "n", 1.0, "m", "[]") for x in ids], RESULT))
            for x in ids:
                want[x] = (f"{i}", None)
    assert {x.input_id: (x.resolved_siret, x.error) for x in store.read().collect()} == want
    assert len(store.runs()) <= 6 and store.attempts().count() <= 2 * 6 * 3
    assert store.next_seq() == 15


def test_names_after_a_thousand_appends(spark, tmp_path, monkeypatch):
    """The levels' arithmetic, without the writing: a bounded number of runs."""
    store, there = st.StateStore(spark, f"{tmp_path}/state"), []
    monkeypatch.setattr(st.StateStore, "runs", lambda self: sorted(there))
    monkeypatch.setattr(st.StateStore, "_publish", lambda self, rows, name: there.append(name))
    monkeypatch.setattr(st.StateStore, "_forget", lambda self, names: [there.remove(x) for x in names])
    monkeypatch.setattr(st, "merged", lambda df: df)

    class Reader:
        schema = parquet = lambda self, *a: self

    monkeypatch.setattr(type(spark), "read", Reader())
    most = 0
    for i in range(1, 1001):
        there.append(f"run-{i:012d}-x{i}")
        store._merge()
        most = max(most, len(there))
    assert most <= st.FAN_IN * 4 and store.next_seq() == 1001


def test_crash_between_merge_and_delete(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "FAN_IN", 3)
    store = st.StateStore(spark, f"{tmp_path}/state")
    one = lambda i: spark.createDataFrame([("a", f"{i}", "n", 1.0, "m", "[]"), (f"x{i}", "0", "n", 1.0, "m", "[]")], RESULT)
    forget = st.StateStore._forget

    def dies(self, names):
        raise KeyboardInterrupt

    for i in range(2):
        store.upsert_results(one(i), f"batch.{i}")
    monkeypatch.setattr(st.StateStore, "_forget", dies)
    with pytest.raises(KeyboardInterrupt):
        store.upsert_results(one(2), "batch.2")
    assert len(store.runs()) == 4
    state = lambda: {x.input_id: x.resolved_siret for x in store.read().collect()}
    assert state() == {"a": "2", "x0": "0", "x1": "0", "x2": "0"}
    monkeypatch.setattr(st.StateStore, "_forget", forget)
    store.upsert_results(one(2), "batch.2")  # its append is there
    store.upsert_results(one(3), "batch.3")
    assert state() == {"a": "3", "x0": "0", "x1": "0", "x2": "0", "x3": "0"} and len(store.runs()) <= 2
    assert all(store.has_run(f"batch.{i}") for i in range(4)) and not store.has_run("batch.4")


def test_stream_that_dies_after_its_append(spark, tmp_path, monkeypatch):
    """A micro-batch that is run again is not matched again."""
    from pyspark.sql.types import StringType, StructField, StructType

    from tallyweld.operators import matching
    from tallyweld.streaming import files

    schema = StructType([StructField("Auxiliaire", StringType()), StructField("Nom", StringType())])
    for i in range(2):
        spark.createDataFrame([(f"s{i}", "n")], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    calls, append = [], st.StateStore._append

    def match(rows, registry):
        calls.append(sorted(x.input_id for x in rows.select("input_id").collect()))
        return rows.select("input_id", F.lit("1").alias("resolved_siret"))

    def dies(self, rows, run=None):
        append(self, rows, run)
        raise RuntimeError("the driver dies here")

    monkeypatch.setattr(matching, "match", match)
    monkeypatch.setattr(st.StateStore, "_append", dies)
    run = lambda: files.match_files(spark, f"{tmp_path}/in", schema, None, f"{tmp_path}/state", f"{tmp_path}/check", files_per_batch=1)
    with pytest.raises(Exception, match="driver dies"):
        run().awaitTermination()
    monkeypatch.setattr(st.StateStore, "_append", append)
    run().awaitTermination()
    store = st.StateStore(spark, f"{tmp_path}/state")
    assert len(calls) == 2 and store.attempts().count() == 2 and {x.input_id for x in store.read().collect()} == {"s0", "s1"}


def _csv(r, rows):
    cell = lambda: r.choice(["", "x", "a b", '5" pipe', 'say ""hi""', '"q"', '"two\nlines"', '"three\r\nlines, with ""quotes""\n"', '"a,b"', "NA", "é", '""', '"\n\n"', "' '"])
    end = r.choice(["\n", "\r\n"])
    return f"a,b,c{end}" + "".join(f"{i},{cell()},{cell()}{end}" for i in range(rows))


@pytest.mark.parametrize("size", [64, 65, 1000])
def test_csv_by_splits(spark, tmp_path, size):
    """The same rows as one task reads, from many: quoted line breaks, doubled and stray quotes, CRLF, two encodings, several files."""
    r = random.Random(size)
    os.makedirs(f"{tmp_path}/in")
    for k in range(2):
        text = _csv(r, 150)
        with open(f"{tmp_path}/in/{k}.csv", "wb") as f:
            f.write(text.encode() + (b"last,\xe9t\xe9,x" if k else b'last,"open,x'))
    whole = [tuple(x) for x in readers.read_csv(spark, f"{tmp_path}/in").collect()]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        held = splits.csv_records(spark, f"{tmp_path}/in")
        assert spark.read.text(f"{tmp_path}/in").rdd.getNumPartitions() > 5 and held.filter("head").count() == 2
        got = [tuple(x) for x in readers.read_csv(spark, f"{tmp_path}/in").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got, key=str) == sorted(whole, key=str) and len(got) > 300


def test_row_groups(spark, tmp_path):
    """The first groups only: bytes behind them may be anything."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = f"{tmp_path}/a.parquet"
    pq.write_table(pa.table({"siret": [f"{i:05d}" for i in range(1000)], "n": list(range(1000))}), path, row_group_size=100)
    third = pq.ParquetFile(path).metadata.row_group(2).column(0).dictionary_page_offset or pq.ParquetFile(path).metadata.row_group(2).column(0).data_page_offset
    end = pq.ParquetFile(path).metadata.row_group(9).column(1)
    with open(path, "r+b") as f:
        f.seek(third)
        f.write(b"\xff" * (end.data_page_offset - third))
    df = splits.sample_row_groups(spark, path, 2)
    assert df.rdd.getNumPartitions() == 2 and [x.n for x in df.orderBy("n").collect()] == list(range(200)) and df.columns == ["siret", "n"]
    assert splits.sample_row_groups(spark, f"file://{path}", 1).count() == 100
    with pytest.raises(Exception):
        splits.sample_row_groups(spark, path, 5).collect()


def test_slots():
    """Starts of all tasks keep their distance, whatever each one's speed."""
    r, starts = random.Random(1), []
    for task in range(4):
        slots, now = clients.Slots(100.0, 0.25, 4), 100.0 + r.random()
        for _ in range(50):
            at = slots.next(now, task)
            assert at >= now
            starts.append(at)
            now = at + r.choice([0, 0.1, 3.0])
    starts.sort()
    assert all(b - a >= 0.25 - 1e-6 for a, b in zip(starts, starts[1:]))


class Clock:
    def __init__(self, path):
        self.path = path

    def search(self, prompt):
        import time

        with open(self.path, "a") as f:
            f.write(f"{time.time()}\n")
        return "{}"


def test_throttle_over_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i}", f"name {i}") for i in range(24)], "Auxiliaire string, Nom string")
    assert clients.search(rows, Clock(f"{tmp_path}/starts"), threads=2, delay=0.2).count() == 24
    starts = sorted(map(float, open(f"{tmp_path}/starts")))
    assert len(starts) == 24 and starts[-1] - starts[0] >= 23 * 0.1 - 0.1
    assert sum(b - a < 0.05 for a, b in zip(starts, starts[1:])) <= 3  # the clock of a start is read a moment later


def test_nested_values(spark):
    df = spark.sql("""SELECT named_struct('x', double('NaN'), 'd', date'2024-02-03', 'in', array(named_struct('y', float('Infinity'), 't', timestamp_ntz'2024-02-03 04:05:06'))) AS s,
     array(1.5D, double('-Infinity'), NULL) AS a, map('k', double('NaN'), 'l', 2D) AS m, map(date'2024-01-01', array(date'2024-01-02')) AS by_date, CAST(NULL AS struct<x: double>) AS none, array(array(double('NaN'))) AS deep""")
    got = df.select(*(tx.serializable(df, c) for c in df.columns)).first().asDict(recursive=True)
    assert got == {"s": {"x": None, "d": "2024-02-03", "in": [{"y": None, "t": "2024-02-03T04:05:06"}]}, "a": [1.5, None, None], "m": {"k": None, "l": 2.0}, "by_date": {"2024-01-01": ["2024-01-02"]}, "none": None, "deep": [[None]]}
