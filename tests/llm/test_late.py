"""Late-arrival overwrite against plain Python: every file's rows, order and name, what is left alone, and recovery."""

import glob
import hashlib
import os
import random
import zlib
from collections import defaultdict
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest

from tallyweld.llm import late

SF = "/root/testdata/sf0.001"
EPOCH = datetime(1970, 1, 1)


def day(t):
    return -1 if t is None else (t - EPOCH).days


def copies(rows):
    out = []
    for r in rows:
        out.append(r)
        if r["sale_id"] is None:
            continue
        h = zlib.crc32(str(r["sale_id"]).encode())
        if h % 3 == 0 and day(r["sold_at"]) % 10 == 0:
            more = lambda t, n: None if t is None else t + timedelta(days=n)
            out.append({**r, "total": None if r["total"] is None else r["total"] + 1, "sold_at": more(r["sold_at"], h % 2), "arrived_at": more(r["arrived_at"], 1 + h % 97)})
    return out


def rank(r):
    rest = [r[c] for c in r if c not in ("arrived_at", "sold_at")]
    return [(x is not None, x if x is not None else 0) for x in (r["arrived_at"], r["sold_at"], *rest)]


def latest(rows):
    best = {}
    for r in rows:
        if r["sale_id"] not in best or rank(r) > rank(best[r["sale_id"]]):
            best[r["sale_id"]] = r
    return best


def layout(kept, per_file):
    days = defaultdict(list)
    for r in kept.values():
        days[day(r["sold_at"])].append(r)
    low = lambda x: (x is not None, x if x is not None else 0)
    out = {}
    for d, own in days.items():
        own.sort(key=lambda r: (low(r["sold_at"]), low(r["sale_id"])))
        for i in range(0, len(own), per_file):
            out[d, i // per_file] = own[i : i + per_file]
    return out


def expected(rows):
    per_file = 1 + len(rows) // 900
    every = copies(rows)
    early = [r for r in every if r["arrived_at"] is not None and r["arrived_at"] < datetime(2024, 3, 1)]
    began, end = latest(early), latest(every)
    anew = set()
    for k, r in end.items():
        if r["arrived_at"] is None or r["arrived_at"] >= datetime(2024, 3, 1):
            anew.add(day(r["sold_at"]))
            if k in began:
                anew.add(day(began[k]["sold_at"]))
    return layout(began, per_file), layout(end, per_file), anew


def micros(t):
    return "" if t is None else str((t - EPOCH) // timedelta(microseconds=1))


def digest(rows):
    import math

    ids = ["" if r["sale_id"] is None else str(r["sale_id"]) for r in rows]
    cents = sum(0 if r["total"] is None else math.floor(100 * r["total"] + 0.5) for r in rows)
    crc = sum(zlib.crc32(f"{i}:{micros(r['sold_at'])}:{micros(r['arrived_at'])}".encode()) for i, r in zip(ids, rows))
    return len(rows), cents, crc, hashlib.sha256(",".join(ids).encode()).hexdigest()


def files_of(path):
    return {f: open(f, "rb").read() for f in glob.glob(f"{path}/**/*", recursive=True) if os.path.isfile(f)}


def held(path, files, want, columns):
    """The files are the layout, and nothing else lies there."""
    assert {(r.day, r.file_no) for r in files} == set(want)
    for r in files:
        there = r.path.removeprefix("file:")
        t = pq.ParquetFile(there).read()
        assert t.column_names == columns and t.to_pylist() == want[r.day, r.file_no]
    data = {f for f in files_of(path) if not os.path.basename(f).startswith((".", "_"))}
    assert data == {r.path.removeprefix("file:") for r in files}
    assert not [x for x in os.listdir(path) if x.startswith("_")]


def test_registered_query(spark):
    from tallyweld.llm.queries import QUERIES

    source = spark.read.parquet(f"{SF}/sales.parquet")
    rows = pq.read_table(f"{SF}/sales.parquet").to_pylist()
    _, want, anew = expected(rows)
    got = QUERIES["op11_late_overwrite"](spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.n_rows, r.cents, r.rows_crc, r.ids_sha256) == digest(want[r.day, r.file_no])
        assert r.columns == ",".join(source.columns) and r.rewritten == (r.day in anew)
    assert {r.rewritten for r in got} == {True, False}
    held(got[0].path.rsplit("/", 2)[0], got, want, source.columns)


COLUMNS = "sale_id long, day string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, `a.b` int, file_at string, place_at long"


def odd_rows(n, seed):
    """Nulls in any column, repeated rows, a key and a moment with a third of all rows, clashing names."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        sold = datetime(2024, 1, 20) + timedelta(hours=r.randrange(1200), microseconds=r.randrange(3)) if r.random() > 0.3 else datetime(2024, 2, 20)
        arrived = sold + timedelta(hours=r.randrange(60))
        out.append((r.choice([7, None, *range(100, 100 + n)]) if r.random() > 0.3 else 7, r.choice(["x", None]), r.choice([None, 1.5, 2.005, -3.25]), r.choice([sold] * 9 + [None]), r.choice([arrived] * 150 + [None]), r.choice([1, None]), "f", 3))
    return out + out[: n // 5]


def test_odd_rows_and_untouched_files(spark, tmp_path):
    data = odd_rows(400, 1)
    df = spark.createDataFrame(data, COLUMNS).repartition(5)
    rows = [r.asDict() for r in df.collect()]
    began, end, anew = expected(rows)
    sales = late.in_utc(df)
    table = late.DailyTable(spark, str(tmp_path / "t"), sales.schema, 1 + len(rows) // 900)
    every = late.with_copies(sales)
    early = "coalesce(arrived_at < timestamp_ntz'2024-03-01 00:00:00', false)"
    table.write(every.filter(early))
    held(table.path, table.files().collect(), began, df.columns)
    before = files_of(table.path)
    assert table.overwrite(every.filter(f"NOT {early}")) == anew
    held(table.path, table.files().collect(), end, df.columns)
    after = files_of(table.path)
    for f, content in before.items():
        assert (f in after and after[f] == content) == (not any(f"/day_={d}/" in f for d in anew))
    assert any(f in after for f in before)


def test_days_that_empty_and_nothing_late(spark, tmp_path):
    at = lambda d, h=0: datetime(2024, 1, d, h)
    schema = "sale_id long, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz"
    first = spark.createDataFrame([(1, 1.0, at(1), at(1)), (2, 1.0, at(2), at(2)), (3, 1.0, at(3), at(5))], schema)
    table = late.DailyTable(spark, str(tmp_path / "t"), first.schema, 2)
    assert table.write(first) == {19723, 19724, 19725}
    assert table.overwrite(first.limit(0)) == set()
    # an older row changes nothing; a newer one leaves its first day empty
    late_rows = spark.createDataFrame([(3, 9.0, at(4), at(4)), (1, 2.0, at(9), at(9))], schema)
    assert table.overwrite(late_rows) == {19723, 19731}
    assert sorted((r.sale_id, r.total, r.day) for r in table.read().collect()) == [(1, 2.0, 19731), (2, 1.0, 19724), (3, 1.0, 19725)]
    assert not os.path.exists(tmp_path / "t" / "day=19723")


def test_no_rows(spark, tmp_path):
    schema = "sale_id long, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz"
    table, anew = late.late_overwrite(spark.createDataFrame([], schema), str(tmp_path / "t"))
    assert anew == set() and table.files().collect() == [] and table.read().count() == 0
    assert late.digests(table.read(), table.files(), "sale_id", late.F.lit(0), late.F.lit(0)).collect() == []


@pytest.mark.parametrize("calls", [0, 1, 2, 3, 4, 5])
def test_ended_in_between(spark, tmp_path, monkeypatch, calls):
    """A run that ends after any rename leaves the old table or one that the next run finishes."""
    at = lambda d: datetime(2024, 1, d)
    schema = "sale_id long, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz"
    first = spark.createDataFrame([(i, 1.0, at(1 + i % 3), at(5)) for i in range(9)], schema)
    more = spark.createDataFrame([(i, 2.0, at(1 + i % 2), at(9)) for i in range(0, 9, 2)], schema)
    table = late.DailyTable(spark, str(tmp_path / "t"), first.schema, 2)
    table.write(first)
    rename, n = late.DailyTable._rename, [0]

    def breaks(self, a, b):
        if n[0] == calls:
            raise KeyboardInterrupt
        n[0] += 1
        rename(self, a, b)

    monkeypatch.setattr(late.DailyTable, "_rename", breaks)
    with pytest.raises(KeyboardInterrupt):
        table.overwrite(more)
    monkeypatch.setattr(late.DailyTable, "_rename", rename)
    table.recover()
    got = {r.sale_id: r.total for r in table.read().collect()}
    assert got == {i: 2.0 if calls and i % 2 == 0 else 1.0 for i in range(9)}
    table.overwrite(more)
    assert {r.sale_id: r.total for r in table.read().collect()} == {i: 1.0 if i % 2 else 2.0 for i in range(9)}
    assert not [x for x in os.listdir(tmp_path / "t") if x.startswith("_")]


def test_times_whatever_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.999999' AS a, timestamp_ntz'2024-03-10 02:30:00' AS b, timestamp'2024-01-01 00:00:00Z' AS c")
        got = late.in_utc(df).select(*(late.epoch_micros(late.F.col(c)).alias(c) for c in "abc"), late.days_since_epoch(late.F.col("a")).alias("d")).first()
        assert tuple(got) == (-1, 1710037800_000000, 1704067200_000000, -1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
