"""Exact dedup by a minimal perfect hash over historical distinct digests.

The history's distinct SHA-256 digests are cut into shards by digest. Each shard gets a minimal
perfect hash: levels of bit arrays, where a key stays on the first level on which no other key
has its bit, and its slot is the rank of that bit. Slots hold the full digest, the locator of the
winner and the number of rows. A lookup compares all 32 bytes, so keys that are not in the
history never match; those group separately by digest.

A table without a history is its own: `exact_groups` takes the rows with the larger half of the ids
for the history, as of equal texts the row with the largest id stays. Lookups of all other rows say
which of them repeat it; those that don't group among themselves. The numbers of rows on both sides
are then added up and looked up by the rows of the history and their repeats.

A shard that very many rows look up (one text may be a third of all rows) is dealt out in parts,
each with its own copy of the shard's table, whose size is bounded by SHARD_KEYS.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import bounded_batches, materialize, numbered

#: Digests of one shard on average.
SHARD_KEYS = 1 << 15
#: Rows that look up one copy of a shard, on average.
LOOKUP_ROWS = 1 << 16
#: Bits of a level for each key that reaches it.
GAMMA = 2.0

#: Stands for a null id in the tables: ids are compared as longs, and null is the smallest.
NO_ID = -(2**63)

_INDEX = "shard long, levels array<binary>, digests binary, ids binary, rows binary, counts binary"
_FOUND = "doc_id long, row long, digest binary, keep_id long, keep_row long, group_size long"


def _keys(digests: np.ndarray, level: int) -> np.ndarray:
    """A hash for the level from the digest's words, of which each is uniform already."""
    x = digests[:, level % 4] ^ (digests[:, (level + 1) % 4] + np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64)))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def build_levels(digests: np.ndarray) -> list[np.ndarray]:
    """The bit arrays (as bools) of a minimal perfect hash over distinct digests (n x 4 uint64)."""
    levels, left = [], np.arange(len(digests))
    while len(left):
        bits = max(64, int(len(left) * GAMMA))
        at = (_keys(digests[left], len(levels)) % np.uint64(bits)).astype(np.int64)
        alone = np.bincount(at, minlength=bits) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def slots(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """The slot of each digest; that of some other key, or -1, for one that was not built in."""
    out, left, base = np.full(len(digests), -1), np.arange(len(digests)), 0
    for i, alone in enumerate(levels):
        at = (_keys(digests[left], i) % np.uint64(len(alone))).astype(np.int64)
        hit = alone[at]
        out[left[hit]] = base + (np.cumsum(alone) - 1)[at[hit]]
        base += int(alone.sum())
        left = left[~hit]
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 4)


def _build(table: pa.Table) -> pa.Table:
    digests = _matrix(table.column("digest"))
    levels = build_levels(digests)
    order = np.argsort(slots(levels, digests))
    held = [table.column(c).to_numpy()[order].tobytes() for c in ("keep_id", "keep_row", "group_size")]
    packed = [len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in levels]
    return pa.table({"shard": table.column("shard")[:1], "levels": pa.array([packed], pa.list_(pa.binary())), "digests": [digests[order].tobytes()], "ids": [held[0]], "rows": [held[1]], "counts": [held[2]]})


def _look_up(docs: pa.Table, index: pa.Table) -> pa.Table:
    digests = _matrix(docs.column("digest"))
    found, at = np.zeros(len(digests), bool), np.zeros(len(digests), np.int64)
    held = [np.zeros(1, np.int64)] * 3
    if index.num_rows:
        row = index.slice(0, 1).to_pylist()[0]
        levels = [np.unpackbits(np.frombuffer(x, np.uint8, offset=8), count=int.from_bytes(x[:8], "little")).astype(bool) for x in row["levels"]]
        known = np.frombuffer(row["digests"], np.uint64).reshape(-1, 4)
        at = slots(levels, digests)
        found = (at >= 0) & (known[at] == digests).all(axis=1)
        held = [np.frombuffer(row[c], np.int64) for c in ("ids", "rows", "counts")]
    at = np.where(found, at, 0)
    columns = {k: pa.array(v[at], mask=~found) for k, v in zip(("keep_id", "keep_row", "group_size"), held, strict=True)}
    return pa.table({"doc_id": docs.column("doc_id"), "row": docs.column("row"), "digest": docs.column("digest"), **columns})


def _groups(rows: DataFrame) -> DataFrame:
    """Of equal digests: the winner's id and row, and the number of rows."""
    best = F.max(F.struct("doc_id", "row"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")).select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")


def _id(c: str):
    return F.when(F.col(c) != NO_ID, F.col(c)).alias(c)


def _number(c):
    return F.coalesce(c.cast("long"), F.lit(NO_ID))


def _digest(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (NO_ID for null), row (a number of its own for each row) and the SHA-256 of the text, written once.

    A null text has the digest of an empty one; a very long text is read whole, and repeated rows get
    numbers of their own. Other columns are not read, whatever their names. No rows in, no rows out.
    """
    return materialize(docs.select(_number(F.col(f"`{id_col}`")).alias("doc_id"), F.monotonically_increasing_id().alias("row"), _digest(F.col(f"`{text_col}`")).alias("digest")), "digests")


def look_up(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows (doc_id, row, digest) with keep_id, keep_row and group_size of `known`, null where it lacks the digest.

    Digests of `known` are distinct; rows may repeat one any number of times, as a frequent digest's
    lookups are dealt to several tasks. Columns beyond these are not handed on. No rows in, no rows
    out; with an empty `known` nothing is found.
    """
    bounded_batches(rows.sparkSession)
    shards = max(1, -(-known.count() // SHARD_KEYS))
    of = F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(shards)).alias("shard")
    index = known.select("*", of).groupBy("shard").applyInArrow(_build, _INDEX)
    asked = rows.select("doc_id", "row", "digest", of)
    copies = asked.groupBy("shard").agg(F.ceil(F.count("*") / LOOKUP_ROWS).alias("copies"))
    asked = asked.join(copies, "shard").select("doc_id", "row", "digest", "shard", F.pmod(F.xxhash64("row"), F.col("copies")).alias("part"))
    index = index.join(copies.withColumnRenamed("copies", "made"), "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("made") - 1))).drop("made")
    return asked.groupBy("shard", "part").cogroup(index.groupBy("shard", "part")).applyInArrow(_look_up, _FOUND)


def _among_themselves(found: DataFrame) -> DataFrame:
    """What lookups didn't find, grouped by digest; rows then look their group up, as a frequent digest can't be joined evenly."""
    new = found.filter("group_size is null").select("doc_id", "row", "digest")
    return look_up(new, materialize(_groups(new), "firsts"))


def _verdict(found: DataFrame, stays) -> DataFrame:
    return found.select(_id("doc_id"), "row", "digest", _id("keep_id"), "group_size", stays.alias("kept"))


def against_history(rows: DataFrame, history: DataFrame) -> DataFrame:
    """One row per row of rows, as exact_groups; both sides are digests().

    Rows whose text the history holds are repeats of its winner and none of them stays; group_size
    counts the history's rows. All others group among themselves, and one of them stays.
    """
    found = materialize(look_up(rows, materialize(_groups(history), "history")), "found")
    first = F.col("row") == F.col("keep_row")
    return _verdict(found.filter("group_size is not null"), F.lit(False)).union(_verdict(_among_themselves(found), first))


def exact_groups(rows: DataFrame) -> DataFrame:
    """One row per row of digests(): doc_id, row, digest, keep_id, group_size, kept.

    Of equal texts the row with the largest doc_id stays (of rows of equal id, one). A null text
    counts as empty; a null id as the smallest, -2**63, and a real id of that value comes back as
    null. Very long texts are digests like others. No rows in, no rows out.
    """
    low, high = rows.filter(F.col("doc_id") != NO_ID).agg(F.min("doc_id"), F.max("doc_id")).first()
    older = F.col("doc_id") >= ((low or 0) + (high or 0)) // 2
    history, rest = rows.filter(older), rows.filter(~older)
    known = materialize(_groups(history), "history")
    found = materialize(look_up(rest, known), "found")
    repeats = found.filter("group_size is not null").select("doc_id", "row", "digest")
    more = repeats.groupBy("digest").agg(F.count("*").alias("more"))
    # the history's ids are larger, so its winner stays the winner
    whole = materialize(known.join(more, "digest", "left").select("digest", "keep_id", "keep_row", (F.col("group_size") + F.coalesce("more", F.lit(0))).alias("group_size")), "whole")
    members = look_up(history.select("doc_id", "row", "digest").union(repeats), whole)
    return _verdict(members.union(_among_themselves(found)), F.col("row") == F.col("keep_row"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without copies of equal texts: the row with the largest id stays, with all its columns.

    Null texts equal empty ones, a null id is the smallest; of rows of equal text and id one stays.
    Columns can have any names. Empty in, empty out.
    """
    held = numbered(docs)
    rows = held.select(_number(F.col(f"doc.`{id_col}`")).alias("doc_id"), "row", _digest(F.col(f"doc.`{text_col}`")).alias("digest"))
    kept = exact_groups(materialize(rows, "digests")).filter("kept").select("row")
    return held.join(kept, "row", "left_semi").select(*(F.col(f"doc.`{c}`") for c in docs.columns))


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with the one of its text that stays, and the number of equal texts."""
    rows = digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return exact_groups(rows).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
