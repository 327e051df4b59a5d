"""First-fit decreasing packing by a tournament tree, in randomised groups.

Documents become token ids in Arrow batches and are cut into pieces of at most the capacity. Pieces
are dealt at random to groups of bounded size, whatever their ids and texts. A group puts its pieces,
longest first, into the first sequence with room: the leaves of a tournament tree are the sequences'
free places and each node holds the largest below it, so the first one is found from the root in as
many steps as the tree has levels. Then the least filled sequences are taken apart to fill the gaps of
all others, and what is left over makes sequences of powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .grouped import by_group, partitions
from .packing import encoder, vocabulary
from .store import bounded_batches

CAPACITY = 2048
END_ID = 1
#: Bytes of text of one group on average. A token has a byte at least and its id takes four.
GROUP_BYTES = 1 << 25
#: What a document counts for besides its text, so that many empty ones make groups, too.
ROW_BYTES = 64
#: Pieces of one Arrow batch on the way out.
_OUT_ROWS = 1 << 10

_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"
_PACKED = _PIECES + ", sequence_id long, offset long"
_KINDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]


def _batches(rows: Iterator[tuple], kinds: list) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _OUT_ROWS:
            yield _batch(held, kinds)
            held = []
    if held:
        yield _batch(held, kinds)


def _batch(rows: list[tuple], kinds: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])


def _pieces(path: str, capacity: int, end_id: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encode = encoder(path)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.array([*encode(text.as_py()), end_id], np.dtype("<u4"))
                for s in range(0, len(ids), capacity):
                    own = ids[s : s + capacity]
                    yield doc_id, s, len(own), len(ids), own.tobytes()

    return lambda batches: _batches(rows(batches), _KINDS)


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """The sequence of each length, in the order given: the first with room."""
    # of two sequences that follow each other more than one is filled
    most = min(len(lengths), 2 * sum(lengths) // capacity + 2)
    leaves = 1 << max(0, most - 1).bit_length()
    tree, out = [capacity] * (2 * leaves), []
    for n in lengths:
        i = 1
        while i < leaves:
            i *= 2
            if tree[i] < n:
                i += 1
        out.append(i - leaves)
        tree[i] -= n
        while i > 1:
            i //= 2
            room = max(tree[2 * i], tree[2 * i + 1])
            if tree[i] == room:
                break
            tree[i] = room
    return out


def filled(lengths: list[int], bins: list[int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(piece, from, to, sequence) with as many full sequences as the lengths allow; the rest are powers of two.

    The fullest sequences stay as they are; the pieces of the others are poured into the gaps, the
    largest first, and cut where a gap ends.
    """
    total = sum(lengths)
    fill = np.bincount(bins, weights=lengths).astype(int) if bins else np.zeros(0, int)
    order = np.argsort(-fill, kind="stable")
    full, rest = divmod(total, capacity)
    kept = order[:full]
    number = {int(b): i for i, b in enumerate(kept)}
    out = [(p, 0, n, number[b]) for p, (n, b) in enumerate(zip(lengths, bins, strict=True)) if b in number]
    gaps = sorted(((capacity - int(fill[b]), number[int(b)]) for b in kept if fill[b] < capacity), reverse=True)
    powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    gaps += [(x, full + i) for i, x in enumerate(powers)]
    loose = sorted((p for p, b in enumerate(bins) if b not in number), key=lambda p: -lengths[p])
    at, room = 0, gaps[0][0] if gaps else 0
    for p in loose:
        begin = 0
        while begin < lengths[p]:
            if not room:
                at += 1
                room = gaps[at][0]
            n = min(room, lengths[p] - begin)
            out.append((p, begin, begin + n, gaps[at][1]))
            begin, room = begin + n, room - n
    return out


def _pack(capacity: int):
    def group(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        length = table.column("length").to_numpy()
        order = np.lexsort((table.column("start").to_numpy(), table.column("doc_id").fill_null(-(2**63)).to_numpy(), -length))
        table = table.take(pa.array(order))
        doc_id, start, doc_tokens, ids = (table.column(c) for c in ("doc_id", "start", "doc_tokens", "ids"))
        lengths = length[order].tolist()

        def rows() -> Iterator[tuple]:
            used: dict[int, int] = {}
            for p, a, b, s in filled(lengths, first_fit(lengths, capacity), capacity):
                offset = used.get(s, 0)
                used[s] = offset + b - a
                yield doc_id[p].as_py(), start[p].as_py() + a, b - a, doc_tokens[p].as_py(), ids[p].as_py()[4 * a : 4 * b], (k << 32) + s, offset

        yield from _batches(rows(), [*_KINDS, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    return group


def pack_first_fit(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group_bytes: int = GROUP_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), sequence_id, offset.

    A document's ids end in end_id, so a null or empty text is one token; its pieces lie in any
    sequences. Texts of any length are cut at multiples of the capacity, shorter ones only to fill gaps.
    All sequences of a group are full but at most one of each smaller power of two. Rows of equal
    id, null ids too, are packed each on its own and dealt by their place, so that repeats of one row are
    no group. Other columns are not read, whatever their names. No rows in, no rows out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = base.agg(F.coalesce(F.sum(F.octet_length("text") + ROW_BYTES), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, -(-total // group_bytes))
    pieces = base.mapInArrow(_pieces(path or vocabulary(), capacity, end_id), _PIECES)
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return by_group(dealt, _pack(capacity), _PACKED, partitions(spark, groups, total))


def op13_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens; ids by their checksum."""
    packed = pack_first_fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
