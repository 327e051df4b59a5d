"""Best-fit packing by sums of squares.

Documents become token ids in Arrow batches; only lengths go on. Pieces are dealt at random to
packers of bounded size. A packer keeps, for each residual gap, the number of open bins with that
gap, and puts a piece where the sum of the squares of these numbers becomes smallest. Larger pieces
come first, and a bin is opened only for a piece that no open bin can take (figures: README).
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import bounded_batches, materialize

CAPACITY = 1024
END_ID = 2
#: Pieces of one packer on average. Each packer leaves some bins of its own unfilled.
PACKER_PIECES = 1 << 17

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", sequence_id long, offset long"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer's file lies; TALLYWELD_TOKENIZERS names another folder."""
    own = os.environ.get("TALLYWELD_TOKENIZERS")
    if own:
        return os.path.join(own, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoder(path: str):
    """text -> ids, as Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids gives.

    A special token's string inside a text is that token's one id. Where the same vocabulary lies
    beside the file as ranks, tiktoken reads it: the ids are the same, for a quarter of the time.
    """
    with open(path, "rb") as f:
        added = json.load(f).get("added_tokens") or []
    plain = all(t.get("special") and not any(t.get(k) for k in ("lstrip", "rstrip", "single_word", "normalized")) for t in added)
    ranks = path.removesuffix(".json") + ".tiktoken"
    if plain and os.path.exists(ranks):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        special = {t["content"]: t["id"] for t in added}
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=special)
        return lambda text: encoding.encode(text, allowed_special="all") if any(x in text for x in special) else encoding.encode_ordinary(text)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: the first takes what full pieces leave."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n > capacity else [(0, n)]


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.array([*encode(text.as_py()), END_ID], np.dtype("<u4"))
                out += [(doc_id, i, s, n, zlib.crc32(ids[s : s + n])) for i, (s, n) in enumerate(cut(len(ids), capacity))]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, placed in the order given."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, n in enumerate(lengths.tolist()):
        # the change of the sum of squares when a bin of gap g gets n: at n the bin closes
        gaps = count[n:]
        change = 2 * (count[: len(gaps)] - gaps + 1)
        change[0] = 1 - 2 * gaps[0]
        change[gaps == 0] = np.iinfo(np.int64).max
        best = int(change.argmin())
        if n == capacity or not gaps[best]:
            gap, at = capacity, made
            made += 1
        else:
            gap = best + n
            at = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = at, capacity - gap
        if gap > n:
            open_bins[gap - n].append(at)
            count[gap - n] += 1
    return bins, offsets


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        length = table.column("length").to_numpy()
        order = np.lexsort((table.column("ids_crc32").to_numpy(), table.column("piece").to_numpy(), table.column("doc_id").to_numpy(zero_copy_only=False), -length))
        bins, offsets = sum_of_squares(length[order], capacity)
        first = table.column("packer")[0].as_py() << 32
        out = table.select(["doc_id", "piece", "start", "length", "ids_crc32"]).take(pa.array(order))
        return out.append_column("sequence_id", pa.array(bins + first)).append_column("offset", pa.array(offsets))

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document's ids end in END_ID, so a null or empty text is one piece of one token. Longer
    documents than the capacity are cut, whatever their length; the first piece may be shorter. Rows
    of equal id, null ids too, are packed each on its own. The same rows give the same sequences;
    pieces of equal length go by id, and rows that tie in length, id and checksum too are equal pieces,
    which may change places with each other. Other columns are not read. No rows in, no rows out.
    """
    bounded_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = materialize(base.mapInArrow(_pieces(path or vocabulary(), capacity), _PIECES), "pieces")
    packers = max(1, -(-pieces.count() // PACKER_PIECES))
    dealt = pieces.withColumn("packer", F.pmod(F.xxhash64("doc_id", "ids_crc32", "piece"), F.lit(packers)))
    return dealt.groupBy("packer").applyInArrow(_pack(capacity), _PACKED)


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
