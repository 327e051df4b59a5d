"""Words, native expressions over them, and vectorised 64-bit word and n-gram fingerprints.

A word is a maximal run of characters outside \\x20 and \\x09-\\x0D. These are single bytes in
UTF-8, so the numpy side works on the Arrow buffers without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Separators of words, as a character class body; Java and RE2 read it alike.
SEPARATORS = r"\x20\x09-\x0D"
#: Bytes of text that one numpy pass handles (more only for a longer single document).
BLOCK_BYTES = 1 << 19


def words_sql(text: str) -> str:
    """SQL for the array of words of a string expression (null: empty array)."""
    return f"filter(split(coalesce({text}, ''), '[{SEPARATORS.replace(chr(92), chr(92) * 2)}]+'), w -> w <> '')"


def count_words_sql(text: str) -> str:
    return f"size({words_sql(text)})"


U64 = np.uint64
_MIX1, _MIX2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; a bijection, so equal outputs mean equal inputs."""
    x = x ^ (x >> U64(33))
    x *= _MIX1
    x ^= x >> U64(33)
    x *= _MIX2
    x ^= x >> U64(33)
    return x


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
with np.errstate(over="ignore"):
    _TABLE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0xA24BAED4963EE407))
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]


class _Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[U64(1), np.full(n - 1, self.base, np.uint64)], dtype=np.uint64)
                self.down = np.cumprod(np.r_[U64(1), np.full(n - 1, self.inverse, np.uint64)], dtype=np.uint64)
        return self.up, self.down


_BYTES, _WORDS = _Powers(_BASE), _Powers(_WORD_BASE)


@dataclass
class Block:
    """Whole documents whose texts lie back to back in `data`."""

    rows: slice  # of the Arrow batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than documents

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """starts and ends of all words in data, and the first word's number of each document."""
        if not len(self.data):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(len(self.offsets), np.int64)
        inside = ~_SPACE[self.data]
        first = np.zeros(len(self.data) + 1, dtype=bool)
        first[self.offsets] = True
        before = np.r_[False, inside[:-1]] & ~first[:-1]
        after = np.r_[inside[1:], False] & ~first[1:]
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def word_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """A 64-bit fingerprint of each word; lower folds A-Z."""
        out, table = np.empty(len(starts), np.uint64), _LOWER if lower else _TABLE
        at = 0
        with np.errstate(over="ignore"):
            while at < len(starts):  # a long document goes through in parts cut between words
                to = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK_BYTES)))
                lo, hi = starts[at], ends[to - 1]
                up, down = _BYTES.get(int(hi - lo) + 1)
                sums = np.empty(hi - lo + 1, np.uint64)
                sums[0] = 0
                np.cumsum(table[self.data[lo:hi]] * up[: hi - lo], out=sums[1:])
                s, e = starts[at:to] - lo, ends[at:to] - lo
                out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
                at = to
        return out


def slice_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Fingerprints of data[start:stop] for each of the given slices."""
    with np.errstate(over="ignore"):
        up, down = _BYTES.get(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[: len(data)], out=sums[1:])
        return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))


def gram_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the word runs words[begin:end], of any lengths."""
    with np.errstate(over="ignore"):
        up, down = _WORDS.get(len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=sums[1:])
        return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def blocks(batch: pa.RecordBatch, column: str = "text") -> Iterator[Block]:
    """Cut an Arrow batch into blocks of whole documents; null texts are empty."""
    texts = batch.column(column).cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, count=n + 1, offset=texts.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
        to = min(to, n)
        own = offsets[at : to + 1]
        yield Block(slice(at, to), data[own[0] : own[-1]], own - own[0])
        at = to


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of arange(s, s + c)."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    skip = np.repeat(starts - np.r_[0, np.cumsum(counts)[:-1]], counts)
    return np.arange(total) + skip
