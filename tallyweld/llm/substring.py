"""Substring dedup by prefix-partitioned suffix trees.

Every word position starts a suffix. A window of `window` words is removed where the same word
sequence also starts in a document with a smaller id, so trees are built down to that depth and
their deep internal nodes are those of depth `window` with suffixes of two or more documents.

1. `_anchors` finds the prefix that deals a suffix to a group. A prefix has as many words as it
   takes to PREFIX_CHARS characters, so frequent words, which are short, make longer ones. Of the
   prefixes that lie in a suffix's window it is the one with the least hash, so neighbours mostly
   have it in common and travel as one fragment of text instead of `window` words each.
2. `_crowds` counts prefixes. Those of more than MOST_SUFFIXES suffixes are lengthened to the whole
   window, so groups fit a task's memory.
3. `_deal` gathers stretches of documents and sends each group its fragments, compressed. Of equal fragments of
   a stretch only the smallest document's is sent; the others are known to repeat it, so a passage
   that a third of all documents share sends one fragment a stretch.
4. `_subtree` cuts a group's fragments into suffixes and sorts those that are not alone with their
   fingerprint. Neighbours that agree in all words hang below one deep node; all of them but those
   of its smallest document are repeats.
5. Marked positions go back to their documents (`_merge`), where runs of them are the maximal repeats.

A group holds about GROUP_SUFFIXES suffixes and is worked on alone; groups are many to a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .grouped import by_group, partitions
from .store import bounded_batches, materialize, total_bytes
from .textkit import _SPACE, U64, Block, blocks, gram_hashes, mix, ranges, slice_hashes

#: Characters after which a prefix is long enough to tell groups apart.
PREFIX_CHARS = 10
#: Suffixes of a group on average, those that a prefix may have, and prefixes that are lengthened at most (8 bytes
#: each go to every task; beyond, the least crowded stay as they are).
GROUP_SUFFIXES, MOST_SUFFIXES, MOST_HEAVY = 1 << 18, 1 << 19, 1 << 20
#: Suffixes that a task gathers before it deals them out, and bytes of fragments that are cut into suffixes at a time.
FLUSH_SUFFIXES, CUT_BYTES = 400_000, 1 << 20
_NONE = U64(2**64 - 1)

_DEALT = "grp long, heads binary, pos binary, counts binary, sizes binary, words binary"
_MARKED = "doc_id long, fp long, marks binary"


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers as two planes of 16 bits: the upper one is mostly zeros, which shuffles compress."""
    return (x & 0xFFFF).astype(np.uint16).tobytes() + (x >> 16).astype(np.uint16).tobytes()


def _from_planes(blob: bytes) -> np.ndarray:
    n = len(blob) // 4
    return np.frombuffer(blob, np.uint16, n).astype(np.int64) | np.frombuffer(blob, np.uint16, n, 2 * n).astype(np.int64) << 16


def _rows(grp: list, heads: list, pos: list, counts: list | None = None, sizes: list | None = None, words: list | None = None) -> Iterator[pa.RecordBatch]:
    nothing = [None] * len(grp)
    columns = [pa.array(grp, pa.int64()), *(pa.array(nothing if x is None else x, pa.binary()) for x in (heads, pos, counts, sizes, words))]
    if grp:
        yield pa.record_batch(columns, names=["grp", "heads", "pos", "counts", "sizes", "words"])


def _cuts(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of x begin, and its length."""
    return np.r_[0, np.flatnonzero(x[1:] != x[:-1]) + 1, len(x)] if len(x) else np.zeros(1, np.int64)


def _head(docs: np.ndarray, fps: np.ndarray, which: np.ndarray) -> bytes:
    """Runs of equal `which`: document, its text's fingerprint, length."""
    cuts = _cuts(which)
    own = which[cuts[:-1]]
    return np.stack([docs[own], fps[own], np.diff(cuts)]).tobytes()


def _marks(docs: np.ndarray, fps: np.ndarray, which: np.ndarray, pos: np.ndarray, groups: int) -> Iterator[pa.RecordBatch]:
    """Marked positions, one row (with a negative number) for each group of documents."""
    group = (mix(docs[which].view(np.uint64)) % U64(groups)).astype(np.int64)
    order = np.lexsort((pos, which, group))
    group, which, pos = group[order], which[order], pos[order]
    cuts = _cuts(group)
    at = list(zip(cuts[:-1], cuts[1:], strict=True))
    yield from _rows([-1 - int(group[a]) for a, _ in at], [_head(docs, fps, which[a:b]) for a, b in at], [_planes(pos[a:b]) for a, b in at])


def _steps(begin: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of things that lie at begin[i]:begin[i + 1], each of `most` bytes or one thing."""
    at, n = 0, len(begin) - 1
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(begin, begin[at] + most, "right")) - 1))
        yield at, to
        at = to


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.LargeBinaryArray:
    """An Arrow array of byte strings that lie back to back."""
    offsets = np.r_[np.int64(0), np.cumsum(sizes, dtype=np.int64)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _spaced(block: Block, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block's text with one space between a document's words, and where each word begins in it."""
    space = _SPACE[block.data]
    keep = ~space
    keep[1:] |= ~space[:-1]  # the separator that ends a word
    data = np.where(space, np.uint8(32), block.data)[keep]
    return data, (np.cumsum(keep) - 1)[starts]


def _anchors(heavy: np.ndarray, window: int, block: Block, starts, ends, first) -> tuple[np.ndarray, ...]:
    """Of all suffixes of a block: number of the document, position, prefix (its hash) and where that begins."""
    n = len(starts)
    counts = np.maximum(np.diff(first) - window + 1, 0)
    at = ranges(first[:-1], counts)
    so_far = np.r_[np.int64(0), np.cumsum(ends - starts)]
    everywhere = np.arange(n)
    stop = np.searchsorted(so_far, so_far[:-1] + PREFIX_CHARS)
    hashes = block.word_hashes(starts, ends)
    # the place in the window takes a hash's low bits, so the least one says it, and the first of equals
    low = U64((1 << window.bit_length()) - 1)
    prefix = gram_hashes(hashes, everywhere, np.minimum(stop, n)) & ~low
    long = (stop - everywhere).clip(max=window + 1).astype(np.int16)
    long[stop > n] = window + 1
    m = max(n - window + 1, 0)  # windows that cross into the next document are left out below
    key = np.full(m, _NONE)
    for i in range(window):
        own = prefix[i : i + m] + U64(i)
        own[long[i : i + m] > window - i] = _NONE
        np.minimum(key, own, out=key)
    key = key[at]
    alone = key == _NONE
    anchor = at + (key & low).astype(np.int64)
    key &= ~low
    if len(heavy):
        alone |= heavy[np.minimum(np.searchsorted(heavy, key), len(heavy) - 1)] == key
    alone = np.flatnonzero(alone)
    key[alone], anchor[alone] = gram_hashes(hashes, at[alone], at[alone] + window), at[alone]
    return np.repeat(np.arange(len(counts)), counts), at, key, anchor


def _crowds(window: int, least: int):
    """(prefix, n): prefixes that a stretch of suffixes has `least` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch({"prefix": key[n >= least].view(np.int64), "n": n[n >= least]})

        for batch in batches:
            for block in blocks(batch):
                starts, ends, first = block.words()
                if len(starts):
                    held.append(_anchors(np.zeros(0, np.uint64), window, block, starts, ends, first)[2])
                    size += len(held[-1])
                if size >= FLUSH_SUFFIXES:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return run


def _deal(heavy: np.ndarray, window: int, groups: int, flush: int):
    def deal(docs, fps, which, pos, count, size, data, prefix) -> Iterator[pa.RecordBatch]:
        """One gathered stretch of documents: docs, fps by document; the rest by fragment."""
        same = _binary(data, size).dictionary_encode().indices.to_numpy()
        ids = docs[which]
        order = np.lexsort((ids, same))
        cuts = _cuts(same[order])
        least = np.empty(len(same), np.int64)
        least[order] = np.repeat(ids[order][cuts[:-1]], np.diff(cuts))
        covered = np.flatnonzero(ids != least)
        yield from _marks(docs, fps, np.repeat(which[covered], count[covered]), ranges(pos[covered], count[covered]), groups)
        take = np.flatnonzero(ids == least)
        group = (prefix[take] % U64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        take, group = take[order], group[order]
        begin = np.r_[np.int64(0), np.cumsum(size)][take]
        cuts = _cuts(group)
        words = data[ranges(begin, size[take])].tobytes()
        ends = np.r_[np.int64(0), np.cumsum(size[take])][cuts]
        at = [take[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        yield from _rows([int(g) for g in group[cuts[:-1]]], [_head(docs, fps, which[x]) for x in at], [_planes(pos[x]) for x in at], [count[x].astype(np.uint16).tobytes() for x in at], [_planes(size[x]) for x in at], [pa.compress(words[x:y], codec="zstd", asbytes=True) for x, y in zip(ends[:-1], ends[1:], strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n_docs = [], 0, 0
        for batch in batches:
            all_ids, all_fps = batch.column("doc_id").to_numpy(), batch.column("fp").to_numpy()
            for block in blocks(batch):
                starts, ends, first = block.words()
                if not (np.diff(first) >= window).any():
                    continue
                which, at, prefix, anchor = _anchors(heavy, window, block, starts, ends, first)
                data, begin = _spaced(block, starts)
                cuts = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (prefix[1:] != prefix[:-1]) | (which[1:] != which[:-1])])
                count = np.diff(np.r_[cuts, len(at)])
                which, at, prefix = which[cuts], at[cuts], prefix[cuts]
                last = at + count + window - 2
                bytes_ = begin[last] + ends[last] - starts[last] - begin[at]
                held.append((all_ids[block.rows], all_fps[block.rows], which + n_docs, at - first[:-1][which], count, bytes_, data[ranges(begin[at], bytes_)], prefix))
                n_docs += len(first) - 1
                size += int(count.sum())
                if size >= flush:
                    yield from deal(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, size, n_docs = [], 0, 0
        if held:
            yield from deal(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _subtree(groups: int, window: int):
    """The repeats of one group's suffixes, by group of documents; what was known before passes."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for r in batch.to_pylist():
                doc, fp, n = np.frombuffer(r["heads"], np.int64).reshape(3, -1)
                sizes = _from_planes(r["sizes"])
                words = pa.decompress(r["words"], int(sizes.sum()), codec="zstd")
                yield np.repeat(doc, n), np.repeat(fp, n), _from_planes(r["pos"]), np.frombuffer(r["counts"], np.uint16).astype(np.int64), sizes, np.frombuffer(words, np.uint8)

    def cut(data: np.ndarray, size: np.ndarray, count: np.ndarray, number: int, offset: int) -> tuple[np.ndarray, ...]:
        """The suffixes of some fragments: number of the fragment, start, length and fingerprint."""
        ends = np.cumsum(size)
        mark = data == 32
        starts = np.zeros(len(data) + 1, bool)
        starts[1:] = mark
        starts[0] = True
        starts[ends[:-1]] = True  # fragments follow each other without a space
        word = np.flatnonzero(starts[:-1])
        stop = np.r_[word[1:], len(data)] - np.r_[mark[word[1:] - 1], False]
        first = np.r_[np.int64(0), np.cumsum(count + window - 1)[:-1]]
        at = ranges(first, count)
        a, b = word[at], stop[at + window - 1]
        return np.repeat(np.arange(number, number + len(count)), count), a + offset, b - a, slice_hashes(data, a, b)

    def run(group: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if group < 0:
            yield from batches
            return
        docs, fps, pos, count, size, data = (np.concatenate(x) for x in zip(*parts(batches), strict=True))
        begin = np.r_[np.int64(0), np.cumsum(size)]
        found = [cut(data[begin[a] : begin[b]], size[a:b], count[a:b], a, begin[a]) for a, b in _steps(begin, CUT_BYTES)]
        fragment, start, length, print_ = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(print_, kind="stable")
        ordered = print_[order]
        twice = ordered[1:] == ordered[:-1]
        some = np.sort(order[np.r_[twice, False] | np.r_[False, twice]])
        if not len(some):
            return
        suffixes = _binary(data[ranges(start[some], length[some])], length[some])
        order = pc.array_sort_indices(suffixes).to_numpy()
        ordered = suffixes.take(pa.array(order))
        deep = pc.equal(ordered.slice(1), ordered.slice(0, len(ordered) - 1)).to_numpy(zero_copy_only=False)  # neighbours with a common prefix of all words
        node = np.r_[0, np.flatnonzero(~deep) + 1]
        some = some[order]
        ids = docs[fragment[some]]
        least = np.repeat(np.minimum.reduceat(ids, node), np.diff(np.r_[node, len(some)]))
        again = np.sort(some[ids != least])
        own = fragment[again]
        place = pos[own] + again - np.r_[np.int64(0), np.cumsum(count)][own]
        yield from _marks(docs, fps, own, place, groups)

    return run


def _merge(group: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All marks of each document of a group, sorted."""
    table = pa.Table.from_batches(list(batches))
    docs, fps, counts = np.concatenate([np.frombuffer(x, np.int64).reshape(3, -1) for x in table["heads"].to_pylist()], axis=1)
    pos = np.concatenate([_from_planes(x) for x in table["pos"].to_pylist()]).astype(np.uint32)
    order = np.lexsort((pos, np.repeat(fps, counts), np.repeat(docs, counts)))
    own = np.repeat(np.arange(len(docs)), counts)[order]
    docs, fps, pos = docs[own], fps[own], pos[order]
    cuts = np.r_[0, np.flatnonzero((docs[1:] != docs[:-1]) | (fps[1:] != fps[:-1])) + 1, len(pos)]
    marks = [np.unique(pos[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    yield pa.record_batch({"doc_id": docs[cuts[:-1]], "fp": fps[cuts[:-1]], "marks": pa.array(marks, pa.binary())})


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words at starts:ends joined by one space."""
    data = np.r_[np.where(_SPACE[data], np.uint8(32), data), np.uint8(32)]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends + 1] -= 1  # with one separator; starts and ends + 1 are each distinct
    return data[np.cumsum(edge[:-1], dtype=np.int8).view(bool)].tobytes()[:-1]


def _clean(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_marks = batch.column("marks").to_pylist()
            for block in blocks(batch):
                starts, ends, first = block.words()
                removed, texts, digests, spans = [], [], [], []
                for i, marks in enumerate(all_marks[block.rows]):
                    lo, hi = first[i], first[i + 1]
                    gone = np.zeros(hi - lo + 1, np.int64)
                    if marks:
                        p = np.frombuffer(marks, np.uint32).astype(np.int64)
                        gone[p] += 1
                        np.subtract.at(gone, np.minimum(p + window, hi - lo), 1)
                    gone = np.cumsum(gone[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                    kept = np.flatnonzero(~gone) + lo
                    text = _joined(block.data[block.offsets[i] : block.offsets[i + 1]], starts[kept] - block.offsets[i], ends[kept] - block.offsets[i])
                    removed.append(int(gone.sum()))
                    texts.append(text)
                    digests.append(hashlib.sha256(text).hexdigest())
                    spans.append([{"start": int(a), "words": int(b - a)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(block.rows.start, len(removed)),
                    "n_words": np.diff(first), "n_removed": np.array(removed, np.int64),
                    "kept_text": pa.array(texts, pa.binary()).cast(pa.string()), "kept_sha256": pa.array(digests),
                    "repeats": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))),
                })

    return run


_OUT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string, repeats array<struct<start:long,words:long>>"


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the text without what repeats a document of smaller id.

    Returns doc_id, n_words, n_removed, kept_text (kept words joined by a space), kept_sha256
    and repeats (maximal removed runs, in words). A null text counts as empty: no words, the
    digest of nothing. A null id counts as the smallest possible one, -2**63, and a real id of that
    value comes back as null. Rows of equal id never remove each other's words. Texts shorter than
    the window stay whole; very long ones are read whole, one at a time. Other columns are not read.
    No rows in, no rows out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("fp", F.xxhash64("text"))
    total_text = total_bytes(base, "text")
    total = total_text // 6  # a word and its space take six bytes, about
    groups = max(4, total // GROUP_SUFFIXES)
    tasks = partitions(spark, groups, total_text)
    heavy = np.zeros(0, np.uint64)
    if total_text > MOST_SUFFIXES:  # a prefix that is missed has its suffixes spread so thin that they are at most twice as many
        least = max(1, MOST_SUFFIXES // (1 + total // FLUSH_SUFFIXES))
        crowds = base.select("text").mapInArrow(_crowds(window, least), "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n"))
        crowds = crowds.filter(F.col("n") > MOST_SUFFIXES // 2).orderBy(F.desc("n"), "prefix").limit(MOST_HEAVY)
        heavy = np.sort(np.array([r.prefix for r in crowds.collect()], np.int64).view(np.uint64))
    marks = by_group(base.mapInArrow(_deal(heavy, window, groups, FLUSH_SUFFIXES), _DEALT), _subtree(groups, window), _DEALT, tasks)
    marks = materialize(by_group(materialize(marks.select("grp", "heads", "pos"), "repeats"), _merge, _MARKED, tasks), "marks")
    both = base.join(marks, ["doc_id", "fp"], "left").select("doc_id", "text", "marks")
    out = both.mapInArrow(_clean(window), _OUT)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != -(2**63), F.col("doc_id")))


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: words, words removed as 13-word repeats of a smaller doc_id, digest of the rest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
