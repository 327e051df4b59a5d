"""N-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and word n-grams columns of a 0/1 incidence matrix; its product with its
transpose holds the overlap of every pair. Most of it need not be computed:

1. `_incidence` makes the rows (sets of 64-bit n-gram fingerprints). Documents of equal sets share
   a class and only one row per class is multiplied.
2. `_columns` takes one block of columns and leaves the n-grams that two or more classes hold,
   with their frequencies. An n-gram that a gathered stretch of documents holds many times is split
   by stretch: it sends a count instead of its classes and gets its frequency by an answer to the
   stretch (`_answers`). How many is many follows the number of stretches, so no column's entries
   outgrow COLUMN_ENTRIES.
3. `_rows` takes one block of rows. A class with n n-grams links only to classes that share at
   least ceil(n * similarity) of them: fewer shared ones, and it goes. Of the others the
   n - ceil(n * similarity) + 1 rarest n-grams are its prefix; two classes that link share an
   n-gram of both prefixes, so the product of the prefix columns says which pairs are wanted.
4. `_product` multiplies blocks of rows: a tile is a pair of row blocks with the wanted pairs in
   it, and holds each of its rows once. It goes through the blocks of columns, adds each wanted
   pair's overlap in the block to its count, and drops pairs whose count can't reach the bound that
   follows from their sizes even if all their remaining n-grams are shared.
5. Not all pairs of a group are wanted: two rounds compare each class with one leader of its prefix
   n-grams, the one with the fewest n-grams of its own, and join what links; then every pair that
   is still in different components, and whose sizes and sketches are near enough for a link, is
   wanted, so no link between components is lost.

Two classes are never taken for one: their keys of 64 bits are checked by as many other bits, and if
any two differ there all is done again with other keys. Fingerprints of n-grams count within a pair
only: an overlap of two documents with n and k n-grams is wrong with a chance of about n*k/2**64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .grouped import by_group, partitions
from .store import bounded_batches, materialize, total_bytes
from .textkit import U64, blocks, gram_hashes, mix, ranges

#: Bytes of text whose n-grams make one block of columns, or rows, on average.
GROUP_BYTES = 16 << 20
#: N-grams that a task gathers before it deals them out.
FLUSH_GRAMS = 400_000
#: Most entries of a column that go to one block, and the range of the number of classes in a
#: stretch from which on a column is split by stretch.
COLUMN_ENTRIES, LEAST_HOT, MOST_HOT = 1 << 21, 2, 256
#: N-grams of a block of rows on average, bits of a fingerprint that tell a block of columns, and
#: products of n-grams that a tile makes at a time.
TILE_GRAMS, COLUMN_BITS, TILE_STEP = 1 << 20, 3, 1 << 21
#: Bits of a class's sketch: bit i says whether an odd number of its shared n-grams fall on it. The
#: bits in which two sketches differ are at most the n-grams in which the two sets differ.
SKETCH = 512
#: Rounds that compare with a leader before all that is left is compared.
STAR_ROUNDS = 2

_POSTINGS, _COUNTS, _DOCS, _PARKED, _SHARED, _ANSWER = range(6)
_KIND = "kind int, grp long, head binary, grams binary, more binary"


def _row(kind: int, grp: int, head: np.ndarray | bytes, grams: np.ndarray, more: np.ndarray) -> tuple:
    return kind, grp, head if isinstance(head, bytes) else head.tobytes(), grams.tobytes(), more.tobytes()


def _runs(keys: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> bytes:
    """Runs of entries, 16 bytes each: class, size of its set, entries. Numbers go as planes of 16 bits, of which the upper ones are mostly zeros."""
    return keys.tobytes() + b"".join(((x >> shift) & 0xFFFF).astype(np.uint16).tobytes() for x in (sizes, counts) for shift in (0, 16))


def _from_runs(blobs: list[bytes]) -> np.ndarray:
    """Keys, sizes and counts of all runs."""
    out = []
    for x in blobs:
        n = len(x) // 16
        planes = np.frombuffer(x, np.uint16, 4 * n, 8 * n).reshape(4, n).astype(np.int64)
        out.append(np.stack([np.frombuffer(x, np.int64, n), planes[0] | planes[1] << 16, planes[2] | planes[3] << 16]))
    return np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)


def _batch(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["kind", "grp", "head", "grams", "more"])


def _cuts(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal values of x begin, and its length."""
    return np.r_[0, np.flatnonzero(x[1:] != x[:-1]) + 1, len(x)] if len(x) else np.zeros(1, np.int64)


def _sets(which: np.ndarray, grams: np.ndarray, n_docs: int, salt: int) -> tuple[np.ndarray, ...]:
    """Distinct n-grams by document, their number, the class key (0 for none) and its check."""
    order = np.lexsort((grams, which))
    which, grams = which[order], grams[order]
    new = np.r_[True, (which[1:] != which[:-1]) | (grams[1:] != grams[:-1])] if len(which) else np.zeros(0, bool)
    which, grams = which[new], grams[new]
    sizes = np.bincount(which, minlength=n_docs)
    keys, checks = np.zeros(n_docs, np.uint64), np.zeros(n_docs, np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        at = np.r_[0, np.cumsum(sizes[some])[:-1]]
        with np.errstate(over="ignore"):
            one, two, three, four = (np.add.reduceat(mix(mix(grams + U64(4 * salt + i)) ^ U64(0x5851F42D4C957F2D)), at) for i in range(4))
            keys[some] = mix(one + mix(two + sizes[some].astype(np.uint64))) | U64(1)
            checks[some] = mix(three + mix(four))
    return which, grams, sizes, keys.view(np.int64), checks.view(np.int64)


def _incidence(n: int, groups: int, hot_from: int, salt: int):
    def deal(ids, which, grams) -> Iterator[pa.RecordBatch]:
        which, grams, sizes, keys, checks = _sets(which, grams, len(ids), salt)
        rows = [_row(_DOCS, -1 - int(keys[0] % groups), np.stack([ids, sizes, keys, checks]), grams[:0], grams[:0])]
        _, first = np.unique(keys, return_index=True)
        take = np.isin(which, first)
        which, grams = which[take], grams[take]
        order = np.lexsort((which, grams))
        cuts = _cuts(grams[order])
        counts = np.diff(cuts)
        hot = np.repeat(counts >= hot_from, counts)
        stretch = int(np.add.reduce(keys[first])) if hot.any() else 0  # the same whenever this stretch is gathered again
        block = lambda g: (g % U64(groups)).astype(np.int64)
        for park in np.split(order[hot], np.cumsum(counts[counts >= hot_from])[:-1]) if hot.any() else []:
            gram = grams[park[:1]]
            rows.append(_row(_PARKED, -1 - stretch % groups, np.stack([keys[which[park]], sizes[which[park]]]), gram, np.array([stretch])))
            rows.append(_row(_COUNTS, int(block(gram)[0]), np.array([len(park)]), gram, np.array([stretch])))
        order = order[~hot]
        col = block(grams[order])
        order = order[np.lexsort((which[order], col))]
        col.sort()
        at = _cuts(col)
        for a, b in zip(at[:-1], at[1:], strict=True):
            part = order[a:b]
            runs = _cuts(which[part])
            own = which[part[runs[:-1]]]
            rows.append(_row(_POSTINGS, int(col[a]), _runs(keys[own], sizes[own], np.diff(runs)), grams[part], grams[:0]))
        yield from _batch(rows).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n_docs = [], 0, 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for block in blocks(batch):
                starts, ends, first = block.words()
                words = np.diff(first)
                counts = np.where(words >= n, words - n + 1, np.minimum(words, 1))
                at = ranges(first[:-1], counts)
                which = np.repeat(np.arange(len(counts)), counts)
                hashes = block.word_hashes(starts, ends, lower=True)
                held.append((ids[block.rows], which + n_docs, gram_hashes(hashes, at, np.minimum(at + n, first[1:][which]))))
                n_docs += len(counts)
                size += len(at)
                if size >= FLUSH_GRAMS:
                    yield from deal(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, size, n_docs = [], 0, 0
        if held:
            yield from deal(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _shared(keys, sizes, grams, freq, groups: int) -> list[tuple]:
    """Entries of the matrix, dealt to blocks of rows."""
    block = keys % groups
    order = np.lexsort((keys, block))
    block, keys, sizes, grams, freq = block[order], keys[order], sizes[order], grams[order], freq[order]
    out, at = [], _cuts(block)
    for a, b in zip(at[:-1], at[1:], strict=True):
        runs = _cuts(keys[a:b])
        own = a + runs[:-1]
        out.append(_row(_SHARED, int(block[a]), _runs(keys[own], sizes[own], np.diff(runs)), grams[a:b], freq[a:b].astype(np.uint32)))
    return out


def _columns(groups: int):
    def run(group: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if group < 0:  # for others
            yield from batches
            return
        rows = pa.Table.from_batches(list(batches)).to_pylist()
        posted = [r for r in rows if r["kind"] == _POSTINGS]
        counted = [r for r in rows if r["kind"] == _COUNTS]
        heads = _from_runs([r["head"] for r in posted])
        grams = np.concatenate([np.frombuffer(r["grams"], np.uint64) for r in posted] or [np.zeros(0, np.uint64)])
        del rows, posted
        _, first = np.unique(heads[0], return_index=True)  # equal sets send equal runs
        keep = np.zeros(heads.shape[1], bool)
        keep[first] = True
        take = np.repeat(keep, heads[2])
        run_of = np.repeat(np.arange(heads.shape[1], dtype=np.int32), heads[2])[take]
        grams = grams[take]
        order = np.argsort(grams, kind="stable")
        grams, run_of = grams[order], run_of[order]
        cuts = _cuts(grams)
        counts = np.diff(cuts)
        if counted:
            hot, at = np.unique(np.array([np.frombuffer(r["grams"], np.uint64)[0] for r in counted]), return_inverse=True)
            total = np.bincount(at, np.array([np.frombuffer(r["head"], np.int64)[0] for r in counted])).astype(np.int64)
            values = grams[cuts[:-1]]
            spot = np.searchsorted(values, hot)
            found = np.flatnonzero((spot < len(values)) & (values[np.minimum(spot, len(values) - 1)] == hot)) if len(values) else np.zeros(0, np.int64)
            total[found] += counts[spot[found]]
            freq = counts.copy()
            freq[spot[found]] = total[found]
        else:
            freq = counts
        freq = np.repeat(freq, counts)
        keep = freq >= 2
        run_of, grams, freq = run_of[keep], grams[keep], freq[keep]
        out = _shared(heads[0][run_of], heads[1][run_of], grams, freq, groups)
        for r, i in zip(counted, at if counted else [], strict=True):
            stretch = int(np.frombuffer(r["more"], np.int64)[0])
            out.append((_ANSWER, -1 - stretch % groups, np.array([total[i]]).tobytes(), r["grams"], r["more"]))
        yield from _batch(out).to_batches()

    return run


def _answers(groups: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        freq = {r["grams"]: int(np.frombuffer(r["head"], np.int64)[0]) for r in rows if r["kind"] == _ANSWER}
        out = []
        for r in rows:
            if r["kind"] == _PARKED:
                keys, sizes = np.frombuffer(r["head"], np.int64).reshape(2, -1)
                gram = np.repeat(np.frombuffer(r["grams"], np.uint64), len(keys))
                out += _shared(keys, sizes, gram, np.full(len(keys), freq[r["grams"]]), groups)
        return _batch(out)

    return run


def _rows(percent: int):
    def run(group: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).to_pylist()
        heads = _from_runs([r["head"] for r in rows])
        grams = np.concatenate([np.frombuffer(r["grams"], np.uint64) for r in rows])
        freq = np.concatenate([np.frombuffer(r["more"], np.uint32) for r in rows])
        del rows
        keys, at, inverse = np.unique(heads[0], return_index=True, return_inverse=True)
        sizes = heads[1][at]
        key = np.repeat(inverse.astype(np.int32), heads[2])
        order = np.lexsort((grams, key))
        key, grams, freq = key[order], grams[order], freq[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (grams[1:] != grams[:-1])]
        key, grams, freq = key[new], grams[new], freq[new]
        shared = np.bincount(key, minlength=len(keys))
        least = -(-percent * sizes // 100)
        good = shared >= least
        take = good[key]
        key, grams, freq = key[take], grams[take], freq[take]
        end = np.cumsum(shared[good])
        place = np.repeat(np.arange(good.sum()), shared[good]) * SKETCH + ((grams >> U64(20)) % U64(SKETCH)).astype(np.int64)
        sketch = np.packbits((np.bincount(place, minlength=int(good.sum()) * SKETCH) % 2).astype(bool)).view(np.int64).reshape(-1, SKETCH // 64)
        rare = grams[np.lexsort((grams, freq, key))].view(np.int64)
        prefix = [rare[b - s : b - m + 1] for b, s, m in zip(end, shared[good], least[good], strict=True)]
        yield pa.record_batch({
            "key": keys[good], "n": sizes[good], "m": shared[good],
            "grams": pa.array([grams[b - s : b].tobytes() for b, s in zip(end, shared[good], strict=True)], pa.binary()),
            "prefix": pa.array(prefix, pa.list_(pa.int64())), "sketch": pa.array(list(sketch), pa.list_(pa.int64())),
        })

    return run


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for head in batch.column("head").to_pylist():
            ids, sizes, keys, checks = np.frombuffer(head, np.int64).reshape(4, -1)
            yield pa.record_batch({"doc_id": ids, "n": sizes, "key": pa.array(keys, mask=sizes == 0), "check": checks})


_TILE = "grp long, side int, key long, n long, grams binary, b long"
_ROW_A, _ROW_B, _PAIR = range(3)


def _tile(percent: int):
    """The linked ones of a tile's wanted pairs."""

    def run(group: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        side, key = table["side"].to_numpy(), table["key"].to_numpy()
        wanted = np.flatnonzero(side == _PAIR)
        sides = []
        for kind, asked in ((_ROW_A, key[wanted]), (_ROW_B, table["b"].to_numpy()[wanted])):
            at = np.flatnonzero(side == kind)
            at = at[np.argsort(key[at])]
            blobs = table["grams"].take(pa.array(at)).to_pylist()
            size = np.array([len(x) // 8 for x in blobs])
            grams = np.frombuffer(b"".join(blobs), np.uint64)
            row = np.repeat(np.arange(len(at)), size)
            sides.append((grams, row, np.searchsorted(key[at], asked), table["n"].to_numpy()[at], size))
        (grams_a, row_a, of_a, n_a, left_a), (grams_b, row_b, of_b, n_b, left_b) = sides
        need = -(-percent * (n_a[of_a] + n_b[of_b]) // (100 + percent))
        count = np.zeros(len(wanted), np.int64)
        alive = np.flatnonzero(np.minimum(left_a[of_a], left_b[of_b]) >= need)
        block_a, block_b = grams_a >> U64(64 - COLUMN_BITS), grams_b >> U64(64 - COLUMN_BITS)
        for column in range(1 << COLUMN_BITS):
            if not len(alive):
                break
            in_a, in_b = block_a == U64(column), block_b == U64(column)
            names, ids = np.unique(np.r_[grams_a[in_a], grams_b[in_b]], return_inverse=True)
            a, b = ids[: in_a.sum()], ids[in_a.sum() :]
            cells = row_b[in_b] * len(names) + b  # rows in order, and the n-grams of each: sorted
            size_a, size_b = np.bincount(row_a[in_a], minlength=len(n_a)), np.bincount(row_b[in_b], minlength=len(n_b))
            begin = np.r_[0, np.cumsum(size_a)]
            step = np.cumsum(size_a[of_a[alive]]) // TILE_STEP
            for part in np.split(alive, np.flatnonzero(np.diff(step)) + 1):
                own = of_a[part]
                product = np.repeat(of_b[part], size_a[own]) * len(names) + a[ranges(begin[own], size_a[own])]
                place = np.minimum(np.searchsorted(cells, product), max(len(cells) - 1, 0))
                hit = cells[place] == product if len(cells) else np.zeros(len(product), bool)
                count[part] += np.bincount(np.repeat(np.arange(len(part)), size_a[own]), hit, len(part)).astype(np.int64)
            left_a, left_b = left_a - size_a, left_b - size_b
            alive = alive[count[alive] + np.minimum(left_a[of_a[alive]], left_b[of_b[alive]]) >= need[alive]]
        linked = alive[count[alive] >= need[alive]]
        yield pa.record_batch({"a": key[wanted][linked], "b": table["b"].to_numpy()[wanted][linked]})

    return run


def _product(pairs: DataFrame, rows: DataFrame, percent: int, row_blocks: int, tasks: int) -> DataFrame:
    """Those wanted pairs of classes (a, b) whose sets are similar enough."""
    of = lambda c: F.pmod(F.xxhash64(c), F.lit(row_blocks))
    tiled = materialize(pairs.select("a", "b", (of("a") * row_blocks + of("b")).alias("grp")), "pairs")
    asked = tiled.select("grp", F.lit(_ROW_A).alias("side"), F.col("a").alias("key")).union(tiled.select("grp", F.lit(_ROW_B), "b")).distinct()
    given = asked.join(rows.select("key", "n", "grams"), "key").select("grp", "side", "key", "n", "grams", F.lit(0).cast("long").alias("b"))
    wanted = tiled.select("grp", F.lit(_PAIR).alias("side"), F.col("a").alias("key"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("grams"), "b")
    return by_group(given.union(wanted), _tile(percent), "a long, b long", tasks)


def _band(n: str, percent: int) -> Column:
    """Number of a range of sizes, so wide that sizes near enough for a link lie in one range or in two that follow each other."""
    # a little wider than the ratio, so that rounding never puts two near sizes three ranges apart
    width = math.log(100 / percent) * (1 + 1e-9)
    return F.floor(F.log(F.col(n)) / width) if percent < 100 else F.col(n)


def _banded(left: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows of left (columns with _a and _b) that share an n-gram, are in different components and lie in one band or in two that follow each other.

    Each row waits in its own band for rows of that band and of the next; a pair always comes in the same order.
    """
    named = lambda x: left.select("gram", _band("n", percent).alias(f"band_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in left.columns if c != "gram"))
    waiting = named("a").withColumn("band", F.col("band_a"))
    coming = named("b").withColumn("band", F.explode(F.array(F.col("band_b"), F.col("band_b") - 1)))
    return waiting.join(coming, ["gram", "band"]).filter("comp_a < comp_b OR (band_a < band_b AND comp_a <> comp_b)")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (key, comp) after links between keys."""
    links = materialize(links, "links")
    if links.isEmpty():
        return labels
    of = lambda x: labels.select(F.col("key").alias(x), F.col("comp").alias(f"comp_{x}"))
    edges = links.join(of("a"), "a").join(of("b"), "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    found = components(edges)
    return materialize(labels.join(found, labels["comp"] == found["v"], "left").select("key", F.coalesce("label", "comp").alias("comp")), "comps")


def _matrix(base: DataFrame, n: int, groups: int, tasks: int, hot_from: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The blocks of columns, all documents (doc_id, n, key) and the classes (key, least: their smallest doc_id)."""
    for salt in range(8):
        matrix = materialize(by_group(base.mapInArrow(_incidence(n, groups, hot_from, salt), _KIND), _columns(groups), _KIND, tasks), "matrix")
        listed = materialize(matrix.filter(F.col("kind") == _DOCS).select("head").mapInArrow(_documents, "doc_id long, n long, key long, check long"), "listed")
        classes = materialize(listed.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"), (F.min("check") < F.max("check")).alias("mixed")), "classes")
        if classes.filter("mixed").isEmpty():
            return matrix, listed, classes.drop("mixed")
    raise RuntimeError("different sets share a key under each of eight salts")


def similar_groups(docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest id reachable by links).

    Two documents link when 100 * |A and B| >= percent * |A or B| of their sets of n-word
    shingles (A-Z folded). Texts with fewer words are one shingle. A null or wordless text has no
    shingle and links with nothing, so its component is its own id. A null id counts as the
    smallest long, -2**63, and a real id of that value comes back as null. Rows of equal id each
    count; their component is the least they reach together by text. Very long texts are read
    whole, one at a time. Other columns are not read. No rows in, no rows out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = total_bytes(base, "text")
    groups = max(4, total // GROUP_BYTES)
    tasks = partitions(spark, groups, total)
    stretches = 1 + total // (6 * FLUSH_GRAMS)  # a word and its space take six bytes, about
    hot_from = min(MOST_HOT, max(LEAST_HOT, COLUMN_ENTRIES // stretches))
    matrix, listed, classes = _matrix(base, n, groups, tasks, hot_from)
    kept = matrix.filter(F.col("kind") == _SHARED)
    if not matrix.filter(F.col("kind") == _PARKED).isEmpty():
        kept = kept.union(matrix.filter(F.col("kind").isin(_PARKED, _ANSWER)).groupBy("more").applyInArrow(_answers(groups), _KIND))
    rows = materialize(by_group(kept, _rows(percent), "key long, n long, m long, grams binary, prefix array<long>, sketch array<long>", tasks), "rows")
    row_blocks = 1 + (rows.agg(F.sum("m")).first()[0] or 0) // TILE_GRAMS

    post = rows.select("key", "n", "m", F.explode("prefix").alias("gram"))
    # a component is known by its class with the smallest doc_id; keys tell classes of one id apart
    labels = materialize(rows.select("key").join(classes, "key").select("key", F.struct("least", "key").alias("comp")), "comps")
    # an overlap is at most the smaller set, and at most what either set shares with any other
    most = "least(n_a, n_b, m_a, m_b)"
    fits = f"100 * {most} >= {percent} * (n_a + n_b - {most})"
    # the hints make small inputs run as large ones do, whose sides are no broadcasts
    for turn in range(STAR_ROUNDS + 1):
        own = materialize(post.join(labels.hint("merge"), "key").select("gram", "key", "n", "m", F.col("comp.key").alias("comp")), "prefixes")
        leader = F.min(F.struct(F.col("n") - F.col("m"), F.xxhash64("key", F.lit(turn)), F.col("key").alias("b")))
        mixed = own.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), leader.alias("leader")).filter("low < high")
        # all classes of any other n-gram are joined already; written, so that the join of a frequent n-gram can be split
        mixed = materialize(mixed.select("gram", "leader.b"), "leaders")
        mine = materialize(own.join(mixed.hint("merge"), "gram"), "mixed")
        post = mine.select("key", "n", "m", "gram")
        side = lambda x: (F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col("m").alias(f"m_{x}"), F.col("comp").alias(f"comp_{x}"))
        if turn < STAR_ROUNDS:
            near = mine.filter("key <> b").select(*side("a"), "b").groupBy("a", "n_a", "m_a", "comp_a", "b").count()
            about = materialize(rows.select("key", "n", "m").join(labels.select("key", F.col("comp.key").alias("comp")), "key").select(*side("b")), "about")
            near = near.join(about, "b").filter("comp_a <> comp_b").filter(fits)
            pairs = near.groupBy("a").agg(F.max_by("b", F.struct("count", "b")).alias("b"))
        else:
            bits = rows.select("key", *(F.col("sketch")[i].alias(f"bits{i}") for i in range(SKETCH // 64)))
            left = materialize(mine.drop("b").join(bits, "key"), "left")
            apart = " + ".join(["n_a - m_a + n_b - m_b", *(f"bit_count(bits{i}_a ^ bits{i}_b)" for i in range(SKETCH // 64))])
            near = f"{100 + percent} * ({apart}) <= {100 - percent} * (n_a + n_b)"
            pairs = _banded(left, percent).filter(fits).filter(near).select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()
        labels = _merge(labels, _product(pairs, rows, percent, row_blocks, tasks))

    found = classes.join(labels, "key", "left").select("key", F.coalesce("comp.least", "least").alias("component_id"))
    out = listed.join(found, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    null = lambda c: F.when(F.col(c) != -(2**63), F.col(c)).alias(c)
    return out.select(null("doc_id"), "n_shingles", null("component_id"))


def op10_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Groups of documents linked at 0.75 or more on five-word shingles."""
    return similar_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
