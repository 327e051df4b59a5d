"""First-fit decreasing: every id once, no gaps, little padding."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyweld.llm import ffd
from tallyweld.llm.packing import vocabulary

SF = "/root/testdata/sf0.001"


def brute(lengths, capacity):
    free, out = [], []
    for n in lengths:
        at = next((i for i, f in enumerate(free) if f >= n), None)
        if at is None:
            at = len(free)
            free.append(capacity)
        free[at] -= n
        out.append(at)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_first_fit_and_fill(seed):
    """The tree finds what a scan from the left finds; filling loses no token and leaves powers of two only."""
    r = random.Random(seed)
    capacity = r.choice([1, 2, 7, 16, 64, 2048])
    shape = r.choice([lambda: r.randint(1, capacity), lambda: capacity, lambda: min(capacity, capacity // 2 + 1), lambda: 1, lambda: max(1, int(capacity * r.random() ** 4))])
    lengths = sorted((shape() for _ in range(r.choice([0, 1, 2, 50, 700]))), reverse=True)
    bins = ffd.first_fit(lengths, capacity)
    assert bins == brute(lengths, capacity)
    parts = ffd.filled(lengths, bins, capacity)
    covered = defaultdict(list)
    used = Counter()
    for p, a, b, s in parts:
        assert a < b
        covered[p].append((a, b))
        used[s] += b - a
    for p, n in enumerate(lengths):
        spans = sorted(covered[p])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    assert all(n == capacity or n & (n - 1) == 0 for n in used.values()) and len(used) <= sum(lengths) // capacity + capacity.bit_length()


def held(rows, texts, capacity, end_id, encode):
    """Every document's ids lie in exactly one piece each, and sequences have no gaps. Returns (sequences, padding)."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    want = defaultdict(Counter)
    for doc_id, text in texts:
        want[doc_id][tuple([*encode(text or ""), end_id])] += 1
    for doc_id, own in by_doc.items():
        if sum(want[doc_id].values()) == 1:
            (ids,) = want[doc_id]
            own.sort(key=lambda r: r["start"])
            at = 0
            for r in own:
                assert r["start"] == at and r["doc_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
                at += r["length"]
            assert at == len(ids)
        else:  # rows of one id: lengths add up
            assert sum(r["length"] for r in own) == sum(len(x) * n for x, n in want[doc_id].items())
    assert set(by_doc) == set(want)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return len(by_sequence), padding


def encoder():
    tokenizer = Tokenizer.from_file(vocabulary())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_whole_table(spark):
    """The registered query against the tokenizer itself, over all documents: no padding at all."""
    from tallyweld.llm.queries import QUERIES

    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = [r.asDict() for r in QUERIES["op13_packing"](spark, SF).collect()]
    n, padding = held(rows, texts, 2048, 1, encoder())
    total = sum(r["length"] for r in rows)
    assert padding == 0 and total // 2048 <= n <= total // 2048 + 11


@pytest.mark.parametrize("group_bytes", [1 << 12, 1 << 25])
def test_odd_rows(spark, docs, group_bytes):
    """Nulls, empty and very long texts, repeated rows, clashing columns, in one group and in many."""
    made = ffd.pack_first_fit(docs, capacity=256, end_id=7, group_bytes=group_bytes)
    rows = [{**r.asDict(), "ids_crc32": zlib.crc32(r.ids)} for r in made.collect()]
    _, padding = held(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 256, 7, encoder())
    assert padding == 0
    assert len({r["sequence_id"] >> 32 for r in rows}) == (1 if group_bytes > 1 << 20 else len({r["sequence_id"] >> 32 for r in rows}))


def test_repeats_of_one_row_are_dealt(spark):
    """A third of all rows being the same row makes no large group."""
    one = spark.range(0, 3000, 1, 4).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS doc_id", "CASE WHEN id % 3 = 0 THEN 'the same text' ELSE concat('other ', id) END AS text")
    sizes = Counter(r.sequence_id >> 32 for r in ffd.pack_first_fit(one, capacity=64, group_bytes=1 << 14).collect() if r.doc_id == 5)
    assert len(sizes) > 10 and max(sizes.values()) < 3 * sum(sizes.values()) / len(sizes)


def test_no_rows(none):
    assert ffd.pack_first_fit(none).collect() == []
