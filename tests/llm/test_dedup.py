import hashlib

import numpy as np
import pytest
from brute import exact, jaccard, split, substring

from tallyweld.llm import exact as ex, jaccard as ja, substring as su
from tallyweld.llm.components import components


def pairs(df):
    low = -(2**63)
    return [(low if r.doc_id is None else r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(i):
    return -(2**63) if i is None else i


def test_substring(docs):
    got = su.remove_repeats(docs).collect()
    assert sorted((key(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(substring(pairs(docs)))
    for r in got:
        assert sum(x["words"] for x in r.repeats) == r.n_removed and len(split(r.kept_text)) == r.n_words - r.n_removed


def small(monkeypatch):
    """Many groups, long prefixes, tiny stretches, and prefixes that are lengthened."""
    for name, value in (("GROUP_SUFFIXES", 50), ("MOST_SUFFIXES", 40), ("FLUSH_SUFFIXES", 100)):
        monkeypatch.setattr(su, name, value)


def test_substring_splits_and_small_stretches(docs, monkeypatch):
    small(monkeypatch)
    assert sorted((key(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in su.remove_repeats(docs).collect()) == sorted(substring(pairs(docs)))


@pytest.mark.parametrize("tiny", [False, True])
def test_substring_one_prefix_in_half_of_all_suffixes(spark, monkeypatch, tiny):
    if tiny:
        small(monkeypatch)
    r = np.random.default_rng(6)
    rows = []
    for i in range(60):
        w = [x for k in r.integers(0, 40, 80) for x in ("the", f"v{k}")]
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(rows[i][1].split(" ")[20:60]) + " tail") for i in range(0, 60, 7)]
    rows += [(200, " ".join(["the"] * 3000)), (201, " ".join(["the"] * 40)), (202, None), (203, "the \t\n the")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = substring(rows)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in su.remove_repeats(df).collect()) == sorted(want)
    assert sum(x[2] for x in want) > 300


def test_substring_other_window(docs):
    assert sorted((key(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in su.remove_repeats(docs, window=4).collect()) == sorted(substring(pairs(docs), 4))


def test_jaccard(docs):
    got = ja.similar_groups(docs).collect()
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == sorted(jaccard(pairs(docs)))


def test_jaccard_lower_bound_and_words(docs):
    got = ja.similar_groups(docs, n=3, percent=50).collect()
    import brute

    old = brute.shingles
    brute.shingles = lambda t, n=3: old(t, 3)
    try:
        want = jaccard(pairs(docs), 50)
    finally:
        brute.shingles = old
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == sorted(want)


def test_jaccard_splits(docs, monkeypatch):
    """Many blocks of columns and rows, small stretches, columns that are split by stretch, tiles in steps."""
    for name, value in (("GROUP_BYTES", 5000), ("FLUSH_GRAMS", 300), ("COLUMN_ENTRIES", 40), ("TILE_GRAMS", 200), ("TILE_STEP", 50)):
        monkeypatch.setattr(ja, name, value)
    got = ja.similar_groups(docs).collect()
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == sorted(jaccard(pairs(docs)))


def test_jaccard_tile_is_the_masked_product():
    """Of the wanted pairs just those with enough in common, whatever the blocks of columns."""
    import pyarrow as pa

    r = np.random.default_rng(3)
    pool = np.unique(r.integers(0, 2**63, 300).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    base = [set(r.choice(pool, 60, replace=False)) for _ in range(4)]
    sets = [{g for g in b if r.random() < keep} for b in base for keep in (1, 0.95, 0.9, 0.8, 0.7, 0.5)]
    side = lambda kind, keys: [(0, kind, k, len(sets[k]), np.sort(np.array(list(sets[k]), np.uint64)).tobytes(), 0) for k in keys]
    wanted = [(a, b) for a in range(len(sets)) for b in range(a) if r.random() < 0.8]
    rows = side(0, sorted({a for a, _ in wanted})) + side(1, sorted({b for _, b in wanted})) + [(0, 2, a, 0, None, b) for a, b in wanted]
    r.shuffle(rows)
    names, kinds = ["grp", "side", "key", "n", "grams", "b"], [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    columns = [pa.array([None if x is None else x if isinstance(x, bytes) else int(x) for x in c], k) for c, k in zip(zip(*rows), kinds)]
    got = [x for out in ja._tile(75)(0, iter([pa.record_batch(columns, names=names)])) for x in zip(out["a"].to_pylist(), out["b"].to_pylist())]
    assert sorted(got) == sorted((a, b) for a, b in wanted if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])) and len(got) > 5


@pytest.mark.parametrize("percent", [1, 50, 75, 80, 99, 100])
def test_jaccard_bands_lose_no_near_sizes(spark, percent):
    """Every pair of sizes that a link allows meets once, and rows of far sizes don't meet."""
    sizes = sorted({*range(1, 60), *(2**i for i in range(6, 20)), *(-(-100 * 2**i // percent) for i in range(20)), *(100 * 2**i // percent for i in range(20))})
    left = spark.createDataFrame([(1, k, n, k) for k, n in enumerate(sizes)], "gram long, key long, n long, comp long")
    got = [(min(r.key_a, r.key_b), max(r.key_a, r.key_b)) for r in ja._banded(left, percent).select("key_a", "key_b").collect()]
    assert len(got) == len(set(got))
    near = {(i, j) for j in range(len(sizes)) for i in range(j) if 100 * sizes[i] >= percent * sizes[j]}
    assert near <= set(got)
    assert all(percent**2 * sizes[j] <= 100**2 * sizes[i] * 1.001 or sizes[j] - sizes[i] == 1 for i, j in got)


def test_jaccard_equal_keys_are_noticed(docs, monkeypatch):
    """Where different sets get one key, all is done again with another salt."""
    real, salts = ja._sets, []

    def sets(which, grams, n_docs, salt):
        which, grams, sizes, keys, checks = real(which, grams, n_docs, salt)
        return which, grams, sizes, keys if salt else np.where(sizes > 0, keys % 8 + 9, 0), checks

    monkeypatch.setattr(ja, "_sets", sets)
    incidence = ja._incidence
    monkeypatch.setattr(ja, "_incidence", lambda n, groups, hot, salt: salts.append(salt) or incidence(n, groups, hot, salt))
    got = ja.similar_groups(docs).collect()
    assert salts == [0, 1]
    assert sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in got) == sorted(jaccard(pairs(docs)))


def test_jaccard_one_id_two_texts(spark):
    """Texts of one id are no link between their groups."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a), (5, b), (7, a + " more"), (8, b + " more"), (3, b + " other"), (9, c), (None, c + " x"), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in ja.similar_groups(df).collect())
    assert got == sorted(jaccard([(key(i), t) for i, t in rows]))


def test_jaccard_hot_ngrams_are_counted(spark):
    """A passage in more documents of a batch than HOT goes by counts; its near copies still link."""
    r = np.random.default_rng(0)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"u{x}" for x in r.integers(0, 10**9, 60 if i % 3 else 2)])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {x.doc_id: x.component_id for x in ja.similar_groups(df).collect()}
    assert {got[i] for i in range(0, 600, 3)} == {0}
    assert all(got[i] == i for i in range(600) if i % 3)


def test_exact(docs):
    rows = ex.digests(docs)
    got = ex.exact_groups(rows).collect()
    assert sorted((key(r.doc_id), key(r.keep_id), r.group_size, bytes(r.digest).hex()) for r in got) == sorted(exact(pairs(docs)))
    stays = [r for r in got if r.kept]
    assert len(stays) == len({bytes(r.digest) for r in got}) and all(r.doc_id == r.keep_id for r in stays)


def test_exact_many_shards_and_copies(docs, monkeypatch):
    monkeypatch.setattr(ex, "SHARD_KEYS", 8)
    monkeypatch.setattr(ex, "LOOKUP_ROWS", 3)
    got = ex.exact_groups(ex.digests(docs)).collect()
    assert sorted((key(r.doc_id), key(r.keep_id), r.group_size, bytes(r.digest).hex()) for r in got) == sorted(exact(pairs(docs)))


def test_exact_against_history(spark):
    old = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    new = spark.createDataFrame([(10, "a"), (11, "c"), (12, "c"), (13, None), (14, "")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in ex.against_history(ex.digests(new), ex.digests(old)).collect()}
    assert got == {10: (2, 2, False), 11: (12, 2, False), 12: (12, 2, True), 13: (14, 2, False), 14: (14, 2, True)}


def test_exact_comes_from_lookups(spark, monkeypatch):
    """Without lookups that find anything, no row of the smaller ids joins a group of the larger ones."""
    real = ex.look_up
    calls = []

    def blind(rows, known):
        calls.append(1)
        return real(rows, known.filter("false")) if len(calls) == 1 else real(rows, known)

    df = spark.createDataFrame([(0, "a"), (1, "b"), (9, "a"), (10, "b"), (10, "c")], "doc_id long, text string")
    whole = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in ex.exact_groups(ex.digests(df)).collect()}
    monkeypatch.setattr(ex, "look_up", blind)
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in ex.exact_groups(ex.digests(df)).collect()}
    assert whole == {(0, 9, 2, False), (9, 9, 2, True), (1, 10, 2, False), (10, 10, 2, True), (10, 10, 1, True)}
    assert got == {(0, 0, 1, True), (9, 9, 1, True), (1, 1, 1, True), (10, 10, 1, True)}


def test_exact_halves(spark):
    """Repeats on either side of the cut, on one side only, null ids and equal ids."""
    rows = [(0, "a"), (9, "a"), (10, "a"), (1, "b"), (2, "b"), (8, "c"), (9, "c"), (None, "a"), (None, "d"), (None, "d"), (3, "e"), (3, "e"), (10, "f"), (10, "f"), (5, None), (6, "")]
    df = spark.createDataFrame([(*x, "r", 1) for x in rows], "doc_id long, text string, row string, digest int")
    got = ex.exact_groups(ex.digests(df)).collect()
    want = exact([(key(i), t) for i, t in rows])
    assert sorted((key(r.doc_id), key(r.keep_id), r.group_size, bytes(r.digest).hex()) for r in got) == sorted(want)
    assert sum(r.kept for r in got) == 7
    out = ex.drop_copies(df)
    assert out.columns == df.columns and sorted((key(r.doc_id), r.text or "") for r in out.collect()) == sorted({(k, next(t or "" for i, t in rows if hashlib.sha256((t or "").encode()).hexdigest() == h)) for _, k, _, h in want})


def test_drop_copies(docs):
    kept = ex.drop_copies(docs)
    assert kept.columns == docs.columns
    got = sorted((key(r.doc_id), r.text or "") for r in kept.collect())
    best = {}
    for i, t in pairs(docs):
        best[t or ""] = max(best.get(t or "", i), i)
    assert got == sorted((i, t) for t, i in best.items())


@pytest.mark.parametrize("n", [1, 2, 100, 5000])
def test_perfect_hash_is_minimal(n):
    d = np.random.default_rng(n).integers(0, 2**63, (n, 4)).astype(np.uint64)
    levels = ex.build_levels(d)
    assert sorted(ex.slots(levels, d)) == list(range(n))


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.v: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(51)) and got[101] == 100 and all(got[200 + i] == 200 for i in range(30))


def test_empty(none):
    assert su.remove_repeats(none).count() == 0
    assert ja.similar_groups(none).count() == 0
    assert ex.exact_groups(ex.digests(none)).count() == 0
    assert ex.drop_copies(none).count() == 0
