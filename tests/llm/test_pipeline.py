from collections import Counter

from brute import crc32, exact, jaccard, split, targets, tokens, verdicts

import corpus_pipeline as cp


def test_stages_against_plain_python(spark, docs, tmp_path):
    docs = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {r.doc_id: r for r in docs.collect()}

    def check(stage):
        nonlocal docs, left
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{stage.__name__}")
        docs = spark.read.parquet(f"{tmp_path}/{stage.__name__}")
        rows = docs.collect()
        before, left = left, {r.doc_id: r for r in rows}
        return before, rows

    before, rows = check(cp.quality_rules)
    judged = list(before.values())
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r, kept in zip(judged, verdicts([r.text for r in judged])) if kept)
    assert 0 < len(rows) < len(judged)

    before, rows = check(cp.exact_dedup)
    assert sorted(r.doc_id for r in rows) == sorted({k for _, k, _, _ in exact([(r.doc_id, r.text) for r in before.values()])})

    before, rows = check(cp.near_duplicates)
    assert sorted(r.doc_id for r in rows) == sorted({c for _, _, c in jaccard([(r.doc_id, r.text) for r in before.values()])})

    before, rows = check(cp.mixing)
    sizes, taken = Counter(), Counter()
    for r in before.values():
        sizes[r.source] += len(split(r.text))
    got = Counter()
    for r in rows:
        n = len(split(r.text))
        got[r.doc_id] += n
        taken[r.source] += n
        assert before[r.doc_id].text == r.text or split(before[r.doc_id].text)[:n] == split(r.text)
    assert all(n <= 2 * len(split(before[i].text)) for i, n in got.items())
    # only blocks of words are drawn, so a source comes near its target
    assert all(abs(taken[s] - t) <= 1 for s, t in targets(sizes).items())

    packed = cp.packing(spark, docs, str(tmp_path)).collect()
    want, pieces = Counter(), Counter()
    for r in rows:
        ids = tokens(r.text, 2)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        pieces.update((r.doc_id, i, s, e - s, crc32(ids[s:e])) for i, (s, e) in enumerate(zip(cuts, cuts[1:])))
    want.update(tuple(r)[:5] for r in packed)
    assert want == pieces
    filled = {}
    for r in sorted(packed, key=lambda r: r.offset):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 1024

    whole = cp.run(spark, str(tmp_path)).collect()
    assert sorted(tuple(r)[:5] for r in whole) == sorted(tuple(r)[:5] for r in packed)


def test_stage_list():
    assert [f.__name__ for _, f in cp.STAGES] == ["quality_rules", "exact_dedup", "near_duplicates", "mixing", "packing"]


def test_empty_table(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_nulls_and_repeated_rows(spark, docs, tmp_path):
    """Null ids, null texts and repeated rows go through all stages; what stays are the texts that plain Python keeps."""
    docs = docs.unionByName(docs.filter("doc_id IS NULL OR doc_id % 7 = 0"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [r for r in docs.collect() if r.doc_id is not None or r.text]
    low = lambda i: -(2**63) if i is None else i
    judged = [r for r, kept in zip(rows, verdicts([r.text for r in rows])) if kept]
    stay = {k: t for t, k in {r.text: max(low(x.doc_id) for x in judged if x.text == r.text) for r in judged}.items()}
    groups = jaccard(list(stay.items()))
    ids = {c for _, _, c in groups}
    got = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in cp.STAGES[:3]:
        got = stage(spark, got, str(tmp_path))
        got.write.parquet(f"{tmp_path}/{stage.__name__}")
        got = spark.read.parquet(f"{tmp_path}/{stage.__name__}")
    assert sorted(low(r.doc_id) for r in got.collect()) == sorted(ids)
    mixed = cp.mixing(spark, got, str(tmp_path))
    assert {low(r.doc_id) for r in mixed.select("doc_id").distinct().collect()} <= ids
    assert cp.run(spark, str(tmp_path)).select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
