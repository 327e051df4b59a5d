import functools
import hashlib

import numpy as np
import pytest
from brute import crc32, quality, split, targets, tokens
from pyspark.sql import functions as F

from tallyweld.llm import chat, langid, mixing, packing, pii, quality as qu
from tallyweld.llm.textkit import Block, gram_hashes


def block(*texts):
    data = [t.encode() for t in texts]
    return Block(slice(0, len(texts)), np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(x) for x in data])])


def test_words_and_hashes():
    b = block("ab cd", "ab", "", "  cd\x0bAB ", "cd")
    starts, ends, first = b.words()
    assert list(np.diff(first)) == [2, 1, 0, 2, 1]
    h = b.word_hashes(starts, ends)
    assert h[0] == h[2] and h[1] == h[3] == h[5] and h[4] not in h[:4]
    assert b.word_hashes(starts, ends, lower=True)[4] == h[0]
    g = gram_hashes(h, np.array([0, 2, 0]), np.array([2, 4, 1]))
    assert g[0] == g[1] != g[2]


# ---- quality
def test_quality_counts(docs):
    got = qu.judge_ids(docs).select("doc_id", "quality.*").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        want = quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)


def test_quality_unequal_windows_of_equal_fingerprints(spark, monkeypatch):
    """With fingerprints of one bit, neighbours differ, and the windows themselves decide."""
    texts = ["a b c x a b c", "a a a a a", "a b c d e f g", "q r s t u v w x q r s", "a b c d a b", " ".join(f"w{i % 50}" for i in range(300)), "x y z " * 3 + "k"]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    narrow = qu._repeat_words("shiftleft(1L, 62)")
    monkeypatch.setattr(qu, "_repeat_words", lambda: narrow)
    for r in qu.judge_ids(df).select("doc_id", "quality.n_repeat_words").collect():
        assert r.n_repeat_words == quality(texts[r.doc_id])[4], r


def test_quality_model(spark):
    """Posteriors equal those of plain expectation-maximisation."""
    n = len(qu.RULES)
    r = np.random.default_rng(1)
    votes = np.where(r.random((400, 1)) < 0.2, r.choice([-1, 0, 1], (400, n), p=[0.6, 0.2, 0.2]), r.choice([-1, 0, 1], (400, n), p=[0.02, 0.1, 0.88]))
    out = [[-1] * n] * 50 + [[1] * n] * 30  # rows that have no part in it
    df = spark.createDataFrame([([int(x) for x in v], True) for v in votes] + [(v, False) for v in out], "votes array<int>, counts boolean")
    got = {tuple(x.votes): x.posterior for x in qu.posteriors(df).collect()}
    prior, a, b = qu.START[0], np.full(n, qu.START[1]), np.full(n, qu.START[2])

    def post():
        s = np.log(prior / (1 - prior)) + np.where(votes == 1, np.log(a / (1 - b)), np.where(votes == -1, np.log((1 - a) / b), 0)).sum(axis=1)
        return 1 / (1 + np.exp(-s))

    for _ in range(qu.ROUNDS):
        p = post()[:, None]
        prior = (p.sum() + 1) / (len(votes) + 2)
        a = ((p * (votes == 1)).sum(0) + 1) / ((p * (votes != 0)).sum(0) + 2)
        b = (((1 - p) * (votes == -1)).sum(0) + 1) / (((1 - p) * (votes != 0)).sum(0) + 2)
    for v, p in zip(votes, post()):
        assert got[tuple(int(x) for x in v)] == pytest.approx(p, abs=1e-9)


def test_judge_keeps_columns(docs, none):
    docs = docs.withColumn("posterior", F.lit("p")).withColumn("votes", F.lit(0)).withColumn("held", F.lit(1)).withColumn("quality", F.lit("old"))
    docs = docs.select(*(c for c in docs.columns if c != "quality"))
    out = qu.judge(docs)
    ids = {str(r) for r in out.select("doc_id", "quality").collect()}
    assert ids == {str(r) for r in qu.judge_ids(docs).collect()}  # repeated rows get one verdict
    assert out.columns == [*docs.columns, "quality"] and out.count() == docs.count()
    assert qu.judge(none).count() == 0


# ---- chat
def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "a\\b", "<\\s>", "<<SYS>>x\ny<</SYS>>", "", "<", "[INST] hi [/INST]</s>", "\\", "<s>\\", "</\\s></s>", " [/INST]", "[", "é\n</s>"]
    rows = [(i, k, role, t) for i, t in enumerate(nasty) for k, role in enumerate(["user", "assistant", "tool\nx", "a\\nb", None])]
    rows += [(100, None, "user", None), (100, 0, "assistant", "z"), (None, 0, "system", "s"), (101, 0, "user", "same"), (101, 0, "user", "same")]
    rows += [(102, k, r, t) for k, (r, t) in enumerate([("assistant", "x"), ("assistant", "y"), ("user", "<s>")])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, turns int")
    got = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert all(r.identical for r in got.values())
    for i, t in enumerate(nasty):
        assert [(x.role, x.text) for x in got[i].turns] == [(r or "", t) for r in ["user", "assistant", "tool\nx", "a\\nb", None]]
    assert [(x.role, x.text) for x in got[100].turns] == [("user", ""), ("assistant", "z")]
    assert len(got[101].turns) == 2 and not got[101].escaped and got[0].escaped
    loss = chat.format_chats(df).select("conv_id", chat.loss_text(F.col("turns")).alias("x")).filter("conv_id = 102").first().x
    assert loss == "xy"
    assert chat.format_chats(df.limit(0)).count() == 0


# ---- mixing
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def test_chat_escapes_in_all_roles(spark):
    """No text of any role leaves a control string in the output; backslashes of any number come back."""
    texts = [f"a {c} b" for c in CONTROLS] + [f"{c[0]}{chr(92) * k}{c[1:]}" for c in CONTROLS for k in range(4)]
    texts += ["".join(CONTROLS), "<<s>>", "[[INST]]", "<", "[", "\\", "\\\\", "<\\", "x\\n", "a\nb", "<<\\SYS>>", "</", ""]
    roles = ["user", "assistant", "system", "tool", "", "a\nb", "x<s>\\n", "<</SYS>>"]
    rows = [(100 * i + j, k, r, t) for i, r in enumerate(roles) for j, t in enumerate(texts) for k in range(2)]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(roles) * len(texts)
    for g in got:
        role, text = roles[g.conv_id // 100], texts[g.conv_id % 100]
        assert g.identical and [tuple(t) for t in g.turns] == [(role, text)] * 2
        own = {"user": ["[INST]", "[/INST]"], "assistant": ["</s>"]}.get(role, ["<<SYS>>", "<</SYS>>"])
        for c in CONTROLS:
            assert g.formatted.count(c) == 2 * (c in own) + (c == "<s>"), g.formatted
        assert g.escaped == (any(c in text for c in CONTROLS) or any(c[0] + "\\" * k + c[1:] in x for x in (text, role) for c in CONTROLS for k in range(4)))


def test_targets(spark):
    for sizes in ({"a": 100, "b": 1000, None: 50}, {"a": 10, "b": 10, "c": 10, "d": 10_000, "é": 7, "Z": 0}, {"a": 5}, {"a": 0}, {f"s{i}": (i * 37) % 101 for i in range(40)}):
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = targets(sizes)
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def test_mix(docs, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 3)
    monkeypatch.setattr(mixing, "RANGES", 2)
    monkeypatch.setattr(mixing, "LEAST_BLOCK", 50)
    sized = docs.select("doc_id", "source", mixing._size().alias("size"))
    got = mixing.mix(sized).drop("row").collect()
    assert len(got) == docs.count() and sorted(map(str, got)) == sorted(map(str, mixing.mix(sized.repartition(2)).drop("row").collect()))
    texts = {(d.doc_id, d.source): len(split(d.text)) for d in docs.collect()}
    by, owners = {}, {}
    for r in got:
        assert r.size == texts[r.doc_id, r.source]
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(x.words for x in r.draws)
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
        for x in r.draws:
            assert owners.setdefault((r.source, x.block), x.shard) == x.shard  # a block lies in one shard
    assert all(taken == int(target) for target, taken in by.values())
    assert len(set(owners.values())) == 2**mixing.LEAST_LEVELS


def test_mix_comes_from_the_tree(docs, monkeypatch):
    """With a tree that gives one shard half of the blocks, the mix takes just those."""
    monkeypatch.setattr(mixing, "LEAST_BLOCK", 50)
    sized = docs.select("doc_id", "source", mixing._size().alias("size"))
    mixing_all = mixing.mix(sized).collect()
    whole = {str(r.asDict()) for r in mixing_all}

    def one(quotas, seed, levels, sources):
        return quotas.select(F.lit(5).cast("long").alias("shard"), F.transform("counts", lambda c: F.floor(c / 2)).alias("counts"), F.transform("counts", lambda c: F.lit(0).cast("long")).alias("starts"))

    monkeypatch.setattr(mixing, "splitting_tree", one)
    half = mixing.mix(sized).collect()
    assert {x.shard for r in half for x in r.draws} == {5} and whole != {str(r.asDict()) for r in half}
    assert sum(len(r.draws) for r in half) < 0.75 * sum(len(r.draws) for r in mixing_all)


def test_splitting_tree(spark):
    counts, levels = [1000, 3, 0, 500, 1, 77], 4
    got = mixing.splitting_tree(spark.createDataFrame([(counts,)], "counts array<bigint>"), 3, levels, 6).collect()
    assert len(got) == 2**levels and [sum(r.counts[i] for r in got) for i in range(6)] == counts
    totals = [sum(r.counts) for r in got]
    assert max(totals) - min(totals) <= levels
    assert max(r.counts[0] for r in got) < 90  # near 1000 / 16
    for i in range(6):  # ranges follow each other
        at = 0
        for r in sorted(got, key=lambda r: r.shard):
            assert r.starts[i] == at
            at += r.counts[i]


def test_splitting_tree_follows_the_law(spark):
    """Over many nodes, the left half's counts of three sources have the multivariate law."""
    from collections import Counter
    from math import comb

    seen = Counter()
    nodes = spark.range(600).select(F.col("id").alias("shard"), F.expr("array(4L, 3L, 3L, 0L)").alias("counts"), F.expr("array_repeat(0L, 4)").alias("starts"))
    for r in mixing._split(nodes, 1, 0, 2).collect():
        seen[tuple(r.left[:3])] += 1
    for (a, b, c), n in seen.items():
        assert a + b + c == 5
        want = 600 * comb(4, a) * comb(3, b) * comb(3, c) / comb(10, 5)
        assert abs(n - want) < 5 * want**0.5 + 3


def test_hypergeometric_law(spark):
    df = spark.range(20_000).select(((F.col("id") + 0.5) / 20_000).alias("u"))
    k = df.select(F.expr(mixing._draw("30L", "12L", "10L", "u")).alias("k")).groupBy("k").count().collect()
    from math import comb

    for r in k:
        assert r["count"] / 20_000 == pytest.approx(comb(12, r.k) * comb(18, 10 - r.k) / comb(30, 10), abs=1e-3)


def test_large_draws(spark):
    """Draws out of millions stay within the law's spread and cost no walk over all of it."""
    u = spark.range(200).select(((F.col("id") + 0.5) / 200).alias("u"))
    k = [r.k for r in u.select(F.expr(mixing._draw("4000000L", "1000000L", "2000000L", "u")).alias("k")).collect()]
    sd = (2e6 * 0.25 * 0.75 * 0.5) ** 0.5
    assert k == sorted(k) and abs(np.mean(k) - 500_000) < 5 and 0.9 * sd < np.std(k) < 1.1 * sd


def test_take(spark, docs, none, monkeypatch):
    monkeypatch.setattr(mixing, "LEAST_BLOCK", 50)
    docs = docs.withColumn("d", F.lit(1)).withColumn("draw", F.lit(2)).withColumn("shard", F.lit("s"))
    out = mixing.take(docs)
    assert out.columns == docs.columns
    rows = out.withColumn("__p", F.spark_partition_id()).collect()
    drawn = mixing.mix(docs.select("doc_id", "source", mixing._size().alias("size"))).collect()
    assert sorted((str(r.doc_id), r.source, len(split(r.text))) for r in rows) == sorted((str(r.doc_id), r.source, x.words) for r in drawn for x in r.draws)
    texts = {(d.doc_id, d.source): split(d.text) for d in docs.collect()}
    assert all(split(r.text) == texts[r.doc_id, r.source][: len(split(r.text))] for r in rows)
    once = {(r.doc_id, r.source): (r.draws[0].shard, r.draws[0].place) for r in drawn if len(r.draws) == 1}
    for p in {r["__p"] for r in rows}:  # each task's rows lie by shard and place
        at = [once[r.doc_id, r.source] for r in rows if r["__p"] == p and (r.doc_id, r.source) in once]
        assert at == sorted(at)
    assert len({x[0] for x in once.values()}) > 1
    assert mixing.take(none).count() == 0
    nulls = spark.createDataFrame([(None, None, None), (None, "a b c", None), (None, "a b c", None), (1, "", "s")], "doc_id long, text string, source string")
    assert sorted(r.text for r in mixing.take(nulls).collect()) == ["a b c"] * 3  # a share of 150 % is reached by the one source that has words


# ---- packing
def test_tokenizers_agree():
    from tokenizers import Tokenizer

    path = packing.vocabulary()
    t = Tokenizer.from_file(path)
    encode = packing.encoder(path)
    for text in ("<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>\n c", "<|endoftext| >", " <|endoftext|>", "", "Hello  world\n\n x", "éèß漢字   it's we'll 12345", "a" * 3000, "<|endoftext|> in text", "\x00\x1f ퟿"):
        assert list(encode(text)) == t.encode(text, add_special_tokens=False).ids


def test_pack(docs, none):
    got = packing.pack(docs).collect()
    want = []
    for r in docs.collect():
        ids = tokens(r.text, 2)
        # what full pieces leave comes first; only documents that are longer than a sequence are cut
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)]
        want += [(r.doc_id, i, s, e - s, crc32(ids[s:e])) for i, (s, e) in enumerate(zip(cuts, cuts[1:]))]
    low = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(low(tuple(r)[:5]) for r in got) == sorted(map(low, want))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(bins) <= -(-sum(r.length for r in got) // 1024) * 1.01 + 2
    assert packing.pack(none).count() == 0


def test_sum_of_squares_places_where_the_sum_is_least():
    r = np.random.default_rng(2)
    lengths = r.integers(1, 21, 200)
    bins, offsets = packing.sum_of_squares(lengths, 20)
    level, count = {}, {}
    for n, b, o in zip(lengths, bins, offsets):
        def total(gap_from, gap_to):
            c = dict(count)
            if gap_from < 20:
                c[gap_from] -= 1
            if gap_to:
                c[gap_to] = c.get(gap_to, 0) + 1
            return sum(v * v for v in c.values())

        used = 20 - level.get(b, 0)
        best = min([total(g, g - n) for g, c in count.items() if c and n <= g < 20], default=total(20, 20 - n))
        assert o == level.get(b, 0) and total(used, used - n) == best
        if used < 20:
            count[used] -= 1
        level[b] = level.get(b, 0) + n
        if used - n:
            count[used - n] = count.get(used - n, 0) + 1


# ---- personal data
def test_base_spans():
    import re

    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for text in ("a@b.c_d@e.f", "x@@y.z", "@a.b", "q@w", "p@q.r.s@t.u", "mail é.b@c-d.org, b", "a@b.c@d.e.f", "a+b%c@x.y z@z.z"):
        assert [s[1:] for s in pii.base_spans(text) if s[0] == "email"] == [m.span() for m in mail.finditer(text)], text
    assert pii.base_spans("at 256.1.1.1 and 1.2.3.4.5 or 12345.1.2.3") == [("ip", 17, 24)]
    assert pii.base_spans("4539 1488 0343 6467 x") == [("card", 0, 19)] and pii.base_spans("4539 1488 0343 6468") == []
    assert pii.base_spans("+1 (017) 555-7713, +1 23") == [("phone", 0, 17)]
    assert pii.base_spans("0" * 5000 + ".1.1.1") == [("ip", 0, 5006)]


def plain_spans(text):
    """The patterns as they are written down, one by one."""
    import re

    digits = lambda x: re.sub("[^0-9]", "", x)

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda x: 14 <= len(digits(x)) <= 19 and luhn(digits(x))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 10 <= len(digits(x)) <= 15),
    ]
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, good) in enumerate(rules) for m in re.finditer(p, text) if good(m[0])]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def test_base_spans_against_plain_patterns(spark):
    import random

    r = random.Random(1)
    parts = ["1.2.3.4", "256.0.0.1", "0.00.000.0255", "4539 1488 0343 6467", "4539148803436467", "4539-1488 0343-6468", "+1 (234) 555-7713", "+44.20", "+", "++33 1 23 45 67 89", "a.b@c.de", "@x.y", "é@q.r", "x@y", " ", "\n", "-", ".", "9", "00", "(", ")", "@", "w", "% +5"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 9)))
        assert pii.base_spans(text) == plain_spans(text), text
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    texts = {x.doc_id: x.text or "" for x in rows.collect()}
    got = pii.find(rows).collect()
    assert len(got) == len(texts) and any(x.n_email for x in got)
    for x in got:
        want = plain_spans(texts[x.doc_id])
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(s[0] == k for s in want) for k in ("email", "ip", "card", "phone")]
        assert x.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert set(pii.joined(want).split(",")) <= set(x.spans.split(",")) | {""}


def test_pii_adds_consistent_spans(spark):
    rows = [(i, f"call +1 (234) 555-{1000 + i} today or 234555{1000 + i} at night") for i in range(60)]
    rows += [(100, None), (101, ""), (102, "no data here"), (103, "x" * 100_000 + " +1 (234) 555-0000"), (104, "order 7 of 12"), (104, "order 7 of 12")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.find(df).collect()}
    assert len(got) == 65 and pii.find(df).count() == 66
    empty = hashlib.sha256(b"").hexdigest()
    for i in (100, 101, 102, 104):
        assert got[i].base_sha256 == empty and got[i].spans == ""
    for i, text in rows[:60]:
        base = pii.base_spans(text)
        assert got[i].n_phone == 1 and got[i].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        start = text.index("234555", 20)
        assert got[i].spans == f"{pii.joined(base)},phone:{start}:{start + 10}" and got[i].n_added == 1
    assert got[103].spans == "phone:100001:100018"
    assert pii.find(df.limit(0)).count() == 0


def test_skip_edges_carry_labels():
    """With potentials that know nothing of shapes, a repeat of a telephone number becomes one."""
    k = pii.OTHER + 1
    skip = np.ones((k, k))
    skip[3, 3] = 10_000
    field = pii.Field(np.zeros((pii.SHAPES, k)), np.ones((k, k)), skip)
    text = "+1 (234) 555-7713 then 2345557713 or 999"
    base = pii.base_spans(text)
    assert pii.more_spans(text, base, field) == [("phone", 23, 33)]
    blind = pii.Field(np.zeros((pii.SHAPES, k)), np.ones((k, k)), np.ones((k, k)))
    blind.skip[:] = 0  # without a skip potential a repeat is what its shape says: nothing
    assert pii.more_spans(text, base, blind) == []
    p = pii.beliefs(pii.Graph(text, base), field)
    assert np.allclose(p.sum(axis=1), 1)


def test_pii_adds_every_repeat(spark):
    """However often it occurs, in this document or others, a bare repeat of a telephone number is one."""
    rows = [(i, f"call +1 (234) 555-{1000 + i} today or 234555{1000 + i} at night") for i in range(60)]
    rows += [(100 + i, f"+44 20 7946 {1000 + i} and again {'; '.join(['020 7946 %d' % (1000 + i)] * 5)}; order 1234567890") for i in range(20)]
    rows += [(200, "card 4539 1488 0343 6467, later 4539  1488.0343 6467 twice"), (201, "to jo.p@mail.example or jo.p@localhost"), (202, "+1 (234) 555-9000 is not 12.2345559000 nor x2345559000 nor 92345559000 nor 8885559000")]
    rows += [(1000 + i, f"order {2000000000 + i} and {3000000000 + i}") for i in range(5000)]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)

    def added(i):
        return [(k, text[i][int(a) : int(b)]) for k, a, b in (x.split(":") for x in got[i].spans.split(",")) if (k, int(a), int(b)) not in pii.base_spans(text[i])]

    for i in range(60):
        assert added(i) == [("phone", f"234555{1000 + i}")] and got[i].n_added == 1
    for i in range(20):
        assert added(100 + i) == [("phone", f"020 7946 {1000 + i}")] * 5
    assert added(200) == [("card", "4539  1488.0343 6467")] and added(201) == [("email", "jo.p@localhost")] and added(202) == []
    assert all(got[1000 + i].n_added == 0 for i in range(5000))


# ---- languages
def test_forward_backward_against_enumeration():
    import itertools

    r = np.random.default_rng(0)
    emit, moves = r.normal(size=(2, 4, 3)), r.normal(size=(3, 3))
    mask = np.array([[True] * 4, [True, True, False, False]])
    emit[1, 2:] = 0
    p, pairs = langid.forward_backward(emit, mask, moves)
    want_pairs = np.zeros((3, 3))
    for c, n in ((0, 4), (1, 2)):
        total, marg, pair = 0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=n):
            w = np.exp(sum(emit[c, i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += w
            for i, y in enumerate(path):
                marg[i, y] += w
            for a, b in zip(path, path[1:]):
                pair[a, b] += w
        assert np.allclose(p[c, :n], marg / total)
        want_pairs += pair / total
    assert np.allclose(pairs, want_pairs)


def test_langid(spark):
    r = np.random.default_rng(4)
    roots = {"aa": ["kol", "mip", "tarn"], "bb": ["zeu", "quif", "oix"]}
    rows = []
    for i in range(300):
        lang = ["aa", "bb"][i % 2]
        rows.append((i, " ".join("".join(r.choice(roots[lang], 2)) for _ in range(30)), lang))
    rows += [(1000, None, "aa"), (1001, "", None), (1002, "123 ... !!", None), (1003, "kolmip zeuquif " * 20_000, None), (None, "koltarn", None), (1004, "kolmip", None), (1004, "kolmip", None)]
    df = spark.createDataFrame([(*x, 1.0) for x in rows], "doc_id long, text string, lang string, score double")
    got = langid.identify(df).collect()
    by = {x.doc_id: x for x in got}
    assert len(got) == len(rows)
    assert all(by[i].lang_pred == ["aa", "bb"][i % 2] for i in range(300))
    assert all(by[i].held_out == langid.is_held_out(i) for i in range(300)) and not by[None].held_out
    assert [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and by[None].lang_pred == "aa"
    assert all(0 <= x.score <= 1 for x in got) and 0.3 < by[1003].score < 0.7
    assert all(by[i].runs == [] for i in (1000, 1001, 1002)) and [tuple(x) for x in by[0].runs] == [("aa", 0, 30)]
    assert len(by[1003].runs) == 40_000 and [tuple(x) for x in by[1003].runs[:2]] == [("aa", 0, 1), ("bb", 1, 1)]
    assert {x.lang_pred for x in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_langid_held_out_accuracy(spark):
    """Held-out documents of the test data, and the words of pairs of them that are joined to code-switched texts."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit_on(docs)
    truth = {r.doc_id: r for r in docs.filter("lang is not null and text is not null").collect()}
    got = [r for r in langid.identify(docs, model).collect() if r.held_out and r.doc_id in truth and r.lang_pred != "und"]
    assert len(got) > 100 and np.mean([r.lang_pred == truth[r.doc_id].lang for r in got]) > 0.98
    held = [truth[r.doc_id] for r in got if len(split(truth[r.doc_id].text)) >= 60][:60]
    mixed, want = [], {}
    for i, (a, b) in enumerate(zip(held, held[1:])):
        x, y = split(a.text)[:40], split(b.text)[:40]
        mixed.append((i, " ".join(x + y), None))
        want[i] = [a.lang] * len(x) + [b.lang] * len(y)
    right = []
    for r in langid.identify(spark.createDataFrame(mixed, "doc_id long, text string, lang string"), model).collect():
        said = [x.lang for x in r.runs for _ in range(x.words)]
        assert len(said) == len(want[r.doc_id])
        right += [s == w for s, w in zip(said, want[r.doc_id])]
    assert np.mean(right) > 0.95


def test_langid_features_by_hand():
    """A word's score is the sum of its lexicon, affix and trigram weights, worked out one by one."""
    b = block("Abcd x", "12 été")
    words = langid.features(b)
    weights = np.random.default_rng(0).normal(size=(langid.TABLE, 2)).astype(np.float32)
    got = langid.scores(words, weights)[words.kind]
    for k, w in enumerate(["abcd", "x", "12", "été"]):
        raw = w.encode()
        own = block(w)
        want = np.zeros(2)
        if any(c.isalpha() for c in w):
            h = own.word_hashes(*own.words()[:2])
            keys = [(h, 1, 1.0)]
            fold = lambda part: np.array([functools.reduce(lambda x, c: x * 257 + c, part, 0)], np.uint64)
            for n in langid.AFFIXES:
                if len(raw) >= n:
                    keys += [(fold(raw[:n]), 32 + n, 0.5), (fold(raw[-n:]), 48 + n, 0.5)]
            grams = [raw[i : i + 3] for i in range(len(raw) - 2)]
            keys += [(fold(g), 4, 2 / len(grams)) for g in grams]
            for key, salt, weight in keys:
                want += weights[langid._places(key, salt)[0]] * weight
        assert np.allclose(got[k], want, atol=1e-5), w


def test_langid_bounds_the_languages(spark, monkeypatch):
    """Of a column with as many languages as rows only the most frequent ones are learned."""
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    rows = [(i, f"wort{i} und noch etwas mehr", "de" if i % 2 else "nl" if i % 4 else f"x{i:04d}") for i in range(400)]
    model = langid.fit_on(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    spare = min(x for i, _, x in rows if x.startswith("x") and not langid.is_held_out(i))
    assert model.languages == ["de", "nl", spare]


def test_langid_learns_rare_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "FIT_DOCS", 100)
    common = {"aa": "kolmip tarnkol miptarn", "bb": "zeuquif oixzeu quifoix"}
    rows = [(i, common[["aa", "bb"][i % 2]], ["aa", "bb"][i % 2]) for i in range(3000)]
    rows += [(5000 + i, "dvorgh ghyrdv yrghdvo", "cc") for i in range(4)] + [(6001, "ubbasu sussub abusba", "dd")] * 90
    assert not langid.is_held_out(6001) and not all(langid.is_held_out(5000 + i) for i in range(4))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_on(df)
    assert model.languages == ["aa", "bb", "cc", "dd"]
    got = {r.doc_id: r.lang_pred for r in langid.identify(df, model).collect()}
    assert all(got[i] == x for i, _, x in rows)


def test_langid_chain_spans_whole_texts():
    """Words are labelled as in one chain over the text, also next to the places where arrays are cut."""
    r = np.random.default_rng(2)
    k, sizes = 3, [1, 64, 65, 300, 0, 129, 1000]
    texts = [" ".join(r.choice(["kol", "mip", "7", "zeu", "quif", "42"], n)) for n in sizes]
    data = [t.encode() for t in texts]
    b = langid.Block(slice(0, len(data)), np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(x) for x in data])])
    model = langid.Model(["a", "b", "c"], r.normal(size=(langid.TABLE, k)).astype(np.float32), np.eye(k) * 4 + r.normal(size=(k, k)))
    words = langid.features(b)
    got, emit = langid._marginals(words, model), langid.scores(words, model.weights)[words.kind]
    assert len(got) == sum(sizes)
    for d, n in enumerate(sizes):
        if n:
            own = words.doc == d
            want = langid.forward_backward(emit[own][None].astype(float), np.ones((1, n), bool), model.moves)[0][0]
            assert np.allclose(got[own], want, atol=1e-6), n


def test_block_of_long_words_and_cut_parts(monkeypatch):
    """Hashes don't depend on where a long document is cut."""
    from tallyweld.llm import textkit

    text = "aa " + "b" * 500 + " c " * 300 + "aa"
    whole = block(text)
    starts, ends, _ = whole.words()
    want = whole.word_hashes(starts, ends)
    monkeypatch.setattr(textkit, "BLOCK_BYTES", 64)
    assert list(whole.word_hashes(starts, ends)) == list(want) and want[0] == want[-1]
