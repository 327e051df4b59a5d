"""Fill-in-middle against plain Python."""

import hashlib
import re

import pytest

from tallyweld.llm import infill


def plain(doc_id, text, seed=1):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("chunk", [1, 3, 64, infill.CHUNK])
def test_fill_in_middle(docs, chunk):
    """Nulls, empty, very long and repeated texts, and clashing columns, at chunks that cut inside tokens."""
    small = docs if chunk > 3 else docs.filter("length(text) < 3000 or text is null")
    got = [tuple(r) for r in infill.fill_in_middle(small, chunk=chunk).collect()]
    want = [plain(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


TEXTS = ["a", "<", "<P>", "x <M> y", "ab<S", "<<<<", "<S<P<M>", "éa bé", "😀ab😀 c\r\n\td", "<Pa<Sb<Mc", "P>S>M>", " " * 50, "a" * 5000, "x\x00y", "naïve œuf"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_restored(spark, seed):
    """Texts with parts of marks come back from output and form alone."""
    rows = [(100 * i + j, t) for i, t in enumerate(TEXTS) for j in range(20)]
    made = infill.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), seed=seed, chunk=4)
    back = {r.doc_id: r.back for r in made.select("doc_id", infill.restored(made["output"], made["form"]).alias("back")).collect()}
    assert back == dict(rows)
    assert {tuple(r) for r in made.collect()} == {plain(i, t, seed) for i, t in rows}
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}


def test_no_rows_and_no_shuffle(spark, none, docs):
    assert infill.fill_in_middle(none).collect() == []
    plan = infill.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange hash|Python|Arrow", plan)
