"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns' spans always stand. The field labels the other tokens that hold a digit or an `@`;
all other tokens are taken to be no entity. Neighbours in the text share a chain potential, and
distant repeats (of a whole number, however it is cut into tokens, or of a mail name) a skip
potential, so a number that is a telephone number in one place is one in another place of the
document, too. Loopy message passing, until the messages stand still, gives each one's probabilities.

Potentials are estimated piecewise from counts over all documents, with the patterns' spans as
labels: a token's shape (and whether its neighbours are candidates) against its label, neighbouring
labels, and labels of repeats. A repeat of a span that the patterns miss carries no label and is not
counted. Shapes and neighbours are bounded evidence, whatever the number of documents, and the skip
potential attracts by more than both together, so a repeat takes the label of what it repeats.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import bounded_batches

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
#: Least probability of an entity that adds a span.
CERTAIN = 0.9
#: Change of a log message at which passing ends, and rounds after which it ends anyhow.
STILL, MOST_ROUNDS = 1e-4, 1000
#: Digits that a number has at least to be a repeat.
KEY_DIGITS = 7
SHAPES = 1024
#: Share of the labels' probability that is even for any shape, and most that log potentials of neighbours say.
EVEN, MOST_CHAIN = 0.01, 3.0
#: Least gap in the skip potential between equal and other labels: 20.5 outweigh the bounds above at CERTAIN.
ATTRACT = 24.0

_MAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MAIL_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a run of digits either matches from its first digit or not at all
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_CANDIDATE = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_DIGITS = re.compile(r"[0-9]+")
_GAP = re.compile(r"[\x20().-]{1,3}")
#: Country codes of two digits; 1 and 7 have one, all others three.
_TWO = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_EDGE = " .,;:!?\"'()[]{}<>|"

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _mails(text: str) -> Iterator[tuple[int, int]]:
    """What `name@host` finds, leftmost and without overlap, in time linear in the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _MAIL_NAME:
            start -= 1
        host = _MAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            free = host.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by start and then kind."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _mails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _shape(token: str) -> int:
    """A token's own features as one number below 256; two more bits say whether its neighbours are candidates."""
    digits = _NOT_DIGIT.sub("", token)
    n = len(digits)
    size = sum(n >= x for x in (1, 4, 7, 10, 14, 20))
    letters = any(c.isalpha() for c in token)
    dots = token.strip(_EDGE).count(".") == 3
    check = 14 <= n <= 19 and luhn(digits)
    if "@" in token:
        size = 7
    return size | 8 * letters | 16 * dots | 32 * check | 64 * token.startswith("+") | 128 * ("-" in token)


def _mail_key(token: str) -> str | None:
    name = token.strip(_EDGE).split("@")[0].lower()
    return "@" + name if name else None


def _key(token: str) -> str | None:
    """What unlabelled repeats of a token have in common."""
    if "@" in token:
        return _mail_key(token)
    digits = _NOT_DIGIT.sub("", token)
    return digits if len(digits) >= KEY_DIGITS else None


def _keys(kind: str, text: str) -> list[str]:
    """The forms in which a pattern's span can be repeated; the first is its own."""
    if kind == "email":
        return [_mail_key(text)]
    if kind == "ip":
        return [text]
    digits = _NOT_DIGIT.sub("", text)
    if kind == "card":
        return [digits]
    size = 1 if digits[0] in "17" else 2 if digits[:2] in _TWO else 3
    code, rest = digits[:size], digits[size:].lstrip("0")
    forms = [digits, code + rest, code + "0" + rest, "00" + code + rest, rest, "0" + rest]
    forms += [rest[-7:]] if code == "1" and len(rest) == 10 else []  # without the area
    return [x for x in dict.fromkeys(forms) if len(x) >= KEY_DIGITS]


def _repeats(text: str, base: list[Span], keys: set[str]) -> list[tuple[int, int, str]]:
    """Whole numbers outside the base spans that are one of keys, cut by spaces, dots, hyphens or brackets or not at all."""
    longest = max((len(_NOT_DIGIT.sub("", k)) for k in keys if k[0] != "@"), default=0)
    if not longest:
        return []
    out: list[tuple[int, int, str]] = []
    runs, i, at, taken = [m.span() for m in _DIGITS.finditer(text)], 0, 0, 0

    def ends(near: str, far: str) -> bool:
        return not (near.isalnum() or near in (".", "-") and far.isdigit())

    while i < len(runs):
        a, b = runs[i]
        while at < len(base) and base[at][1] < b:
            taken = max(taken, base[at][2])
            at += 1
        found = None
        if a >= taken and ends(text[a - 1 : a], text[max(a - 2, 0) : max(a - 1, 0)]):
            stop = base[at][1] if at < len(base) else len(text)
            digits = dotted = ""
            for j in range(i, len(runs)):
                c, d = runs[j]
                if d > stop or len(digits) + d - c > longest or j > i and not _GAP.fullmatch(text, runs[j - 1][1], c):
                    break
                digits, dotted = digits + text[c:d], dotted + "." * (j > i) + text[c:d]
                key = digits if digits in keys else dotted if dotted in keys else None
                if key and ends(text[d : d + 1], text[d + 1 : d + 2]):
                    found = (j, d, key)
        if found:
            j, d, key = found
            out.append((a - (text[a - 1 : a] == "(" and ")" in text[a:d]), d, key))
            i = j
        i += 1
    return out


class Graph:
    """The candidates of one text (base spans, repeats of their numbers, other tokens) with their chain and skip edges."""

    def __init__(self, text: str, base: list[Span]):
        self.spans, self.shapes, self.labels = [], [], []
        self.free: list[bool] = []  # repeats of base spans that have no label
        self.exact: list[bool] = []  # spans that are no tokens
        self.chain, self.skip = [], []
        alone, end = [], 0
        for kind, a, b in base:
            if a >= end:
                alone.append((kind, a, b, _keys(kind, text[a:b])))
            end = max(end, b)
        marks = [(a, b, KINDS.index(kind), keys) for kind, a, b, keys in alone]
        known = {k for *_, keys in alone for k in keys}
        marks += [(a, b, OTHER, [key]) for a, b, key in _repeats(text, base, known)]
        marks.sort()
        i, last = 0, -2
        owners: dict[str, dict[int, int]] = {}  # the first node of each label, by key
        before: dict[str, int] = {}
        wait: list[tuple[int, str]] = []

        def add(a: int, b: int, label: int, number: int, exact: bool) -> int:
            node = len(self.spans)
            self.spans.append((a, b))
            self.shapes.append(_shape(text[a:b]))
            self.labels.append(label)
            self.free.append(False)
            self.exact.append(exact)
            if number <= last + 1:
                self.chain.append((node - 1, node))
                self.shapes[node - 1] |= 256
                self.shapes[node] |= 512
            return node

        for number, m in enumerate(_TOKEN.finditer(text)):
            token = m[0]
            if not _CANDIDATE.search(token):
                continue
            a, b = m.span()
            covered = i > 0 and marks[i - 1][1] > a
            while i < len(marks) and marks[i][0] < b:
                start, stop, label, keys = marks[i]
                covered = True
                node = add(start, stop, label, number, True)
                last = number
                i += 1
                if label == OTHER:
                    wait.append((node, keys[0]))
                    continue
                if keys[0] in before:
                    self.skip.append((before[keys[0]], node))  # to the repeat before: a chain of skips
                before[keys[0]] = node
                for key in keys:
                    owners.setdefault(key, {}).setdefault(label, node)
            if covered:
                last = number
                continue
            node = add(a, b, OTHER, number, False)
            last = number
            key = _key(token)
            if key in known:
                wait += [(node, key)] if "@" in token else []  # _repeats has the numbers
            elif key is not None:
                if key in before:
                    self.skip.append((before[key], node))
                before[key] = node
        for node, key in wait:  # to what has a label, so that other repeats don't weigh against it
            self.free[node] = True
            self.skip += [(owner, node) for owner in owners[key].values()]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (shape, label), (label, next label) and (label, label of the repeat), without nodes that have no label."""
    k = OTHER + 1
    unary, chain, skip = np.zeros((SHAPES, k), np.int64), np.zeros((k, k), np.int64), np.zeros((k, k), np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            g = Graph(text, base_spans(text))
            seen = [i for i, free in enumerate(g.free) if not free]
            np.add.at(unary, ([g.shapes[i] for i in seen], [g.labels[i] for i in seen]), 1)
            for edges, into in ((g.chain, chain), (g.skip, skip)):
                for a, b in edges:
                    if not (g.free[a] or g.free[b]):
                        into[g.labels[a], g.labels[b]] += 1
    for part, table in enumerate((unary, chain, skip)):
        at = np.flatnonzero(table)
        yield pa.record_batch({"part": np.full(len(at), part), "at": at, "n": table.ravel()[at]})


class Field:
    """Log potentials."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        smooth = unary + np.where(np.arange(unary.shape[1]) == OTHER, 2.0, 0.1)  # an unknown shape is no entity
        self.unary = np.log((1 - EVEN) * smooth / smooth.sum(axis=1, keepdims=True) + EVEN / unary.shape[1])
        self.chain, self.skip = np.clip(self._pair(chain), -MOST_CHAIN, MOST_CHAIN), self._pair(skip)
        others = np.where(np.eye(len(skip), dtype=bool), -np.inf, self.skip)
        np.fill_diagonal(self.skip, np.maximum(np.diag(self.skip), others.max(axis=1) + ATTRACT))

    @staticmethod
    def _pair(counts: np.ndarray) -> np.ndarray:
        """Pointwise mutual information, so that pairs without evidence change nothing."""
        both = counts + counts.T + 1.0
        total, one = both.sum(), both.sum(axis=1)
        return np.log(both * total / np.outer(one, one))


def fit_on(docs: DataFrame, text_col: str = "text") -> Field:
    """Counts over all rows; what comes to the driver is bounded by SHAPES * labels."""
    rows = docs.select(F.col(text_col).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    found = rows.mapInArrow(_counts, "part long, at long, n long").groupBy("part", "at").agg(F.sum("n").alias("n")).collect()
    k = OTHER + 1
    tables = [np.zeros(SHAPES * k), np.zeros(k * k), np.zeros(k * k)]
    for r in found:
        tables[r["part"]][r["at"]] = r["n"]
    return Field(tables[0].reshape(SHAPES, k), tables[1].reshape(k, k), tables[2].reshape(k, k))


def beliefs(g: Graph, field: Field) -> np.ndarray:
    """Each node's probabilities after loopy sum-product message passing."""
    n, k = len(g.spans), OTHER + 1
    labels = np.array(g.labels)
    phi = field.unary[g.shapes]
    known = labels != OTHER
    phi[known] = -100.0
    phi[known, labels[known]] = 0
    edges = np.array([*g.chain, *g.skip], np.int64).reshape(-1, 2)
    pair = np.concatenate([np.broadcast_to(np.exp(field.chain), (len(g.chain), k, k)), np.broadcast_to(np.exp(field.skip), (len(g.skip), k, k))])
    source, target = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
    messages = np.full((len(source), k), -np.log(k))  # logs
    for _ in range(MOST_ROUNDS if len(source) else 0):
        into = np.zeros((n, k))
        np.add.at(into, target, messages)
        out = phi[source] + into[source] - messages[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.einsum("ei,eij->ej", out, pair)
        change = 0.5 * (np.log(new / new.sum(axis=1, keepdims=True)) - messages)
        messages += change
        if np.abs(change).max() < STILL:
            break
    into = np.zeros((n, k))
    np.add.at(into, target, messages)
    belief = phi + into
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def more_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Spans that the field adds; each lies outside the base spans."""
    g = Graph(text, base)
    if all(x != OTHER for x in g.labels):
        return []
    p = beliefs(g, field)
    out: list[Span] = []
    for i, (a, b) in enumerate(g.spans):
        best = int(p[i].argmax())
        if g.labels[i] != OTHER or best == OTHER or p[i, best] < CERTAIN:
            continue
        if g.exact[i]:
            out.append((KINDS[best], a, b))
            continue
        token = text[a:b]
        a, b = a + len(token) - len(token.lstrip(_EDGE)), b - len(token) + len(token.rstrip(_EDGE))
        if out and not g.free[i] and not g.free[i - 1] and out[-1][0] == KINDS[best] and text[out[-1][2] : a].strip(" ") == "" and i and g.spans[i - 1][0] <= out[-1][1]:
            out[-1] = (KINDS[best], out[-1][1], b)
        elif a < b:
            out.append((KINDS[best], a, b))
    return out


_OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _find(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0)
        for batch in batches:
            rows = []
            for text, asked in zip(batch.column("text"), batch.column("asked").to_pylist(), strict=True):
                if not asked:
                    rows.append(nothing)
                    continue
                text = text.as_py()
                base = base_spans(text)
                added = more_spans(text, base, field)
                both = sorted({*base, *added}, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
                rows.append((*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(both), len(both) - len(base)))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["doc_id", *names])

    return run


def find(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, base counts by kind, base_sha256, spans, n_added.

    spans lists kind:start:end (code points, end exclusive) of base and added spans by start, then
    kind. A null text counts as empty: no spans, the digest of nothing. Texts without a digit or
    `@` have no candidates. Repeated rows get equal results. Other columns are not read, whatever their
    names. A very long text is one graph, whose cost grows with its candidates (some 10 s for 100,000 equal numbers);
    messages that still move after MOST_ROUNDS rounds are taken as they are. No rows in, no rows out.
    """
    bounded_batches(docs.sparkSession)
    field = field or fit_on(docs, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    asked = text.rlike("[0-9@]")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.when(asked, text).otherwise("").alias("text"), asked.alias("asked"))
    return base.mapInArrow(_find(field), _OUT)


def op3_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
