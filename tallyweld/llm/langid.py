"""Language identification by a linear-chain conditional random field over words.

A word's score for each language sums learned weights of its affixes, its byte trigrams and the
word itself (the lexicon); learned transitions say how likely languages follow each other. The
forward-backward pass gives each word's probabilities, so code-switched texts are labelled word by
word; a document's language is the one with the largest share.

The model is fitted on the driver on a bounded sample of labelled rows (FIT_DOCS windows of
FIT_CHARS characters, at places given by a hash, and more of each rare language until it has
LEAST_DOCS or all its rows) that are not held out; the MOST_LANGUAGES most frequent languages of those rows are
learned, of equally frequent ones the first by code point. Half of the training sequences join pieces of two documents, from which the transitions learn switches.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import bounded_batches
from .textkit import U64, Block, blocks, mix, ranges

#: Bound of the fitting sample: documents, and characters of each.
FIT_DOCS, FIT_CHARS = 3000, 800
#: Documents of a language that the sample has at least, if there are as many, and languages that it has at most: it
#: holds FIT_DOCS + MOST_LANGUAGES * LEAST_DOCS documents at most, however dirty the column of languages is.
LEAST_DOCS, MOST_LANGUAGES = 50, 200
#: Rows of the weight table (a power of two), rounds and step of the fit, words of a chain.
TABLE, ROUNDS, STEP, CHAIN = 1 << 16, 6, 0.5, 64
FOLDS = 5
AFFIXES = (1, 2, 3, 4)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # TABLE x languages
    moves: np.ndarray  # log potentials of (from, to)


@dataclass
class Words:
    """The words of a block: chain layout and features of the distinct ones."""

    kind: np.ndarray  # number of the distinct word, by word
    doc: np.ndarray
    lettered: np.ndarray  # by distinct word
    feature: np.ndarray  # places in the weight table
    value: np.ndarray
    begin: np.ndarray  # of each distinct word's features


def _places(key: np.ndarray, salt: int) -> np.ndarray:
    return (mix(key ^ U64(salt * 0x9E3779B97F4A7C15 % (1 << 64))) & U64(TABLE - 1)).astype(np.int64)


def features(block: Block) -> Words:
    starts, ends, first = block.words()
    hashes = block.word_hashes(starts, ends, lower=True)
    _, at, kind = np.unique(hashes, return_index=True, return_inverse=True)
    s, size = starts[at], (ends - starts)[at]
    data = np.r_[_FOLD[block.data], np.zeros(4, np.uint8)].astype(np.uint64)
    owner, place, value = [], [], []

    def add(who, key, salt, weight):
        owner.append(who)
        place.append(_places(key, salt))
        value.append(np.broadcast_to(weight, len(who)).astype(np.float32))

    everyone = np.arange(len(s))
    add(everyone, hashes[at], 1, 1.0)
    for n in AFFIXES:
        who = np.flatnonzero(size >= n)
        for salt, base in ((2, s[who]), (3, s[who] + size[who] - n)):
            key = np.zeros(len(who), np.uint64)
            for i in range(n):
                key = key * U64(257) + data[base + i]
            add(who, key, salt * 16 + n, 0.5)
    grams = np.maximum(size - 2, 0)
    j = ranges(s, grams)
    add(np.repeat(everyone, grams), data[j] * U64(66049) + data[j + 1] * U64(257) + data[j + 2], 4, np.repeat(1.0 / np.maximum(grams, 1), grams) * 2)
    owner, place, value = np.concatenate(owner), np.concatenate(place), np.concatenate(value)
    order = np.argsort(owner, kind="stable")
    lettered = np.zeros(len(s), bool)
    has = np.r_[0, np.cumsum(_LETTER[block.data])]
    lettered[:] = has[s + size] > has[s]
    value *= lettered[owner]
    return Words(kind, np.repeat(np.arange(len(first) - 1), np.diff(first)), lettered, place[order], value[order], np.searchsorted(owner[order], everyone))


def scores(words: Words, weights: np.ndarray) -> np.ndarray:
    """Scores of each distinct word by language."""
    if not len(words.begin):
        return np.zeros((0, weights.shape[1]), np.float32)
    return np.add.reduceat(weights[words.feature] * words.value[:, None], words.begin, axis=0)


def chains(words: Words) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Where each word stands: chain and position; chains end with their document or at CHAIN words (messages() joins them)."""
    n = len(words.doc)
    if not n:
        return words.doc, words.doc, 0, 0
    begin = np.r_[0, np.flatnonzero(np.diff(words.doc)) + 1]
    inside = np.arange(n) - np.repeat(begin, np.diff(np.r_[begin, n]))
    chain = np.cumsum(inside % CHAIN == 0) - 1
    pos = inside % CHAIN
    return chain, pos, int(chain[-1]) + 1, int(pos.max()) + 1


def forward_backward(emit: np.ndarray, mask: np.ndarray, moves: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each position (chains x positions x languages), and expected moves.

    emit are log scores; positions outside mask carry no evidence and come after a chain's words.
    before and after are the messages that reach a chain's first and last word from outside.
    """
    n, t, k = emit.shape
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    m = np.exp(moves)
    alpha = np.empty_like(e)
    first = e[:, 0] if before is None else e[:, 0] * before
    alpha[:, 0] = first / first.sum(axis=1, keepdims=True)
    for i in range(1, t):
        a = (alpha[:, i - 1] @ m) * e[:, i]
        alpha[:, i] = a / a.sum(axis=1, keepdims=True)
    beta = np.ones((n, k)) if after is None else after
    both, pairs = np.empty_like(e), np.zeros((k, k))
    last = alpha[:, t - 1] * beta
    both[:, t - 1] = last / last.sum(axis=1, keepdims=True)
    for i in range(t - 2, -1, -1):
        right = e[:, i + 1] * beta
        back = np.where(mask[:, i + 1, None], right @ m.T, beta)
        joint = alpha[:, i].T @ (right * (mask[:, i + 1] / np.maximum((alpha[:, i] * (right @ m.T)).sum(axis=1), 1e-300))[:, None])
        pairs += joint * m
        beta = back / back.sum(axis=1, keepdims=True)
        b = alpha[:, i] * beta
        both[:, i] = b / b.sum(axis=1, keepdims=True)
    return both, pairs


def messages(emit: np.ndarray, mask: np.ndarray, moves: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What reaches each chain's first and last word from the other chains of its document.

    doc tells each chain's document; a document's chains follow each other. A chain takes part by
    the product of its factors, languages x languages, so all products are made side by side and
    one walk over a document's chains joins them.
    """
    n, t, k = emit.shape
    before, after = np.ones((n, k)), np.ones((n, k))
    number = np.arange(n) - np.searchsorted(doc, doc)
    some = np.flatnonzero(np.bincount(doc)[doc] > 1)
    if not len(some):
        return before, after
    e, m = np.exp(emit[some] - emit[some].max(axis=2, keepdims=True)), np.exp(moves)
    product = np.eye(k) * e[:, 0, None, :]
    for i in range(1, t):
        product = np.where(mask[some, i, None, None], (product @ m) * e[:, i, None, :], product)
        product /= product.sum(axis=(1, 2), keepdims=True)
    at = np.zeros(n, np.int64)
    at[some] = np.arange(len(some))
    for i in range(1, int(number.max()) + 1):
        to = np.flatnonzero(number == i)
        x = (before[to - 1, None, :] @ product[at[to - 1]])[:, 0] @ m
        before[to] = x / x.sum(axis=1, keepdims=True)
    for i in range(int(number.max()), 0, -1):
        of = np.flatnonzero(number == i)
        x = (product[at[of]] @ after[of, :, None])[:, :, 0] @ m.T
        after[of - 1] = x / x.sum(axis=1, keepdims=True)
    return before, after


def _marginals(words: Words, model: Model) -> np.ndarray:
    """Probabilities of each word by language, in the chain of all words of its document."""
    chain, pos, n, t = chains(words)
    k = len(model.languages)
    if not n:
        return np.zeros((0, k))
    emit, mask = np.zeros((n, t, k)), np.zeros((n, t), bool)
    emit[chain, pos] = scores(words, model.weights)[words.kind]
    mask[chain, pos] = True
    doc = words.doc[np.flatnonzero(pos == 0)]
    return forward_backward(emit, mask, model.moves, *messages(emit, mask, model.moves, doc))[0][chain, pos]


def fit(samples: list[tuple[str, str]], languages: list[str]) -> Model:
    """A model from (text, language) pairs, by steps of Adagrad on the conditional likelihood."""
    rng = np.random.default_rng(5)
    k = len(languages)
    weights, moves = np.zeros((TABLE, k), np.float32), np.eye(k)
    sum_w, sum_m = np.full((TABLE, k), 1e-3, np.float32), np.full((k, k), 1e-3)
    pieces = [(t.encode(), languages.index(x)) for t, x in samples]
    for _ in range(ROUNDS):
        order = rng.permutation(len(pieces))
        for batch in np.array_split(order, max(1, len(order) // 256)):
            texts, cut = [], []
            for i, j in enumerate(batch):
                text, label = pieces[j]
                other, switch = pieces[batch[i - 1]]
                half = len(text) // 2 if i % 2 else len(text)
                texts.append(text[:half] + b" " + (other[len(other) // 2 :] if i % 2 else b""))
                cut.append((half, label, switch))
            offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
            block = Block(slice(0, len(texts)), np.frombuffer(b"".join(texts), np.uint8), offsets)
            starts = block.words()[0]
            words = features(block)
            chain, pos, n, t = chains(words)
            if not n:
                continue
            cuts = np.array(cut)
            gold = np.where(starts - offsets[words.doc] < cuts[words.doc, 0], cuts[words.doc, 1], cuts[words.doc, 2])
            emit, mask, want = np.zeros((n, t, k)), np.zeros((n, t), bool), np.zeros((n, t), np.int64)
            emit[chain, pos], mask[chain, pos], want[chain, pos] = scores(words, weights)[words.kind], True, gold
            both, pairs = forward_backward(emit, mask, moves)
            error = np.zeros((len(gold), k))
            error[np.arange(len(gold)), gold] = 1
            error -= both[chain, pos]
            by_kind = np.stack([np.bincount(words.kind, error[:, c], len(words.begin)) for c in range(k)], axis=1)
            owner = np.repeat(np.arange(len(words.begin)), np.diff(np.r_[words.begin, len(words.feature)]))
            grad = np.stack([np.bincount(words.feature, by_kind[owner, c] * words.value, TABLE) for c in range(k)], axis=1).astype(np.float32) / len(batch)
            sum_w += grad * grad
            weights += STEP * grad / np.sqrt(sum_w)
            seen = np.zeros((k, k))
            np.add.at(seen, (want[:, :-1][mask[:, 1:]], want[:, 1:][mask[:, 1:]]), 1)
            step = (seen - pairs) / len(batch) - 1e-3 * moves
            sum_m += step * step
            moves += STEP * step / np.sqrt(sum_m)
    return Model(languages, weights, moves)


def fit_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """fit() on the bounded sample of the labelled rows that are not held out."""
    room = F.greatest(F.length(text_col) - FIT_CHARS, F.lit(0)) + 1
    at = F.pmod(F.xxhash64(F.lit("place"), id_col), room).cast("int") + 1
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~_held_out(id_col))
    counts = {r["l"]: r["count"] for r in rows.groupBy(F.col(lang_col).alias("l")).count().orderBy(F.desc("count"), "l").limit(MOST_LANGUAGES).collect()}
    rows = rows.filter(F.col(lang_col).isin(list(counts)))
    # a share of the hashes that holds about FIT_DOCS rows, and larger ones for rare languages: no task sends more than its part to the driver
    share = min(1.0, 1.2 * FIT_DOCS / max(1, sum(counts.values())))
    below = {x: int(min(1.0, 1.5 * LEAST_DOCS / n) * (1 << 32)) for x, n in counts.items() if 1.5 * LEAST_DOCS > share * n}
    limit = F.lit(int(share * (1 << 32)))
    if below:
        limit = F.greatest(limit, F.coalesce(F.create_map(*(F.lit(v) for x in sorted(below.items()) for v in x))[F.col(lang_col)], limit))
    h = F.xxhash64(F.lit("pick"), id_col, text_col)
    rows = rows.select(F.substring(F.col(text_col), at, F.lit(FIT_CHARS)).alias("t"), F.col(lang_col).alias("l"), h.alias("h"), F.pmod(h, F.lit(1 << 32)).alias("r"), limit.alias("limit"))
    # rows of equal id and text share a hash, so one of them stands for all
    found = sorted(rows.filter("r < limit").distinct().collect(), key=lambda r: (r.h, r.t, r.l))
    common = [r.r < int(share * (1 << 32)) for r in found]
    picked = [r for r, x in zip(found, common, strict=True) if x]
    rest = picked[FIT_DOCS:] + [r for r, x in zip(found, common, strict=True) if not x]
    picked = picked[:FIT_DOCS]
    have = Counter(r.l for r in picked)
    for r in rest:
        if have[r.l] < LEAST_DOCS:
            have[r.l] += 1
            picked.append(r)
    if missed := sorted(set(counts) - set(have)):
        picked += sorted((r.one for r in rows.filter(F.col("l").isin(missed)).groupBy("l").agg(F.min(F.struct("h", "t", "l")).alias("one")).collect()), key=lambda r: r.l)
    return fit([(r.t, r.l) for r in picked], sorted(counts))


def _held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.languages)
        names = np.array([*model.languages, "und"], dtype=object)
        for batch in batches:
            has_letter = batch.column("lettered").to_numpy(zero_copy_only=False)
            for block in blocks(batch):
                words = features(block)
                n = len(block.offsets) - 1
                share, labels = np.zeros((n, k)), np.zeros(len(words.kind), np.int64)
                if k and len(words.kind):
                    p = _marginals(words, model)
                    labels = p.argmax(axis=1)
                    p *= words.lettered[words.kind][:, None]
                    share = np.stack([np.bincount(words.doc, p[:, c], n) for c in range(k)], axis=1)
                total = share.sum(axis=1)
                known = has_letter[block.rows] & (total > 0)
                best = np.where(known, share.argmax(axis=1) if k else 0, k)
                score = np.where(known, share.max(axis=1, initial=0) / np.where(known, total, 1), 0.0)
                said = np.flatnonzero(known[words.doc])
                doc, label = words.doc[said], labels[said]
                new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])]) if len(said) else said
                begin = np.searchsorted(doc[new], np.arange(n + 1))
                start = said[new] - np.searchsorted(words.doc, doc[new])
                runs = pa.StructArray.from_arrays([pa.array(names[label[new]], pa.string()), pa.array(start, pa.int64()), pa.array(np.diff(np.r_[new, len(said)]), pa.int64())], names=["lang", "start", "words"])
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(block.rows.start, n), "held_out": batch.column("held_out").slice(block.rows.start, n), "lang_pred": pa.array(names[best], pa.string()), "score": np.clip(score, 0, 1),
                    "runs": pa.ListArray.from_arrays(pa.array(begin, pa.int32()), runs),
                })

    return run


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, runs.

    runs lists the labels of the words: stretches of one language (lang, start, words; in words from
    0). score is the mean probability of the language over the words that have letters. A null text,
    or one without a letter, is `und` with score 0 and no runs; so is every text when no row carries
    a language to learn from. Of languages with equal shares the first by code point is said. A very
    long text is one chain, worked on whole. A null id is not held out. Repeated rows get equal
    results. Other columns are not read. No rows in, no rows out.
    """
    bounded_batches(docs.sparkSession)
    model = model or fit_on(docs, id_col, text_col, lang_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), _held_out(id_col).alias("held_out"), text.rlike(r"\p{L}").alias("lettered"))
    return base.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double, runs array<struct<lang:string,start:long,words:long>>")


def is_held_out(doc_id: int) -> bool:
    """The fold rule in Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the four folds that are not held out, and of its words as lang:start:words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    runs = F.array_join(F.transform("runs", lambda x: F.concat_ws(":", x["lang"], x["start"], x["words"])), ",")
    return identify(docs).withColumn("score", F.round("score", 6)).withColumn("runs", runs)
