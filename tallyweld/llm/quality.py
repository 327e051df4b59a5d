"""Quality rules as weak supervision, in DataFrame and SQL functions only.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the counts of
vote patterns (at most 3**len(RULES), whatever the input) estimates how often each rule is right
on good and on bad documents; a document is kept when its posterior of being good is at least
one half and it passes the fixed base rules. Documents that fail those need no estimate and have no
part in it. Nothing holds the estimates but one imagined vote of either kind for each; which class
is the good one follows from where they start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .store import materialize
from .textkit import words_sql

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Frequent function words of the four languages.
FUNCTION_WORDS = ["the", "of", "and", "to", "in", "is", "that", "for", "le", "la", "de", "et", "les", "des", "que", "un", "der", "die", "das", "und", "zu", "den", "ein", "mit", "el", "los", "en", "que", "y", "se", "por", "una"]
#: name -> (condition of a good vote, condition of a bad vote). Bad votes take the thresholds of
#: published web-text filters (50 words, a symbol for ten words, 30 % repeated lines, 18 % of words
#: in repeated runs, words of 3 to 10 characters, no function word, mostly capitals); good votes ask
#: for half of what is tolerated. No labels were looked at for them.
RULES = {
    "length": ("n_words >= 100", "n_words < 50"),
    "symbols": ("20 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    "lines": ("100 * n_dup_lines <= 15 * n_lines", "100 * n_dup_lines > 30 * n_lines"),
    "repeats": ("100 * n_repeat_words <= 9 * n_words", "100 * n_repeat_words > 18 * n_words"),
    "word_length": ("word_chars >= 3 * n_words AND word_chars <= 10 * n_words", "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    "capitals": ("4 * n_capitals <= word_chars", "2 * n_capitals > word_chars"),
    "function_words": ("n_function_words >= 2", "n_function_words = 0"),
}
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
ROUNDS = 12
#: Where estimation starts: share of good documents, and how often a rule is right on good and on bad ones.
START = (0.8, 0.9, 0.6)

_SIGNALS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_function_words")


def _covered(places: str) -> str:
    """Words under three-word windows at the sorted places."""
    return f"""aggregate({places}, struct(-3L AS last, 0L AS n), (s, p) -> struct(p AS last, s.n + least(3L, p - s.last) AS n), s -> s.n)"""


def _repeat_words(bits: str = "~mask") -> Column:
    """Words in three-word windows that occur twice or more; needs columns words, n_words and mask.

    Windows are sorted by a long that holds part of a fingerprint and the window's place (mask). Where
    all neighbours of equal fingerprints are equal word by word, they are the repeats; where any two
    are not, the windows themselves are sorted instead. bits are those of the fingerprint that are
    used (tests take fewer).
    """
    let = lambda name, value, then: f"transform(array({value}), {name} -> {then})[0]"  # noqa: E731 (each inner array is made once per document)
    hashes = "transform(words, w -> xxhash64(w))"
    packed = let("h", hashes, f"sort_array(transform(sequence(0, n_words - 3), i -> xxhash64(get(h, i), get(h, i + 1), get(h, i + 2)) & {bits} | i))")
    twins = "filter(s, (v, k) -> v & ~mask = get(s, k + 1) & ~mask OR v & ~mask = get(s, k - 1) & ~mask)".replace("get(s, k + 1) & ~mask", "coalesce(get(s, k + 1) & ~mask, ~(v & ~mask))").replace("get(s, k - 1) & ~mask", "coalesce(get(s, k - 1) & ~mask, ~(v & ~mask))")
    word = lambda v, i: f"get(words, cast({v} & mask AS int) + {i})"
    unequal = "exists(sequence(1, size(t) - 1), k -> t[k] & ~mask = t[k - 1] & ~mask AND NOT (" + " AND ".join(f"{word('t[k]', i)} = {word('t[k - 1]', i)}" for i in range(3)) + "))"
    exact = "sort_array(transform(sequence(0, n_words - 3), i -> struct(get(words, i) AS a, get(words, i + 1) AS b, get(words, i + 2) AS c, cast(i AS bigint) AS i)))"
    same = lambda x: " AND ".join(f"v.{c} = get(s, {x}).{c}" for c in "abc")
    exact_places = let("s", exact, f"sort_array(transform(filter(s, (v, k) -> coalesce({same('k + 1')}, false) OR coalesce({same('k - 1')}, false)), v -> v.i))")
    places = let("s", packed, let("t", twins, f"CASE WHEN size(t) < 2 THEN cast(array() AS array<bigint>) WHEN {unequal} THEN {exact_places} ELSE sort_array(transform(t, v -> v & mask)) END"))
    return F.expr(f"CASE WHEN n_words < 4 THEN 0L ELSE {_covered(places)} END")


def signals(docs: DataFrame, text_col: str = "text", into: str = "signals") -> DataFrame:
    """docs with a struct column of the counts that rules use (null text: zeros)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lacks = lambda chars: F.length("text") - F.length(F.translate("text", chars, ""))
    # the working columns live in a struct, so that columns of docs can have any name
    work = docs.select(F.struct("*").alias("row"), text.alias("text"))
    work = work.select("row", "text", F.expr(words_sql("text")).alias("words"))
    work = work.select("*", F.size("words").cast("long").alias("n_words"), F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACE, "") != "").alias("lines"))
    work = work.select("*", F.expr("shiftleft(1L, cast(ceil(log2(n_words + 1)) AS int)) - 1").alias("mask"))
    counts = {
        "n_words": F.col("n_words"), "word_chars": F.length(F.array_join("words", "")), "n_symbols": lacks(SYMBOLS), "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")), "n_repeat_words": _repeat_words(), "n_capitals": lacks(CAPITALS),
        "n_function_words": F.size(F.array_intersect("words", F.array(*map(F.lit, dict.fromkeys(FUNCTION_WORDS))))),
    }
    return work.select("row.*", F.struct(*(c.cast("long").alias(k) for k, c in counts.items())).alias(into))


def votes(of: str = "signals") -> Column:
    """The rules' votes as an array of ints."""
    said = []
    for good, bad in RULES.values():
        for name in _SIGNALS:
            good, bad = (x.replace(f" {name} ", f" {of}.{name} ") for x in (f" {good} ", f" {bad} "))
        said.append(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END")
    return F.expr(f"array({', '.join(said)})")


def posteriors(voted: DataFrame) -> DataFrame:
    """(votes, posterior) for each vote pattern in a DataFrame with votes and counts (whether a row has a part in the estimate)."""
    model = _fitted(voted)
    return model.select(F.explode(F.expr(_RATED)).alias("x")).select("x.votes", F.col("x.p").alias("posterior"))


_SAID = f"aggregate(sequence(0, {len(RULES) - 1}), ln(m.prior / (1 - m.prior)), (s, j) -> s + CASE x.votes[j] WHEN 1 THEN ln(m.good[j] / (1 - m.bad[j])) WHEN -1 THEN ln((1 - m.good[j]) / m.bad[j]) ELSE 0D END)"
_RATED = f"transform(patterns, x -> struct(x.votes AS votes, x.n AS n, 1 / (1 + exp(-{_SAID})) AS p))"


def _fitted(voted: DataFrame) -> DataFrame:
    """One row: patterns (votes, n) and the model m (prior, good, bad) after ROUNDS of estimation."""
    n = len(RULES)
    add = lambda what, when: f"aggregate(r, 0D, (s, x) -> s + CASE WHEN {when} THEN {what} ELSE 0D END)"
    share = lambda what, vote: f"transform(sequence(0, {n - 1}), j -> ({add(what, f'x.votes[j] = {vote}')} + 1) / ({add(what, 'x.votes[j] <> 0')} + 2))"
    better = f"""transform(array({_RATED}), r -> struct(({add('x.n * x.p', 'true')} + 1) / ({add('x.n', 'true')} + 2) AS prior, {share('x.n * x.p', 1)} AS good, {share('x.n * (1 - x.p)', -1)} AS bad))[0]"""
    start = f"struct({START[0]}D AS prior, array_repeat({START[1]}D, {n}) AS good, array_repeat({START[2]}D, {n}) AS bad)"
    patterns = voted.groupBy("votes").agg(F.count_if("counts").cast("double").alias("n"))
    model = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))  # at most 3**7
    return model.select("patterns", F.expr(f"aggregate(sequence(1, {ROUNDS}), {start}, (m, t) -> {better})").alias("m"))


def judge(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with a struct column `quality`: the signals, votes, posterior, base_failed and kept.

    Signals and votes are written once (with the columns of docs); the model is fitted on all of
    them. Null texts count as empty and fail the base rules, as does any text under 50 words.
    Repeated rows and ties each get the same verdict; a posterior of just one half keeps. Very long
    texts are judged whole. No rows in, no rows out. Columns of any name are kept but for one that
    is called `quality`, which is replaced.
    """
    docs = docs.drop("quality")
    rated = signals(docs.select(F.struct("*").alias("held"), F.col(f"`{text_col}`").alias("text")), "text", "quality")
    return _verdicts(rated, "held").select(*(F.col(f"held.`{c}`") for c in docs.columns), "quality")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs that judge() keeps, with all their columns, whatever their names."""
    rated = signals(docs.select(F.struct("*").alias("held"), F.col(f"`{text_col}`").alias("text")), "text", "quality")
    return _verdicts(rated, "held").filter("quality.kept").select(*(F.col(f"held.`{c}`").alias(c) for c in docs.columns))


def judge_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As judge, but only ids and verdicts: the texts are read and not written."""
    rated = signals(docs.select(F.col(f"`{id_col}`").alias("held"), F.col(f"`{text_col}`").alias("text")), "text", "quality")
    return _verdicts(rated, "held").withColumnRenamed("held", id_col)


def _verdicts(rated: DataFrame, held: str) -> DataFrame:
    """(held, quality) from a column that is handed on and the signals in quality."""
    rated = materialize(rated.select(held, "quality", votes("quality").alias("votes")), "signals")
    failed = BASE_FAILED
    for name in _SIGNALS:
        failed = failed.replace(name, f"quality.{name}")
    model = posteriors(rated.select("votes", F.expr(f"NOT ({failed})").alias("counts")))
    out = rated.join(F.broadcast(model), "votes", "left")  # at most 3**7 rows
    kept = F.expr(f"NOT ({failed}) AND posterior >= 0.5")
    fields = [F.col(f"quality.{c}").alias(c) for c in _SIGNALS]
    return out.select(held, F.struct(*fields, "votes", "posterior", F.expr(failed).alias("base_failed"), kept.alias("kept")).alias("quality"))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts, base verdict and the verdict of weak supervision on all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    q = judge_ids(docs)
    return q.select("doc_id", *(f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"))).withColumn("posterior", F.round("posterior", 6))


def _duck_rules() -> str:
    return ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v{j}" for j, (good, bad) in enumerate(RULES.values()))


def duckdb_sql() -> str:
    n = len(RULES)
    names = ", ".join(f"v{j}" for j in range(n))
    logit = " + ".join(["ln(m.prior / (1 - m.prior))", *(f"CASE v{j} WHEN 1 THEN ln(m.g{j} / (1 - m.b{j})) WHEN -1 THEN ln((1 - m.g{j}) / m.b{j}) ELSE 0 END" for j in range(n))])
    share = lambda w, j, v: f"(coalesce(sum({w}) FILTER (v{j} = {v}), 0) + 1) / (coalesce(sum({w}) FILTER (v{j} <> 0), 0) + 2)"
    cells = ", ".join(f"{share('n * p', j, 1)} AS g{j}, {share('n * (1 - p)', j, -1)} AS b{j}" for j in range(n))
    rounds = [f"m0 AS (SELECT {START[0]}::DOUBLE AS prior, {', '.join(f'{START[1]}::DOUBLE AS g{j}, {START[2]}::DOUBLE AS b{j}' for j in range(n))})"]
    for t in range(ROUNDS):
        rounds.append(f"r{t} AS MATERIALIZED (SELECT pat.*, 1 / (1 + exp(-({logit}))) AS p FROM pat, m{t} m)")
        rounds.append(f"m{t + 1} AS MATERIALIZED (SELECT (coalesce(sum(n * p), 0) + 1) / (coalesce(sum(n), 0) + 2) AS prior, {cells} FROM r{t})")
    listed = ", ".join(f"'{w}'" for w in dict.fromkeys(FUNCTION_WORDS))
    word = r"[^\x20\x09-\x0D]"
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}+') AS words FROM documents),
b AS (SELECT doc_id, text, words, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{word}')) AS lines FROM t),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS c FROM b, unnest(range(1, len(words) - 1)) u(i)),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM win, range(3) k(j) WHERE c > 1 GROUP BY doc_id),
s AS (SELECT b.doc_id, len(words) AS n_words, coalesce(length(array_to_string(words, '')), 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
 len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
 length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals, len(list_intersect(list_distinct(words), [{listed}])) AS n_function_words
 FROM b LEFT JOIN rep ON rep.doc_id = b.doc_id),
v AS (SELECT *, {_duck_rules()} FROM s),
pat AS MATERIALIZED (SELECT {names}, (count(*) FILTER (NOT ({BASE_FAILED})))::DOUBLE AS n FROM v GROUP BY ALL),
{', '.join(rounds)},
post AS (SELECT pat.*, 1 / (1 + exp(-({logit}))) AS p FROM pat, m{ROUNDS} m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
 ({BASE_FAILED}) AS base_failed, NOT ({BASE_FAILED}) AND p >= 0.5 AS kept, round(p, 6) AS posterior
FROM v JOIN post USING ({names})"""
