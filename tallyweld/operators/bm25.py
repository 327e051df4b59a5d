"""Full-text search over company names with Okapi BM25, as postings tables.

Postings are per term and company; a query joins its distinct tokens, so each token is scored once
however many suppliers ask for it. The first HEAD companies of each term are ranked when the index is
built: a token of one term, as nearly all are, takes them from there, however frequent the term is.

Tokens of several terms read postings only as far as bounds ask for. Postings lie in levels of weight,
and the largest weight of each level is known. The ready heads give a score that enough companies
reach at least. Terms that together stay below it can't bring a company in by themselves: they are only
looked up for companies that other terms bring. Of those, levels are read that can still reach that score
with the best that all other terms may add. Tokens of the same terms are scored once, and companies of
the same terms, too (`twins`).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources.tables import materialize

K1, B = 1.2, 0.75
#: Companies of a term, from the best and from the lowest on, that an index holds ready.
HEAD = 20
#: Levels of weight for each unit; weights lie below K1 + 1.
LEVELS = 32
#: Scores are compared after nine decimals, so bounds give way by more than these.
_SLACK = 1e-8
_ACCENTED = [chr(c) for c in range(0xC0, 0x180) if len(unicodedata.normalize("NFD", chr(c))) > 1]
_BASE = "".join(unicodedata.normalize("NFD", c)[0] for c in _ACCENTED)


def terms(c: Column) -> Column:
    """Lower-case runs of a-z after stripping accents; digits separate terms."""
    plain = F.lower(F.translate(F.coalesce(c, F.lit("")), "".join(_ACCENTED), _BASE))
    return F.filter(F.split(plain, "[^a-z]+"), lambda t: t != "")


@dataclass
class Index:
    postings: DataFrame  # siren, term, tf, dl, weight, level
    vocabulary: DataFrame  # term, df, idf
    stats: DataFrame  # one row: n, avgdl
    heads: DataFrame  # term, siren, score, direction, rank
    levels: DataFrame  # term, level, top (the largest weight of the level), n
    stemmer: str | None = None


def stem_porter(words: DataFrame, column: str = "term") -> DataFrame:
    """(term, stem) of the distinct terms; the stemmer sees each term once."""
    from ..functions.porter import stem

    distinct = words.select(column).distinct()

    def run(batches):
        for pdf in batches:
            pdf["stem"] = pdf[column].map(stem)
            yield pdf

    return distinct.mapInPandas(run, f"{column} string, stem string")


def english_stop_words() -> list[str]:
    """Spark's own English list."""
    from pyspark.ml.feature import StopWordsRemover

    return sorted({t for w in StopWordsRemover.loadDefaultStopWords("english") for t in re.split("[^a-z]+", w.lower()) if t})


def build(legal: DataFrame, key: str = "siren", field: str = "denominationUniteLegale", stemmer: str | None = None, stop_words: Sequence[str] = ()) -> Index:
    """The index of one field. Stop words are in no posting and in no length; a query's are then in no vocabulary either."""
    stats = statistics(legal, field, stop_words)
    weighted = postings(legal, stats, key, field, stemmer, stop_words)
    rare = vocabulary(weighted, stats)
    return Index(weighted, rare, stats, heads(weighted, rare, key), levels(weighted), stemmer)


def _kept_terms(c: Column, stop_words: Sequence[str]) -> Column:
    return F.filter(terms(c), lambda t: ~t.isin(list(stop_words))) if stop_words else terms(c)


def statistics(legal: DataFrame, field: str = "denominationUniteLegale", stop_words: Sequence[str] = ()) -> DataFrame:
    """One row: n and avgdl. Documents without any term count, too."""
    return legal.select(F.size(_kept_terms(F.col(field), stop_words)).alias("dl")).agg(F.count("*").cast("double").alias("n"), F.avg("dl").alias("avgdl"))


def postings(legal: DataFrame, stats: DataFrame, key: str = "siren", field: str = "denominationUniteLegale", stemmer: str | None = None, stop_words: Sequence[str] = ()) -> DataFrame:
    """(siren, term, tf, dl, weight, level). Words are dealt once, by company: its terms and its length are counted where it lies."""
    words = legal.select(key, F.explode(_kept_terms(F.col(field), stop_words)).alias("term"))
    if stemmer == "porter":
        words = words.join(stem_porter(words), "term").select(key, F.col("stem").alias("term"))
    counted = words.repartition(key).groupBy(key, "term").agg(F.count("*").alias("tf")).withColumn("dl", F.sum("tf").over(W.partitionBy(key)))
    # the collection's figures enter once, as scalar subqueries, so that queries only look terms up
    weighted = legal.sparkSession.sql(f"SELECT *, tf * {K1 + 1}D / (tf + {K1}D * ({1 - B}D + {B}D * dl / (SELECT avgdl FROM {{stats}}))) AS weight FROM {{p}}", p=counted, stats=stats)
    return weighted.withColumn("level", F.floor(F.col("weight") * LEVELS).cast("int"))


def vocabulary(postings: DataFrame, stats: DataFrame) -> DataFrame:
    """(term, df, idf)."""
    return postings.sparkSession.sql("SELECT *, ln(1 + ((SELECT n FROM {stats}) - df + 0.5D) / (df + 0.5D)) AS idf FROM {v}", v=postings.groupBy("term").agg(F.count("*").alias("df")), stats=stats)


def levels(postings: DataFrame) -> DataFrame:
    """For each term and level of weight the largest weight and the number of postings, combined before the shuffle."""
    return postings.groupBy("term", "level").agg(F.max("weight").alias("top"), F.count("*").alias("n"))


def heads(postings: DataFrame, vocabulary: DataFrame, key: str = "siren") -> DataFrame:
    """The first HEAD postings of each term in either direction, as top() ranks them."""
    scored = postings.join(vocabulary, "term").select("term", key, (F.col("idf") * F.col("weight")).alias("score"))
    return top(scored, HEAD, "desc", "term", key).withColumn("direction", F.lit("desc")).union(top(scored, HEAD, "asc", "term", key).withColumn("direction", F.lit("asc")))


def asked_terms(index: Index, queries: DataFrame, token: str = "search_token") -> DataFrame:
    """(token, terms) of the distinct tokens, as the index has its terms."""
    asked = queries.select(token).distinct().withColumn("terms", F.array_distinct(terms(F.col(token))))
    if index.stemmer != "porter":
        return asked
    words = asked.select(token, F.explode("terms").alias("term"))
    return words.join(stem_porter(words), "term").groupBy(token).agg(F.collect_set("stem").alias("terms"))


def candidates(index: Index, queries: DataFrame, limit: int = HEAD, direction: str = "desc", token: str = "search_token", key: str = "siren") -> DataFrame:
    """(token, siren, score, rank): as top(score(...)), with what the index holds ready."""
    if limit > HEAD:
        return top(score(index, queries, token, key), limit, direction, token, key)
    asked = materialize(asked_terms(index, queries, token), "tokens")
    one = asked.filter(F.size("terms") == 1).select(token, F.col("terms")[0].alias("term"))
    ready = index.heads.filter((F.col("direction") == direction) & (F.col("rank") <= limit))
    found = one.join(ready, "term").select(token, key, "score", "rank")
    more = asked.filter(F.size("terms") > 1).withColumn("same", F.array_join(F.sort_array("terms"), " "))
    if more.isEmpty():
        return found
    # tokens of the same terms are scored once, and so are companies of the same terms
    of = twins(index, key)
    sets = more.groupBy("same").agg(F.first("terms").alias("terms"))
    # bounds tell which companies can be among the best, not which among the lowest
    scored = best_scores(of.index, sets, limit, "same", key) if direction == "desc" else _score(of.index, sets, "same", key)
    first = top(scored, limit, direction, "same", key).select("same", F.col(key).alias("first"), "score")
    members = of.members.filter(F.col("place") <= limit).select("first", key)
    best = materialize(top(first.join(members, "first"), limit, direction, "same", key).select("same", key, "score", "rank"), "best")
    return found.unionByName(more.select(token, "same").join(best, "same").select(token, key, "score", "rank"))


@dataclass
class Twins:
    index: Index  # its postings are those of the first company of each bag of terms
    members: DataFrame  # first, siren, place: the first HEAD companies of each bag, by their number


def twins(index: Index, key: str = "siren") -> Twins:
    """Companies of equal bags of terms have equal scores for any token, and ties go by number.

    So of a bag the first company stands for all, and no more than `limit` of its companies can be
    among a token's best or lowest: if `limit` bags are ranked by score and first company, a company of
    any other bag comes after these bags' first companies. Terms keep the figures of all companies.
    """
    bags = index.postings.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("term", "tf"))).alias("bag"))
    order = W.partitionBy("bag").orderBy(key)
    ranked = bags.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= HEAD)
    ranked = materialize(ranked.withColumn("first", F.min(key).over(W.partitionBy("bag"))).select("first", key, "place"), "members")
    firsts = ranked.filter("place = 1").select(key)
    return Twins(replace(index, postings=materialize(index.postings.join(firsts, key, "left_semi"), "firsts")), ranked)


def _bounds(index: Index, asked: DataFrame, limit: int, token: str, key: str) -> DataFrame:
    """(token, term, idf, most, others, sought): for each term of a token the most it gives, what all others give at
    most, and whether it has to be read; floor: a score that `limit` companies reach at least (0: fewer are known)."""
    words = asked.select(token, F.explode("terms").alias("term")).join(index.vocabulary, "term")
    most = index.levels.groupBy("term").agg(F.max("top").alias("top"))
    words = words.join(most, "term").select(token, "term", "idf", (F.col("idf") * F.col("top")).alias("most"))
    ready = words.select(token, "term").join(index.heads.filter("direction = 'desc'").select("term", key, "score"), "term")
    known = ready.groupBy(token, key).agg(F.sum("score").alias("least"))
    best = known.withColumn("r", F.row_number().over(W.partitionBy(token).orderBy(F.col("least").desc()))).filter(F.col("r") == limit)
    words = words.join(best.select(token, F.col("least").alias("floor")), token, "left").na.fill(0.0, ["floor"])
    rising = W.partitionBy(token).orderBy("most", "term")
    return words.select("*", (F.sum("most").over(W.partitionBy(token)) - F.col("most")).alias("others"), (F.sum("most").over(rising.rowsBetween(W.unboundedPreceding, 0)) + _SLACK >= F.col("floor")).alias("sought"))


def read_postings(index: Index, bounds: DataFrame, token: str = "search_token", key: str = "siren") -> DataFrame:
    """(token, siren, floor, rest, part): the postings of the terms that have to be read, in the levels that can reach the floor."""
    worth = bounds.filter("sought").join(index.levels, "term").filter(F.col("idf") * F.col("top") + F.col("others") + _SLACK >= F.col("floor"))
    hits = worth.select(token, "term", "level", "idf", "floor").join(index.postings.select("term", "level", key, "weight"), ["term", "level"])
    return hits.select(token, "term", key, "floor", (F.col("idf") * F.col("weight")).alias("part"))


def best_scores(index: Index, asked: DataFrame, limit: int = HEAD, token: str = "search_token", key: str = "siren") -> DataFrame:
    """(token, siren, score) of companies among which the best `limit` of each token are, with their whole scores."""
    bounds = materialize(_bounds(index, asked, limit, token, key), "bounds")
    rest = bounds.filter("NOT sought").groupBy(token).agg(F.sum("most").alias("rest"), F.collect_list(F.struct("term", "idf")).alias("unread"))
    found = read_postings(index, bounds, token, key).groupBy(token, key).agg(F.sum("part").alias("part"), F.first("floor").alias("floor"))
    found = found.join(rest, token, "left").na.fill(0.0, ["rest"]).filter(F.col("part") + F.col("rest") + _SLACK >= F.col("floor"))
    found = materialize(found.select(token, key, "part", "unread"), "found")
    looked = found.select(token, key, F.inline("unread")).join(index.postings.select("term", key, "weight"), ["term", key]).select(token, key, (F.col("idf") * F.col("weight")).alias("part"))
    return found.select(token, key, "part").unionByName(looked).groupBy(token, key).agg(F.sum("part").alias("score"))


def score(index: Index, queries: DataFrame, token: str = "search_token", key: str = "siren") -> DataFrame:
    """(token, siren, score) of all companies that hold a term of the query."""
    return _score(index, asked_terms(index, queries, token), token, key)


def _score(index: Index, asked: DataFrame, token: str, key: str) -> DataFrame:
    hits = asked.select(token, F.explode("terms").alias("term")).join(index.vocabulary, "term").join(index.postings, "term")
    return hits.groupBy(token, key).agg(F.sum(F.col("idf") * F.col("weight")).alias("score"))


def top(scored: DataFrame, limit: int = 20, direction: str = "desc", token: str = "search_token", key: str = "siren") -> DataFrame:
    """The best (desc) or the lowest (asc) of each token; equal scores by key."""
    best = F.round("score", 9)
    order = W.partitionBy(token).orderBy(best.asc() if direction == "asc" else best.desc(), key)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
