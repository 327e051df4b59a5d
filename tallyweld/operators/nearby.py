"""Join of strings that are a few edits apart, beneath an equal key.

A string is cut into one piece more than there may be edits, so two near strings share a piece that
no edit touches, at places that differ by no more than the edits move it. Where many strings stand
beneath one key, both sides list pieces (of all lengths and places that are possible) and join on key,
length, number and text of a piece; what shares none is never paired. Beneath other keys, pairs are fewer
than pieces and are made directly. Either way pairs pass length and edit distance inside the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import similarity as sim

#: A key with more strings than this is joined by pieces: a string asks for some 40 of them.
CROWD = 64


def _cut(n: Column, pieces: int, i: int) -> tuple[Column, Column]:
    """Where piece i of a string of n characters starts (from 0), and its length; the last ones are one longer."""
    least, more = F.floor(n / pieces).cast("int"), (n % pieces).cast("int")
    return i * least + F.greatest(F.lit(0), i - pieces + more), least + F.when(pieces - i <= more, 1).otherwise(0)


def pieces(s: Column, most: int) -> Column:
    """Array of (n, i, piece): the string's length and each of its pieces."""
    n, k = F.length(s), most + 1
    return F.array(*(F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring(s, _cut(n, k, i)[0] + 1, _cut(n, k, i)[1]).alias("piece")) for i in range(k)))


def _piece_at(s: Column, n: Column, i: int, size: Column):
    return lambda place: F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring(s, place + 1, size).alias("piece"))


def probes(s: Column, most: int) -> Column:
    """Array of (n, i, piece): what a string at most `most` edits away from s can have as its pieces.

    Before piece i at most i edits count, behind it the others, which bounds the places from both ends.
    """
    out, k = [], most + 1
    for longer in range(-most, most + 1):
        n = F.length(s) - longer  # of the other string
        for i in range(k):
            start, size = _cut(n, k, i)
            low = F.greatest(start - i, start + longer - (k - 1 - i), F.lit(0))
            high = F.least(start + i, start + longer + (k - 1 - i), F.length(s) - size)
            places = F.when((n >= 0) & (low <= high), F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
            out.append(F.transform(places, _piece_at(s, n, i, size)))
    return F.array_distinct(F.flatten(F.array(*out)))


def crowded(known: DataFrame, on: Sequence[str], crowd: int = CROWD) -> DataFrame:
    """The keys with more than `crowd` strings: at most a `crowd`-th of known's rows."""
    return known.groupBy(*on).count().filter(F.col("count") > crowd).select(*on)


def known_pieces(known: DataFrame, text: str, most: int) -> DataFrame:
    """known with a row for each piece of its text."""
    return known.select("*", F.inline(pieces(F.col(text), most)))


def pairs_by_pieces(asked: DataFrame, pieced: DataFrame, on: Sequence[str], a: str, most: int) -> DataFrame:
    """Pairs that share a piece, some of them more than once; pieced is known_pieces()."""
    sought = asked.select("*", F.inline(probes(F.col(a), most)))
    return sought.join(pieced, [*on, "n", "i", "piece"]).drop("n", "i", "piece")


def pairs(asked: DataFrame, plain: DataFrame, pieced: DataFrame | None, crowds: DataFrame | None, on: Sequence[str], a: str, b: str, most: int) -> DataFrame:
    """Pairs of asked[a] and known[b] beneath equal keys that lengths or pieces leave; some of them more than once.

    plain holds the strings of uncrowded keys, pieced those of the crowded ones (None: no key is crowded).
    """
    one = asked.join(plain, list(on)).filter(F.abs(F.length(a) - F.length(b)) <= most)
    if pieced is None:
        return one
    many = pairs_by_pieces(asked.join(crowds, list(on), "left_semi"), pieced, on, a, most)
    return one.unionByName(many.select(*one.columns))


def near(found: DataFrame, a: str, b: str, most: int, once: bool = True) -> DataFrame:
    """Those of the pairs that are at most `most` edits apart; each once, where rows of either side are distinct."""
    kept = found.filter(F.levenshtein(F.col(a), F.col(b), most) >= 0)
    return kept.dropDuplicates() if once else kept
