"""String similarity as Column expressions.

The longest common subsequence of strings of which one has at most WORD characters runs bit by
bit in a long; only pairs of longer strings take the table of the textbook, row by row.

Where every pair of many counts, `lcs_all` and `token_set_all` compare Arrow batches of pairs: the
same recurrence runs over all pairs of a batch at once.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from .text import text

#: Characters of the shorter string that fit one long with a spare carry bit.
WORD = 62


def _let(value: Column, use) -> Column:
    """use(x) with value made once."""
    return F.transform(F.array(value), use)[0]


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def _lcs_bits(long: Column, short: Column) -> Column:
    one = F.lit(1).cast("long")

    def run(chars: Column) -> Column:
        m = F.size(chars)
        ones = F.call_function("shiftleft", one, m) - one

        def step(v: Column, c: Column) -> Column:
            bit = F.aggregate(F.sequence(F.lit(0), m - 1), F.lit(0).cast("long"), lambda s, j: s.bitwiseOR(F.when(F.get(chars, j) == c, F.call_function("shiftleft", one, j)).otherwise(F.lit(0).cast("long"))))
            return _let(bit, lambda b: _let(v.bitwiseAND(b), lambda u: (v + u).bitwiseOR(v - u).bitwiseAND(ones)))

        left = F.aggregate(_chars(long), ones, step)
        return F.when(m == 0, 0).otherwise(m - F.bit_count(left))

    return _let(_chars(short), run)


def _lcs_rows(a: Column, b: Column) -> Column:
    def run(chars: Column) -> Column:
        first = F.transform(F.sequence(F.lit(0), F.size(chars)), lambda _: F.lit(0))

        def row(above: Column, c: Column) -> Column:
            cells = F.aggregate(
                F.sequence(F.lit(1), F.size(chars)),
                F.array(F.lit(0)),
                lambda done, j: F.concat(done, F.array(F.when(F.get(chars, j - 1) == c, F.get(above, j - 1) + 1).otherwise(F.greatest(F.get(above, j), F.get(done, j - 1))))),
            )
            return cells

        return F.element_at(F.aggregate(_chars(a), first, row), -1)

    return _let(_chars(b), run)


def lcs(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, in characters."""
    a, b = text(a), text(b)
    swap = F.length(a) < F.length(b)
    short, long = F.when(swap, a).otherwise(b), F.when(swap, b).otherwise(a)
    return F.when(F.length(short) == 0, 0).when(F.length(short) <= WORD, _lcs_bits(long, short)).otherwise(_lcs_rows(long, short))


def ratio(a: Column, b: Column) -> Column:
    """100 * 2 * lcs / (length of both); 100 for two empty strings."""
    a, b = text(a), text(b)
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 100.0).otherwise(200.0 * lcs(a, b) / total)


def rounded_ratio(common: Column, total: Column) -> Column:
    """ratio() from the common length and that of both, to six decimals. Strings of usual length take whole numbers, which don't pass through decimals."""
    common, total = common.cast("long"), total.cast("long")
    exact = F.call_function("div", 400_000_000 * common + total, 2 * total) / F.lit(1_000_000.0)
    return F.when(total == 0, 100.0).when(total < 1_000_000, exact).otherwise(F.round(200.0 * common / total, 6))


def tokens(c: Column) -> Column:
    return F.filter(F.split(text(c), r"(?U)\s+"), lambda t: t != "")


def sorted_tokens(c: Column) -> Column:
    return F.array_join(F.sort_array(tokens(c)), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio(sorted_tokens(a), sorted_tokens(b))


def token_set_ratio(a: Column, b: Column) -> Column:
    """The best ratio among the common tokens and either side's remaining ones."""
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    joined = lambda t: F.array_join(F.sort_array(t), " ")
    parts = F.struct(joined(F.array_intersect(x, y)).alias("both"), joined(F.array_except(x, y)).alias("left"), joined(F.array_except(y, x)).alias("right"), F.least(F.size(x), F.size(y)).alias("n"))

    def score(p: Column) -> Column:
        both, left, right = F.length(p["both"]), F.length(p["left"]), F.length(p["right"])
        gap = (both > 0).cast("int")
        l1, l2 = both + gap + left, both + gap + right
        apart = left + right - 2 * lcs(p["left"], p["right"])
        share = lambda d, n: 100.0 * (1 - d / n)
        rest = F.when(l1 + l2 == 0, 100.0).otherwise(share(apart, l1 + l2))
        own = F.greatest(share(gap + left, both + l1), share(gap + right, both + l2))
        return F.when(p["n"] == 0, 0.0).when((both > 0) & ((left == 0) | (right == 0)), 100.0).when(both > 0, F.greatest(rest, own)).otherwise(rest)

    return _let(parts, score)


#: Characters fall into so many classes by their code, and a class counts up to so many of them.
CLASSES, LEVELS = 32, 4


def signature(c: Column) -> Column:
    """(lo, hi): how often each class of characters occurs, as one bit more for each time, in two longs."""
    one, full = F.lit(1).cast("long"), F.lit((1 << LEVELS) - 1).cast("long")
    half = CLASSES // 2

    def step(at: Column, ch: Column) -> Column:
        kind = F.pmod(F.ascii(ch), F.lit(CLASSES))
        shift = (kind % half) * LEVELS
        more = lambda x: x.bitwiseOR(F.call_function("shiftleft", x, F.lit(1)).bitwiseOR(F.call_function("shiftleft", one, shift)).bitwiseAND(F.call_function("shiftleft", full, shift)))
        return F.struct(F.when(kind < half, more(at["lo"])).otherwise(at["lo"]).alias("lo"), F.when(kind < half, at["hi"]).otherwise(more(at["hi"])).alias("hi"))

    none = F.lit(0).cast("long")
    return F.aggregate(_chars(text(c)), F.struct(none.alias("lo"), none.alias("hi")), step)


def unmatched(a: Column, b: Column) -> Column:
    """Of two signatures: at least so many characters of a's string have no equal one in b's."""
    return F.bit_count(a["lo"].bitwiseAND(F.bitwise_not(b["lo"]))) + F.bit_count(a["hi"].bitwiseAND(F.bitwise_not(b["hi"])))


def may_reach(percent: float, length_a: Column, sig_a: Column, length_b: Column, sig_b: Column) -> Column:
    """Whether strings of these lengths and signatures can have a ratio above percent."""
    most = F.least(length_a - unmatched(sig_a, sig_b), length_b - unmatched(sig_b, sig_a))
    return 200.0 * most > percent * (length_a + length_b)


def sorted_ratio_above(percent: float, a: Column, b: Column, sig_a: Column, sig_b: Column) -> Column:
    """token_sort_ratio > percent of strings whose tokens are sorted; the subsequence is sought only where the signatures allow it."""
    possible = may_reach(percent, F.length(a), sig_a, F.length(b), sig_b)
    return F.when(a == b, F.lit(100.0 > percent)).when(possible, ratio(a, b) > percent).otherwise(False)


def _letters(strings: np.ndarray, width: int, fill: int) -> np.ndarray:
    """Code points, a row for each string, of its first `width` characters; what lies behind its end is `fill`."""
    out = np.full((len(strings), width), fill, dtype=np.uint32)
    for i, s in enumerate(strings):
        out[i, : len(s)] = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return out


def _lcs_one(a: str, b: str) -> int:
    """The recurrence of _lcs_bits over whole numbers of any length."""
    at: dict[str, int] = {}
    for j, c in enumerate(b):
        at[c] = at.get(c, 0) | 1 << j
    ones = (1 << len(b)) - 1
    v = ones
    for c in a:
        u = v & at.get(c, 0)
        v = (v + u | v - u) & ones
    return len(b) - v.bit_count()


def lcs_lengths(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of the pairs (a[i], b[j])."""
    la, lb = np.array([len(s) for s in a], dtype=np.int64), np.array([len(s) for s in b], dtype=np.int64)
    out = np.zeros(len(i), dtype=np.int64)
    wide = lb[j] > WORD
    for k in np.flatnonzero(wide):
        out[k] = _lcs_one(a[i[k]], b[j[k]])
    k = np.flatnonzero(~wide & (la[i] > 0) & (lb[j] > 0))
    if not len(k):
        return out
    # long strings of a side would widen all rows of its table, so they are compared apart
    far = k[la[i[k]] > 4 * WORD]
    for x in far:
        out[x] = _lcs_one(a[i[x]], b[j[x]])
    k = k[la[i[k]] <= 4 * WORD]
    if not len(k):
        return out
    ia, a_at = np.unique(i[k], return_inverse=True)
    ib, b_at = np.unique(j[k], return_inverse=True)
    x, y = _letters(a[ia], int(la[ia].max()), 0xFFFFFFFF), _letters(b[ib], 8 << max(0, int(lb[ib].max() - 1) // 8).bit_length(), 0xFFFFFFFE)[b_at]
    word = {8: np.uint8, 16: np.uint16, 32: np.uint32, 64: np.uint64}[y.shape[1]]
    m = lb[j[k]].astype(np.uint64)
    ones = (np.uint64(1) << m) - np.uint64(1)
    v = ones.copy()
    for t in range(x.shape[1]):
        same = np.packbits(y == x[a_at, t][:, None], axis=1, bitorder="little").view(word)[:, 0].astype(np.uint64)
        u = v & same
        v = ((v + u) | (v - u)) & ones
    out[k] = (m - np.bitwise_count(v)).astype(np.int64)
    return out


def _coded(strings) -> tuple[np.ndarray, np.ndarray]:
    """(codes, distinct strings). pandas' factorize takes strings as equal that differ behind a NUL."""
    seen: dict[str, int] = {}
    codes = np.fromiter((seen.setdefault(s, len(seen)) for s in strings), dtype=np.int64, count=len(strings))
    distinct = np.empty(len(seen), dtype=object)
    distinct[:] = list(seen)
    return codes, distinct


def _distinct_pairs(a: pd.Series, b: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a's strings, b's, i, j, at): the distinct pairs (i, j), and which of them each row has."""
    i, x = _coded(a.fillna("").tolist())
    j, y = _coded(b.fillna("").tolist())
    pairs, at = np.unique(i * max(1, len(y)) + j, return_inverse=True)
    return x, y, pairs // max(1, len(y)), pairs % max(1, len(y)), at


def lcs_all(a: Column, b: Column) -> Column:
    """lcs() over Arrow batches of pairs."""

    @F.pandas_udf("long")
    def common(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y, i, j, at = _distinct_pairs(a, b)
        return pd.Series(lcs_lengths(x, y, i, j)[at])

    return common(a, b)


def ratio_all(a: Column, b: Column) -> Column:
    """ratio() over Arrow batches of pairs."""
    a, b = text(a), text(b)
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 100.0).otherwise(200.0 * lcs_all(a, b) / total)


def token_set(c: Column) -> Column:
    """The distinct tokens, sorted, a space between them."""
    return F.array_join(F.sort_array(F.array_distinct(tokens(c))), " ")


#: White space as (?U)\s has it.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def token_set_all(a: Column, b: Column) -> Column:
    """token_set_ratio() over Arrow batches of pairs of token_set()s."""
    return _token_sets(a, b, lambda s: s.split(" ") if s else [])


def token_set_of(a: Column, b: Column) -> Column:
    """token_set_ratio() over Arrow batches of pairs; the tokens of a string are sought once in a batch."""
    return _token_sets(a, b, lambda s: sorted(set(_SPACE.split(s)) - {""}))


def _token_sets(a: Column, b: Column, split) -> Column:
    @F.pandas_udf("double")
    def rated(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y, i, j, at = _distinct_pairs(a, b)
        own, other = [split(s) for s in x], [split(s) for s in y]
        own_sets, other_sets = [set(t) for t in own], [set(t) for t in other]
        sizes, lefts, rights = np.zeros(len(i), dtype=np.int64), [], []
        for k, (p, q) in enumerate(zip(i.tolist(), j.tolist())):
            left, right = (" ".join(t for t in own[p] if t not in other_sets[q]), " ".join(t for t in other[q] if t not in own_sets[p]))
            both = [t for t in own[p] if t in other_sets[q]]
            sizes[k] = sum(map(len, both)) + max(0, len(both) - 1)
            lefts.append(left)
            rights.append(right)
        li, l_names = _coded(lefts)
        ri, r_names = _coded(rights)
        common = lcs_lengths(l_names, r_names, li, ri)
        left, right = np.array([len(s) for s in lefts], dtype=np.int64), np.array([len(s) for s in rights], dtype=np.int64)
        gap = (sizes > 0).astype(np.int64)
        l1, l2 = sizes + gap + left, sizes + gap + right
        share = lambda d, n: 100.0 * (1 - d / np.maximum(n, 1))
        rest = np.where(l1 + l2 == 0, 100.0, share(left + right - 2 * common, l1 + l2))
        best = np.maximum(rest, np.maximum(share(gap + left, sizes + l1), share(gap + right, sizes + l2)))
        out = np.where(sizes > 0, np.where((left == 0) | (right == 0), 100.0, best), rest)
        none = np.array([not own[p] or not other[q] for p, q in zip(i.tolist(), j.tolist())], dtype=bool)
        return pd.Series(np.where(none, 0.0, out)[at])

    return rated(a, b)


def token_set_above(percent: float, a: Column, b: Column) -> Column:
    """token_set_ratio > percent; what needs no subsequence is tried first, then bounds, then the subsequence."""
    x, y = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    joined = lambda t: F.array_join(F.sort_array(t), " ")
    parts = F.struct(joined(F.array_intersect(x, y)).alias("both"), joined(F.array_except(x, y)).alias("left"), joined(F.array_except(y, x)).alias("right"), F.least(F.size(x), F.size(y)).alias("n"))

    def score(p: Column) -> Column:
        both, left, right = F.length(p["both"]), F.length(p["left"]), F.length(p["right"])
        gap = (both > 0).cast("int")
        l1, l2 = both + gap + left, both + gap + right
        share = lambda d, n: 100.0 * (1 - d / n) > percent
        own = (both > 0) & ((left == 0) | (right == 0) | share(gap + left, both + l1) | share(gap + right, both + l2))
        rest = lambda common: share(left + right - 2 * common, l1 + l2)
        sides = F.struct(signature(p["left"]).alias("l"), signature(p["right"]).alias("r"))
        bound = _let(sides, lambda s: rest(F.least(left - unmatched(s["l"], s["r"]), right - unmatched(s["r"], s["l"]))))
        exact = rest(lcs(p["left"], p["right"]))
        return F.when(p["n"] == 0, False).when(own, True).when(l1 + l2 == 0, True).when(~rest(F.least(left, right)), False).when(~bound, False).otherwise(exact)

    return _let(parts, score)


def as_bytes(c: Column) -> Column:
    """The UTF-8 bytes of a string, as one character each."""
    return F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")


def byte_levenshtein(a: Column, b: Column) -> Column:
    """Edit distance over UTF-8 bytes: an accented letter against its base letter counts two."""
    return F.levenshtein(as_bytes(a), as_bytes(b))


def within(a: Column, b: Column, most: int, distance=F.levenshtein) -> Column:
    """distance <= most, after the length test that is cheap and implied; only a band of the table is filled."""
    lengths, of = (F.octet_length, as_bytes) if distance is byte_levenshtein else (F.length, lambda c: c)
    return (F.abs(lengths(a) - lengths(b)) <= most) & (F.levenshtein(of(a), of(b), most) >= 0)
