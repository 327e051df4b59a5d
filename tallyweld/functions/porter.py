"""Porter's stemmer (M. F. Porter, An algorithm for suffix stripping, 1980)."""

from __future__ import annotations

import re


# The suffix tables of steps 2 to 4 of the published algorithm.
_STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _shape(stem: str) -> str:
    """The stem as vowels (v) and consonants (c)."""
    out = ""
    for i, ch in enumerate(stem):
        out += "v" if ch in "aeiou" or ch == "y" and i and out[-1] == "c" else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short(stem: str) -> bool:
    return _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _double(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _replace(word: str, table: dict[str, str]) -> str:
    for end in sorted(table, key=len, reverse=True):
        if word.endswith(end):
            stem = word[: -len(end)]
            return stem + table[end] if _measure(stem) > 0 else word
    return word


def stem(word: str) -> str:
    """The stem of a lower-case word of a-z."""
    if len(word) <= 2:
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    cut = None
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    elif word.endswith("ed") and "v" in _shape(word[:-2]):
        cut = word[:-2]
    elif word.endswith("ing") and "v" in _shape(word[:-3]):
        cut = word[:-3]
    if cut is not None:
        if cut.endswith(("at", "bl", "iz")):
            word = cut + "e"
        elif _double(cut) and cut[-1] not in "lsz":
            word = cut[:-1]
        else:
            word = cut + "e" if _measure(cut) == 1 and _short(cut) else cut
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(_replace(word, _STEP2), _STEP3)
    for end in sorted(_STEP4, key=len, reverse=True):
        if word.endswith(end):
            base = word[: -len(end)]
            if _measure(base) > 1 and (end != "ion" or base.endswith(("s", "t"))):
                word = base
            break
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or _measure(base) == 1 and not _short(base):
            word = base
    return word[:-1] if _measure(word) > 1 and _double(word) and word[-1] == "l" else word
