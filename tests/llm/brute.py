"""Plain Python versions of what operators return."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return WORD.findall(text or "")


def substring(docs, window=13):
    first = {}
    for i, t in docs:
        w = split(t)
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, t in docs:
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def fold(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(text, n=5):
    w = split(fold(text))
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def jaccard(docs, percent=75):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(docs)]


def exact(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    return [(i, max(groups[t or ""]), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in docs]


def quality(text):
    w = split(text)
    tri = Counter(zip(w, w[1:], w[2:]))
    under = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(under)


WORDS_OF_FOUR_LANGUAGES = set("the of and to in is that for le la de et les des que un der die das und zu den ein mit el los en y se por una".split())


def ballot(text):
    """What the seven quality rules say of a text (1 good, -1 bad, 0 nothing), and whether the base rules reject it."""
    n, chars, symbols, dup, again = quality(text)
    w = split(text)
    lines = sum(1 for x in (text or "").split("\n") if split(x))
    capitals = sum("A" <= c <= "Z" for c in text or "")
    common = len(set(w) & WORDS_OF_FOUR_LANGUAGES)
    say = lambda good, bad: -1 if bad else int(good)
    said = (
        say(n >= 100, n < 50),
        say(symbols <= n / 20, symbols > n / 10),
        say(dup <= 0.15 * lines, dup * 100 > 30 * lines),
        say(again * 100 <= 9 * n, again * 100 > 18 * n),
        say(3 * n <= chars <= 10 * n, not 3 * n <= chars <= 10 * n),
        say(capitals <= chars / 4, capitals > chars / 2),
        say(common >= 2, not common),
    )
    return said, n < 50 or again * 2 > n


def verdicts(texts, rounds=12):
    """Whether each text is kept: expectation-maximisation text by text over those that the base rules pass."""
    ballots = [ballot(t) for t in texts]
    asked = [said for said, failed in ballots if not failed]
    prior, good, bad = 0.8, [0.9] * 7, [0.6] * 7

    def posterior(said):
        x = math.log(prior / (1 - prior))
        for v, g, b in zip(said, good, bad):
            x += math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b) if v < 0 else 0
        return 1 / (1 + math.exp(-x))

    for _ in range(rounds):
        p = [posterior(x) for x in asked]
        share = lambda weight, j, v: (sum(y for x, y in zip(asked, weight) if x[j] == v) + 1) / (sum(y for x, y in zip(asked, weight) if x[j]) + 2)
        q = [1 - x for x in p]
        prior, good, bad = (sum(p) + 1) / (len(p) + 2), [share(p, j, 1) for j in range(7)], [share(q, j, -1) for j in range(7)]
    return [not failed and posterior(said) >= 0.5 for said, failed in ballots]


def tokens(text, end):
    """Ids by the tokenizers library from the vocabulary file, then the end id."""
    import public_tokenizers
    from tokenizers import Tokenizer

    if "t" not in _TOKENIZER:
        _TOKENIZER["t"] = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*_TOKENIZER["t"].encode(text or "", add_special_tokens=False).ids, end]


_TOKENIZER = {}


def crc32(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Reshare the excess until no source is above its cap. sizes: source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    out, open_, left = {}, list(order), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return out
