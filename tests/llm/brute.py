"""Plain-Python versions of the operators, for small inputs only."""

import hashlib
import math
import re
import zlib
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contamination(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = WORD.findall(fold(text))
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if w else []:
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = WORD.findall(fold(text)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        names = ",".join(sorted(map(str, found)))
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def simhash(text, size=3):
    import xxhash

    w = SPACE.findall(fold(text))
    if not w:
        return 0
    n = min(size, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(len(w) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(docs, radius=3):
    prints = {d: simhash(t) for d, t in docs}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (f"{prints[d]:016x}", find(d)) for d in ids}


def phrases(docs, size=20):
    first, words = {}, {}
    for d, t in sorted(docs):
        words[d] = w = SPACE.findall(t or "")
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), (d, i))
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] != (d, i):
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def substrings(docs, size=50):
    first, data = {}, {}
    for d, t in sorted(docs):
        data[d] = b = (t or "").encode()
        for i in range(len(b) - size + 1):
            first.setdefault(b[i : i + size], d)
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def base_scores(docs):
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs}
    tokens = {d: [*SPACE.findall(fold(t)), None] for d, t in docs}
    count = Counter(w for d in tokens if not held[d] for w in tokens[d])
    n, v = sum(count.values()), len(count)
    return {d: (held[d], len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for d, w in tokens.items()}


def scores(docs, strength=(1000.0, 5.0)):
    """log10 probability of each text under the backoff model, token by token."""
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs}
    tokens = {d: (*SPACE.findall(fold(t)), None) for d, t in docs}
    count = Counter(w[i : i + n] for d, w in tokens.items() if not held[d] for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total, types = sum(c for g, c in count.items() if len(g) == 1), sum(len(g) == 1 for g in count)

    def p(context, word):
        if not context:
            return (count[(word,)] + 0.5) / (total + 0.5 * (types + 1))
        k = strength[len(context) - 1]
        return (count[(*context, word)] + k * p(context[1:], word)) / (count[context] + k)

    return {d: sum(math.log10(p(w[max(0, i - 2) : i], w[i])) for i in range(len(w))) for d, w in tokens.items()}


def shingle_sets(text, size=5):
    w = SPACE.findall(fold(text))
    n = min(size, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def similar_groups(docs, similarity=0.8, radius=3):
    """Smallest id of each document's group: five-word fingerprints within ``radius`` bits or shingles ``similarity`` alike."""
    ids = sorted(d for d, _ in docs)
    sets, prints = {d: shingle_sets(t) for d, t in docs}, {d: simhash(t, 5) for d, t in docs}
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if (prints[a] ^ prints[b]).bit_count() <= radius or shared and shared >= similarity * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def _id_hash(n):
    import struct

    import xxhash

    h = xxhash.xxh64_intdigest(struct.pack("<q", n), 42)
    return h - 2**64 if h >= 2**63 else h


class KneserNey:
    """Interpolated modified Kneser-Ney bigrams of tokenised texts."""

    def __init__(self, texts):
        self.pairs = Counter(p for t in texts for p in zip([None, *t], t))
        self.follows, self.left = {}, Counter(w for _, w in self.pairs)
        for (v, _), c in self.pairs.items():
            self.follows.setdefault(v, []).append(c)
        self.d2, self.d1 = self._discounts(self.pairs.values()), self._discounts(self.left.values())
        total, size = max(1, sum(self.left.values())), len(self.left)
        self.unknown = (sum(self._cut(a, self.d1) for a in self.left.values()) or 1.0) / total / (size + 1)
        self.p1 = {w: (a - self._cut(a, self.d1)) / total + self.unknown for w, a in self.left.items()}

    @staticmethod
    def _discounts(counts):
        n1, n2, n3, n4 = (sum(c == k for c in counts) for k in (1, 2, 3, 4))
        if not (n1 and n2 and n3):
            return 0.5, 0.75, 0.9
        y = n1 / (n1 + 2 * n2)
        return max(0.05, 1 - 2 * y * n2 / n1), max(0.05, 2 - 3 * y * n3 / n2), max(0.05, 3 - 4 * y * n4 / n3)

    @staticmethod
    def _cut(c, d):
        return d[min(c, 3) - 1]

    def p(self, v, w):
        low = self.p1.get(w, self.unknown)
        if v not in self.follows:
            return low
        n = sum(self.follows[v])
        c = self.pairs[v, w]
        freed = sum(self._cut(x, self.d2) for x in self.follows[v])
        return (c - self._cut(c, self.d2) if c else 0) / n + freed / n * low


def quality(docs, labels, fit_docs=2000, quantile=0.999, margin=3.0, support=0.04):
    """(perplexity, evidence, keep) of (doc_id, text, lang), with labels (doc_id, quality, toxic); ids are unique."""
    import regex

    token = regex.compile(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+")
    tokens = {d: token.findall((t or "").lower()) for d, t, _ in docs}
    trusted = {d for d, q, x in labels if q >= 1 and x <= 0}
    flagged = {d for d, q, x in labels if q < 1 or x > 0}
    first = lambda ids: set(sorted(ids, key=lambda d: (_id_hash(d), d))[:fit_docs])
    fit_good, fit_bad = first({d for d in trusted if _id_hash(d) % 2 == 0}), first(flagged)
    good, bad = KneserNey([tokens[d] for d in fit_good]), KneserNey([tokens[d] for d in fit_bad])
    gain = {w: max(0.0, math.log(bad.p1[w] / good.p1.get(w, good.unknown)) - margin) for w, a in bad.left.items() if a >= support * len(fit_bad)}
    score = {}
    for d, own in tokens.items():
        lp = sum(math.log(good.p(v, w)) for v, w in zip([None, *own], own))
        score[d] = (math.exp(-lp / len(own)) if own else None, sum(gain.get(w, 0.0) for w in own))

    def at(values, share):
        values = sorted(round(x, 4) for x in values)
        k = share * (len(values) - 1)
        low = math.floor(k)
        return values[low] + (k - low) * (values[min(low + 1, len(values) - 1)] - values[low])

    def limits(ids):
        lp, n = [math.log(score[d][0]) for d in ids], len(ids)
        low, mid, high = (at(lp, x) for x in (1 - quantile, 0.5, quantile))
        slack = 6 / math.sqrt(n)
        return math.exp(low - (mid - low) * slack), math.exp(high + (high - mid) * slack), at([score[d][1] for d in ids], quantile) * (1 + slack)

    unseen = [d for d in trusted - fit_good - fit_bad if score[d][0] is not None]
    lang = {d: x for d, _, x in docs}
    by = {x: limits([d for d in unseen if lang[d] == x]) for x in {lang[d] for d in unseen} if x is not None}
    overall = limits(unseen) if unseen else (0.0, math.inf, math.inf)
    out = {}
    for d, (perplexity, evidence) in score.items():
        low, high, most = by.get(lang[d], overall)
        out[d] = (perplexity, evidence, perplexity is not None and low <= perplexity <= high and evidence <= most)
    return out
