"""Plain, slow versions of what the operators compute, for small inputs."""

import hashlib
import re
import zlib

import xxhash

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


class Sets:
    """Union-find whose root is the smallest member."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def line_shingles(line, size=12):
    body = line.lstrip(" \t\n\x0b\f\r")
    return {body[k:k + size] for k in range(max(1, len(body) - size + 1))} if body else set()


def line_classes(docs):
    """``{(doc, line_no): (doc, line_no) of the class}`` for (id, text) pairs."""
    first, places = {}, []
    for d, t in sorted(docs, key=lambda x: x[0]):
        for k, line in enumerate((t or "").split("\n")):
            if line.strip():
                first.setdefault(line, (d, k))
                places.append((d, k, line))
    sets, lines = Sets(), list(first)
    grams = [line_shingles(x) for x in lines]
    for i, a in enumerate(grams):
        for j in range(i):
            both = len(a & grams[j])
            if 5 * both >= 4 * (len(a) + len(grams[j]) - both):
                sets.join(first[lines[i]], first[lines[j]])
    return {(d, k): sets.find(first[line]) for d, k, line in places}


def passages(docs, window=20):
    """``{doc: (n_words, n_removed, sha256)}``."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        w = SPACE_WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            x = tuple(w[k:k + window])
            if x in seen:
                gone[k:k + window] = [True] * window
            seen.add(x)
        kept = " ".join(a for a, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def simhash(text):
    w = SPACE_WORD.findall(ascii_lower(text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_classes(docs):
    sets, prints = Sets(), [(d, simhash(t)) for d, t in docs]
    for i, (d, a) in enumerate(prints):
        for e, b in prints[:i + 1]:
            if (a ^ b).bit_count() <= 3:
                sets.join(d, e)
    return {d: (f"{a:016x}", sets.find(d)) for d, a in prints}


def contaminated(docs, items, window=13):
    """``{doc: (n_words, n_hit, sorted item ids, contaminated)}``."""
    words = lambda t: BENCH_WORD.findall(ascii_lower(t)) if t else []
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(str(i))
    out = {}
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                found = wins.get(tuple(w[k:k + n]))
                if found:
                    hit |= set(range(k, k + n))
                    ids |= found
        out[d] = (len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w))
    return out


def crc_mod(doc, m):
    return zlib.crc32(str(doc).encode()) % m
