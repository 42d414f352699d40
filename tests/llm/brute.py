"""Plain single-process versions of the operators, to hold Spark's results against."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def exact(docs):
    """docs: [(id, text)] -> {id: (keep_id, group_size, kept, sha)} for unique ids."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), i == min(g)[1], sha(n)) for n, g in groups.items() for _, i in g}


def substring(docs, n=20):
    """{id: (n_words, n_removed, kept text)}; docs in any order."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            k = tuple(w[s:s + n])
            if k in seen:
                gone[s:s + n] = [True] * n
            seen.add(k)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def shingles(text, k=5):
    w = words(lower(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near(docs, percent):
    """{id: (n_shingles, component)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            by[s].append(i)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in by[s] if j < i)
        for j, both in common.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n)


def shard(key: str, n: int) -> int:
    def score(s):
        u = (int(hashlib.md5(f"{key}|{s}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        return -math.log(u), s
    return min(map(score, range(n)))[1]


class LM:
    """The documented model with plain dictionaries and recursion."""

    def __init__(self, docs, word_share=1e-5, arc_share=1e-6, discount=0.75, order=3):
        train = [words(lower(t)) for i, t in docs if not self.held(i)]
        self.c = Counter(x for w in train for x in w)
        self.n_docs = len(train)
        once, twice = (sum(v == k for v in self.c.values()) for k in (1, 2))
        self.d1 = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
        self.n = sum(self.c.values()) + self.n_docs
        common = {w for w, v in self.c.items() if v >= max(1, math.ceil(word_share * self.n))} | {"\n<", "\n>"}
        self.c["\n>"] = self.n_docs
        self.v = len(+self.c)
        self.ctx = Counter(self.c)
        self.ctx["\n<"] = self.n_docs
        grams = Counter()
        for w in train:
            s = ["\n<", *w, "\n>"]
            for k in range(2, order + 1):
                grams.update(g for g in zip(*(s[j:] for j in range(k)), strict=False) if common.issuperset(g))
        self.arcs = {g: v for g, v in grams.items() if v >= max(2, math.ceil(arc_share * self.n))}
        self.left = defaultdict(lambda: 1.0)
        self.d = discount
        for g, v in self.arcs.items():
            self.left[g[:-1]] -= (v - discount) / self.count(g[:-1])

    @staticmethod
    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0

    def count(self, h):
        return self.ctx[h[0]] if len(h) == 1 else self.arcs[h]

    def p(self, h, w):
        if not h:
            return (self.c[w] - self.d1) / self.n if self.c[w] else (self.d1 * self.v / self.n if self.n else 1.0)
        if h not in self.left:
            return self.p(h[1:], w)
        rest = self.left[h] * self.p(h[1:], w)
        return (self.arcs[(*h, w)] - self.d) / self.count(h) + rest if (*h, w) in self.arcs else rest

    def row(self, i, text):
        s = ["\n<", *words(lower(text)), "\n>"]
        base = sum(math.log10((self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in s[1:])
        score = sum(math.log10(self.p(tuple(s[max(0, k - 2):k]), s[k])) for k in range(1, len(s)))
        return self.held(i), len(s) - 1, sum(self.c[w] > 0 for w in s[1:]), self.n, base, score


def check_packing(rows, ids_of, capacity=4096):
    """rows: (id, piece, start, length, crc, sequence, offset); ids_of: {id: token ids with the end}."""
    bins, have = defaultdict(list), Counter()
    for i, piece, start, length, crc, seq, offset in rows:
        part = ids_of[i][start:start + length]
        assert start == capacity * piece and len(part) == length and zlib.crc32(np.array(part, "<u4").tobytes()) == crc
        have[i] += length
        bins[seq].append((offset, length))
    for v in bins.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= capacity
    return bins, have


def canon(cols, rows):
    """Rows as sorted text, columns in order of name; null and NaN differ."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    show = lambda v: f"{v:.6f}" if isinstance(v, float) else repr(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)
