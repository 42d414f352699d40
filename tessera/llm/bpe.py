"""BPE with a contiguous rank array, over batches of words; one encoder for byte-level vocabularies."""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np

NO_RANK = np.int32(2**31 - 1)
#: Words up to this many symbols are scanned; longer ones use a heap, which stays near linear.
SHORT = 64


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class RankTable:
    """Vocabulary and merges of a byte-level BPE as arrays.

    ``suffix`` marks the end of a word (``</w>``) in vocabularies that have one.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.inner = np.array([vocab.get(c, -1) for c in alphabet], dtype=np.int32)
        self.last = np.array([vocab.get(c + self.suffix, -1) for c in alphabet], dtype=np.int32)
        left, right, made = [], [], []
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        key = (np.array(left, dtype=np.int64) << 32) | np.array(right, dtype=np.int64)
        # a repeated pair counts with its last rank, as in a map filled in order
        order = np.lexsort((-np.arange(len(key)), key))
        first = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, bool)
        self.keys, self.ranks = key[order][first], order[first].astype(np.int32)
        self.made = np.array(made, dtype=np.int32)
        size = 1 + max([*vocab.values(), *self.special.values()])
        back = {c: b for b, c in enumerate(alphabet)}
        text = [b""] * size
        for token, i in vocab.items():
            text[i] = bytes(back[c] for c in token.removesuffix(self.suffix)) if self.suffix else bytes(back[c] for c in token)
        for token, i in self.special.items():
            text[i] = token.encode()
        lengths = np.array([len(x) for x in text], dtype=np.int64)
        self.blob = np.frombuffer(b"".join(text), dtype=np.uint8)
        self.blob_start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        self.blob_len = lengths

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NO_RANK where the pair never merges."""
        if not len(self.keys):
            return np.full(a.shape, NO_RANK, dtype=np.int32)
        key = (a.astype(np.int64) << 32) | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], NO_RANK)

    def symbols(self, word: bytes) -> np.ndarray:
        raw = np.frombuffer(word, dtype=np.uint8)
        out = self.inner[raw]
        if self.suffix and len(raw):
            out[-1] = self.last[raw[-1]]
        return out

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word as little-endian unsigned 32-bit bytes."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        lo = 0
        for hi in (4, 8, 12, 16, 24, 32, SHORT):
            pick = np.flatnonzero((sizes > lo) & (sizes <= hi))
            for i in range(0, len(pick), 20_000):
                part = pick[i:i + 20_000]
                for k, ids in zip(part.tolist(), self._scan([words[j] for j in part.tolist()], sizes[part], hi), strict=True):
                    out[k] = ids
            lo = hi
        for k in np.flatnonzero(sizes > SHORT).tolist():
            out[k] = self._heap(words[k])
        return out

    def _scan(self, words: list[bytes], sizes: np.ndarray, width: int) -> list[bytes]:
        """Short words of one width class: a row of part ids (a part boundary lies between two of
        them) and a contiguous row of the ranks of adjacent pairs. Each round finds every row's
        leftmost minimum, deletes that boundary and refreshes the two neighbouring ranks."""
        n = len(words)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(n, width)
        cols = np.arange(width)
        parts = np.where(cols < sizes[:, None], self.inner[raw], -1).astype(np.int32)
        if self.suffix:
            rows = np.arange(n)
            parts[rows, sizes - 1] = self.last[raw[rows, sizes - 1]]
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        final = np.full((n, width), -1, dtype=np.int32)
        where = np.arange(n)  # the word of each row still at work
        while len(where):
            at = ranks.argmin(1)
            rows = np.arange(len(where))
            best = ranks[rows, at]
            done = best == NO_RANK
            if done.any():
                final[where[done], :parts.shape[1]] = parts[done]
                go = ~done
                where, parts, ranks, at, best = where[go], parts[go], ranks[go], at[go], best[go]
                if not len(where):
                    break
                rows = np.arange(len(where))
            new = self.made[best]
            w = parts.shape[1]
            moved = np.empty_like(parts[:, :-1])
            after = np.arange(w - 1) > at[:, None]
            np.copyto(moved, parts[:, :-1])
            np.copyto(moved, parts[:, 1:], where=after)
            moved[rows, at] = new
            parts = moved
            if w == 2:
                final[where, :1] = parts
                break
            near = np.where(np.arange(w - 2) >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            left, right = np.maximum(at - 1, 0), np.minimum(at, w - 3)
            has_left, has_right = at > 0, at < w - 2
            a = self.rank(parts[rows, left], new)
            near[rows[has_left], left[has_left]] = a[has_left]
            b = self.rank(new, parts[rows, np.minimum(at + 1, w - 2)])
            near[rows[has_right], right[has_right]] = b[has_right]
            ranks = near
        kept = final >= 0
        flat = final[kept].astype("<u4").tobytes()
        ends = (np.cumsum(kept.sum(1)) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _heap(self, word: bytes) -> bytes:
        """Any length: linked parts and a heap of (rank, position)."""
        ids = self.symbols(word).tolist()
        n = len(ids)
        nxt, prv = [*range(1, n), -1], [-1, *range(n - 1)]
        first = self.rank(np.array(ids[:-1], dtype=np.int32), np.array(ids[1:], dtype=np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NO_RANK]
        heapq.heapify(heap)
        look = self._pairs()
        alive = bytearray(b"\1") * n
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i] = int(self.made[r])
            alive[j] = 0
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            for p, q in ((prv[i], i), (i, nxt[i])):
                if p >= 0 and q >= 0 and (k := look.get((ids[p] << 32) | ids[q])) is not None:
                    heapq.heappush(heap, (k, p, ids[p], ids[q]))
        return np.array([ids[i] for i in range(n) if alive[i]], dtype="<u4").tobytes()

    @lru_cache(maxsize=1)  # noqa: B019
    def _pairs(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a run of ids, gathered from one table of all tokens' bytes."""
        ids = ids.astype(np.int64)
        n = self.blob_len[ids]
        ends = np.cumsum(n)
        if not len(ids) or not ends[-1]:
            return b""
        at = np.arange(ends[-1]) + np.repeat(self.blob_start[ids] - (ends - n), n)
        return self.blob[at].tobytes()


class Memo:
    """A bounded memo of two generations: the older half is dropped when the newer is full."""

    def __init__(self, limit: int) -> None:
        self.limit, self.new, self.old = limit, {}, {}

    def resolve(self, lists: list[list], make: Callable[[list], list]) -> dict:
        """Key to value for every key of the lists; unknown ones are made together, once each."""
        out, new, old = dict.fromkeys(chain.from_iterable(lists)), self.new, self.old
        missing = []
        for k in out:
            if (v := new.get(k)) is None:
                if (v := old.get(k)) is None:
                    missing.append(k)
                    continue
                new[k] = v
            out[k] = v
        if missing:
            out.update(zip(missing, make(missing), strict=True))
        if len(new) + len(missing) > self.limit:
            self.old, self.new = new, {}
        self.new.update((k, out[k]) for k in missing)
        return out


@lru_cache(maxsize=4)
def rank_table(path: str) -> RankTable:
    return RankTable(path)


@lru_cache(maxsize=8)
def memo(name: str, limit: int = 250_000) -> Memo:
    """One memo per process and name; workers are reused, so it lasts over tasks."""
    return Memo(limit)


def pieces(texts: list[str], limit: int = 2_000_000) -> list[tuple[int, int]]:
    """Runs of texts of about ``limit`` characters at most, to bound what is held at once."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            out.append((start, i))
            start, size = i, 0
        size += len(t)
    return [*out, (start, len(texts))] if texts else []
