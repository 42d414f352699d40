"""Word hashes, and Rabin-Karp hashes of word windows (polynomials modulo 2^64), over batches of texts."""

from __future__ import annotations

import re

import numpy as np
import xxhash

BASE_A, BASE_B, BASE_K = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB
_GAP = re.compile(rb"[ \t-\r]")
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = _POWERS[base] = (out[0], out[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(values: np.ndarray, n: int, base: int) -> np.ndarray:
    """Rolling hash of every run of ``n`` values (one per start), from prefix sums."""
    if len(values) < n:
        return values[:0]
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * down[:len(values)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * up[n - 1:len(values)])


def _parts(text: bytes, chunk: int) -> list[bytes]:
    """A text in parts that end between words, to bound the words that are held at once."""
    out, lo = [], 0
    while len(text) - lo > chunk:
        gap = _GAP.search(text, lo + chunk)
        if gap is None:
            break
        out.append(text[lo:gap.start()])
        lo = gap.start()
    return [*out, text[lo:]]


def word_hashes(texts: list[bytes], chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes (halves of a 128-bit one of its bytes) of every word (maximal run without ASCII white
    space) of the UTF-8 texts, and the place of each text's first word, with the total at the end.

    A polynomial modulo 2^64 would not do here: on long words over two letters it
    collides for every base."""
    digests, sizes = [], []
    for text in texts:
        n = 0
        for part in _parts(text, chunk) if len(text) > chunk else (text,):
            words = part.split()
            digests.append(b"".join(map(xxhash.xxh3_128_digest, words)))
            n += len(words)
        sizes.append(n)
    both = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1]), np.cumsum([0, *sizes])


def sliding(values: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of every run of ``n`` values, one per start."""
    out, have = values, 1
    while have < n:
        step = min(have, n - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out
