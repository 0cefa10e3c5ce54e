"""Hashed word n-grams of whole batches of texts, in a few passes of numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


#: Bytes that are hashed at once; a longer word is hashed whole.
CHUNK = 1 << 18


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse, for one chunk: 4 MB in all."""
    return powers_of(CHUNK)


def powers_of(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, dtype=np.uint64)
    down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (the finalizer of a public hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z in lower case, and where each text's words begin and end."""
    raw = [(t or "").encode() for t in texts]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 1
    data = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    if not data.size:
        return np.empty(0, np.uint64), np.zeros(len(raw) + 1, np.int64)
    starts, words, at = [], [], 0
    while at < data.size:  # chunks end at a blank, as every text does
        end = min(data.size, at + CHUNK)
        if end < data.size and not BLANK[data[end - 1]]:
            back = np.flatnonzero(BLANK[data[at:end]])
            end = at + int(back[-1]) + 1 if back.size else end + int(np.argmax(BLANK[data[end:]])) + 1
        start, hashes = chunk_hashes(data[at:end])
        starts.append(start + at)
        words.append(hashes)
        at = end
    return np.concatenate(words), np.searchsorted(np.concatenate(starts), np.concatenate([[0], np.cumsum(sizes)]))


def chunk_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a chunk begin, and their hashes."""
    blank = BLANK[data]
    start = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    end = np.flatnonzero(blank & np.append(False, ~blank[:-1]))
    up, down = powers() if data.size <= CHUNK else powers_of(data.size)
    sums = np.zeros(data.size + 1, dtype=np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: data.size], out=sums[1:])
    return start, mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its n-word shingles.

    A text with fewer words gives one, of the whole sequence; one without words gives none.
    """
    words, edge = word_hashes(texts)
    if words.size >= n:
        h = words[: words.size - n + 1].copy()
        for k in range(1, n):
            h = h * _STEP + words[k : words.size - n + 1 + k]
        h = mixed(h)
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b - a >= n:
            got = np.sort(h[a : b - n + 1])
            out.append(got[np.append(True, got[1:] != got[:-1])])
        elif b > a:
            one = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    one = one * _STEP + w
            out.append(mixed(np.array([one])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def nodes_of(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit name for each set, the same for equal sets."""
    sums = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
    xors = np.array([np.bitwise_xor.reduce(s) if s.size else 0 for s in sets], dtype=np.uint64)
    sizes = np.array([s.size for s in sets], dtype=np.uint64)
    return mixed(mixed(sums) ^ (xors + sizes)).view(np.int64)
