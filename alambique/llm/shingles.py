"""Sets of word shingles and their minwise sketches, over arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of a text, and shingles of a set, that are looked at together.
BYTES = 1 << 22
SHINGLES = 1 << 9

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])

#: An odd base, its inverse modulo 2**64, and a factor that mixes.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Hashes of the words between white space, A-Z lower-cased."""

    def __init__(self) -> None:
        self._up = _powers(_BASE, 1 << 12)
        self._down = _powers(_INVERSE, 1 << 12)

    def _tables(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self._up):
            size = 1 << (n - 1).bit_length()
            self._up, self._down = _powers(_BASE, size), _powers(_INVERSE, size)
        return self._up[:n], self._down

    def __call__(self, text: str) -> np.ndarray:
        raw = text.encode("utf-8", "surrogatepass").translate(_LOWER)
        parts = [self._part(p) for p in _parts(raw)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def _part(self, raw: bytes) -> np.ndarray:
        data = np.frombuffer(raw, np.uint8)
        word = ~_SPACE[data]
        edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        up, down = self._tables(len(data))
        # A word's polynomial is a difference of running sums, moved to its start.
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data + np.uint64(1)) * up)])
        value = (sums[ends] - sums[starts]) * down[starts]
        return mix(value + (ends - starts).astype(np.uint64))


def _parts(raw: bytes) -> Iterator[bytes]:
    """Stretches of about BYTES that end between words."""
    at = 0
    while at < len(raw):
        end = at + BYTES
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``size`` are one shingle."""
    n = len(words) - size + 1
    if not len(words):
        return words
    if n < 1:
        return _fold(words[:, None])
    return np.unique(_fold(np.stack([words[k : k + n] for k in range(size)])))


def _fold(rows: np.ndarray) -> np.ndarray:
    out = np.full(rows.shape[1], len(rows), np.uint64)
    for row in rows:
        out = mix(out * np.uint64(_BASE) + row)
    return out


def sketch(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Minimum of each of several hashes of the set, 32 bits each, of the upper halves
    of shingles and factors."""
    upper = (shingles >> np.uint64(32)).astype(np.uint32)
    odd = (factors >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = np.full(len(odd), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(upper), SHINGLES):
        hashed = upper[None, at : at + SHINGLES] * odd[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def signature(shingles: np.ndarray) -> int:
    """A hash of the whole set, as a signed 64-bit number."""
    total = mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([total])).view(np.int64)[0])


def factors(n: int, seed: int) -> np.ndarray:
    drawn = np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)
