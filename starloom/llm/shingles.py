"""Word shingles of whole texts as sets of 64-bit hashes, and their min-hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
HASHES = 64
_REMEMBERED = 500_000
_rng = np.random.default_rng(20240607)
_MIX = _rng.integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = (_rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)[:, None]


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return value


_words = _Words()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``WIDTH`` words, split at white space, in lower case.

    A text of fewer words is one shingle of them all; one without words has none.
    """
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    if len(h) < WIDTH:
        h = np.concatenate([h, np.zeros(WIDTH - len(h), np.uint64)])
    n = len(h) - WIDTH + 1
    runs = h[:n] * _MIX[0]
    for i in range(1, WIDTH):
        runs = (runs ^ runs >> np.uint64(29)) * _MIX[i] + h[i:i + n]
    runs = (runs ^ runs >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(runs ^ runs >> np.uint64(32))


def minhash(hashes: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of a set that is not empty, as signed 32-bit numbers.

    The hashes are random already; each multiply-add permutes their upper halves.
    """
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(upper), 1_024):
        out = np.minimum(out, (_A * upper[None, at:at + 1_024] + _B).min(axis=1))
    return out.view(np.int32)
