"""Word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
#: A worker keeps the hashes of at most so many words, of at most 64 bytes each.
_KEPT = 250_000


class _Hashes(dict):
    def __missing__(self, word: bytes | str) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= _KEPT:
                self.clear()
            self[word] = h
        return h


_hashes = _Hashes()


def words(text: str) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8").translate(_LOWER).split()


def word_hashes(tokens: list[bytes] | list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Hash of every run of ``k`` words, in order; with fewer words the whole sequence is one, without words none."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < k:
        return mix(np.array([xxhash.xxh64_intdigest(hashes.tobytes(), seed=n)], np.uint64))
    mixed = mix(hashes)
    out = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        out += mixed[i : n - k + 1 + i] * (_MULTIPLIERS[i % len(_MULTIPLIERS)] + np.uint64(2 * (i // len(_MULTIPLIERS))))
    return mix(out)


def shingle_set(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct shingles of a text; a null or blank one has none."""
    return np.unique(shingles(word_hashes(words(text)), k)) if text else np.zeros(0, np.uint64)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
