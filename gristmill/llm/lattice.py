"""The E8 lattice: nearest points and their neighbours, for whole arrays of vectors."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8 (integers of even sum): where the sum is odd, the worst rounded place goes the other way."""
    near = np.rint(x)
    odd = near.sum(axis=-1) % 2 != 0
    off = x - near
    worst = np.abs(off).argmax(axis=-1)
    step = np.where(np.take_along_axis(off, worst[..., None], -1)[..., 0] < 0, -1.0, 1.0) * odd
    np.put_along_axis(near, worst[..., None], np.take_along_axis(near, worst[..., None], -1) + step[..., None], -1)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points of ``x`` (..., 8), doubled so that they are integers: D8 or D8 shifted by one half."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(-1) < ((x - whole) ** 2).sum(-1)
    return (2 * np.where(closer[..., None], half, whole)).astype(np.int64)


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled: two entries of one, or eight halves with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-2, 2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(v) for v in product((-1, 1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(out, np.int64)


_STEPS = minimal_vectors()


def neighbours(x: np.ndarray, home: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` lattice points around ``home`` (n, 8) nearest to ``x`` (n, 8), home left out, and how much farther
    (in squared distance) they are than home."""
    off = x - home / 2
    more = (_STEPS**2).sum(-1) / 4 - off @ _STEPS.T
    order = np.argpartition(more, count - 1, axis=1)[:, :count]
    return home[:, None, :] + _STEPS[order], np.take_along_axis(more, order, 1)
