"""Positions along a Hilbert curve, for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_position(cells: np.ndarray, bits: int) -> np.ndarray:
    """Rows of integer cell coordinates (0 <= c < 2**bits) -> position on the curve, as int64.

    The curve's orientation at each level is undone from the highest bit down: a set bit
    mirrors the lower bits of the first axis, a clear bit swaps them with the first axis.
    Gray decoding across the axes then gives the position's bits, highest first.
    """
    x, dims = cells.astype(np.int64).T.copy(), cells.shape[1]
    if dims * bits > 62:
        raise ValueError("a position has at most 62 bits")
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(dims):
            mirror = (x[axis] >> level & 1).astype(bool)
            swap = np.where(mirror, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(mirror, x[0] ^ low, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(cells.shape[0], np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros(cells.shape[0], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(dims):
            out = out << 1 | x[axis] >> level & 1
    return out
