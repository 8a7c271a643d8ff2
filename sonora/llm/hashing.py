"""Hashes of runs of words, made in arrays from the words' own hashes."""
from __future__ import annotations

import numpy as np

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number spread over all its bits; a bijection."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolled(h: np.ndarray, n: int, width: int, factor: np.uint64) -> np.ndarray:
    """A hash of each run of ``width`` word hashes that starts at one of the first ``n`` places."""
    g = np.zeros(n, np.uint64)
    for j in range(width):
        g = mixed(g * factor + h[j : j + n])
    return g
