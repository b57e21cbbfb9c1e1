"""Hashes of word windows, vectorized over a text's words."""

from __future__ import annotations

import numpy as np
import pandas as pd

# Odd bases of two independent rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def word_hashes(tokens: list[str]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    return pd.util.hash_array(np.array(tokens, dtype=object), categorize=False)


def spread(values: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit values, so that all bits depend on all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """The polynomial hash of every ``width`` neighbouring words, built by doubling."""
    total, covered, power, length = None, 0, hashes, 1
    while True:
        if width & length:
            if total is None:
                total = power
            else:  # append the block of ``length`` words that starts where ``total`` ends
                tail = power[covered:]
                total = total[: len(tail)] * np.uint64(pow(base, length, 1 << 64)) + tail
            covered += length
        if covered == width:
            return total[: max(0, len(hashes) - width + 1)]
        factor = np.uint64(pow(base, length, 1 << 64))
        power = power[: max(0, len(power) - length)] * factor + power[length:]
        length *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    length = 1
    while length * 2 <= width:
        values = np.minimum(values[: max(0, len(values) - length)], values[length:])
        length *= 2
    rest = width - length
    return np.minimum(values[: max(0, len(values) - rest)], values[rest:]) if rest else values
