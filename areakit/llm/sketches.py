"""Sketches of hashes: per cell a bit that says whether enough entries may have hit it.

Every task sketches its entries sparsely, by blocks of cells: the places hit once and those
hit more often. Blocks of all tasks are merged by Spark; what is left of them is a bit per
cell, of a total that the caller bounds, small enough to be broadcast. A sketch errs on one
side only: a cell that was hit often enough always has its bit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 30
BLOCK_CELLS = 1 << 16
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

PARTS = "block long, once binary, more binary"


def cell_bits(cells: int) -> int:
    """The width of cell numbers for about ``cells`` cells, within the bounds."""
    return (max(LEAST_CELLS, min(MOST_CELLS, cells)) - 1).bit_length()


def _cells(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes * _FACTOR) >> np.uint64(64 - bits)


class Sketch:
    def __init__(self, bitmap: np.ndarray, bits: int):
        self.bitmap, self.bits = bitmap, bits

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the (unsigned) hashes may have been entered often enough."""
        cell = _cells(hashes, self.bits)
        return (self.bitmap[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1


def partial_sketch(hashes: np.ndarray, bits: int) -> list[pa.Array]:
    """Columns of ``PARTS`` for a task's entries, a row for each block that they hit."""
    cell, counts = np.unique(_cells(hashes, bits), return_counts=True)
    block = (cell // np.uint64(BLOCK_CELLS)).astype(np.int64)
    offset = (cell % np.uint64(BLOCK_CELLS)).astype("<u2")
    cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block)).tolist()
    once, more = [], []
    for low, high in zip(cuts[:-1], cuts[1:]):
        own, single = offset[low:high], counts[low:high] == 1
        once.append(own[single].tobytes())
        more.append(own[~single].tobytes())
    return [pa.array(block[cuts[:-1]]), pa.array(once, pa.binary()), pa.array(more, pa.binary())]


def _merge(least: int):
    def run(parts: pd.DataFrame) -> pd.DataFrame:
        hit, again = np.zeros(BLOCK_CELLS, bool), np.zeros(BLOCK_CELLS, bool)
        for once, more in zip(parts["once"], parts["more"]):
            own = np.frombuffer(once, "<u2")
            again[own[hit[own]]] = True
            hit[own] = True
            own = np.frombuffer(more, "<u2")
            again[own] = True
            hit[own] = True
        found = hit if least == 1 else again
        return pd.DataFrame({"block": parts["block"].iloc[:1], "bits": [np.packbits(found, bitorder="little").tobytes()]})

    return run


def merge_sketch(parts: DataFrame, bits: int, least: int) -> Sketch:
    """The sketch of all ``parts``; ``least`` is 1 or 2, the entries that set a cell's bit."""
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    merged = parts.groupBy("block").applyInPandas(_merge(least), "block long, bits binary")
    for found in merged.toLocalIterator():
        start = found["block"] * BLOCK_CELLS // 8
        bitmap[start : start + BLOCK_CELLS // 8] = np.frombuffer(found["bits"], np.uint8)
    return Sketch(bitmap, bits)
