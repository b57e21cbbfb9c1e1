"""Removing word windows that a document with a smaller id has, too.

A first pass counts windows in count-min sketches. Equal windows contain the same smallest
half-window (by hash), their anchor; counting anchors per document overestimates how many
documents hold a window, at about a thirteenth of the entries. Every task sketches its
documents sparsely by blocks of cells, block sketches of all tasks are merged, and what is
left of them is a bit per cell that at least two documents may have hit. Those bits, of a
size set by the input and bounded by ``MOST_CELLS``, are broadcast.

A second pass emits only windows whose anchor may be repeated, reduced per batch to the
smallest id that holds them, and groups them exactly by 96 bits of hash. Nothing that
repeats is lost: a sketch never counts too little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areakit.llm.common import map_batches, only, words
from areakit.llm.windows import BASES, rolling, sliding_min, spread, word_hashes
from areakit.session import settle

WINDOW_WORDS = 50
# Three sketch rows; cells per row follow the input's bytes between these bounds.
ROWS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
BYTES_PER_CELL = 16
LEAST_CELLS, MOST_CELLS = 1 << 20, 1 << 30
BLOCK_CELLS = 1 << 16
FLUSH = 4_000_000  # entries a task holds before it emits a partial sketch


def anchors(tokens: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes and each window's anchor (empty for texts below ``width`` words)."""
    hashes = word_hashes(tokens)
    half = width // 2
    return hashes, sliding_min(spread(rolling(hashes, half, BASES[0])), width - half + 1)


def cells(found: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (found * np.uint64(ROWS[row])) >> np.uint64(64 - bits)


class Repeats:
    """For each sketch row a bit per cell: two documents or more may have hit it."""

    def __init__(self, rows: list[np.ndarray], bits: int):
        self.rows, self.bits = rows, bits

    def maybe(self, found: np.ndarray) -> np.ndarray:
        out = np.ones(len(found), bool)
        for row, bitmap in enumerate(self.rows):
            cell = cells(found, row, self.bits)
            out &= (bitmap[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def _partial_sketches(width: int, bits: int):
    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = np.concatenate(held)
        for row in range(len(ROWS)):
            cell, counts = np.unique(cells(found, row, bits), return_counts=True)
            block = (cell // np.uint64(BLOCK_CELLS)).astype(np.int64)
            offset = (cell % np.uint64(BLOCK_CELLS)).astype("<u2")
            cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block)).tolist()
            ones, more = [], []
            for low, high in zip(cuts[:-1], cuts[1:]):
                own, once = offset[low:high], counts[low:high] == 1
                ones.append(own[once].tobytes())
                more.append(own[~once].tobytes())
            number = block[cuts[:-1]] + (row << 32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number), pa.array(ones, pa.binary()), pa.array(more, pa.binary())],
                names=["block", "once", "more"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                tokens = words(text)
                if len(tokens) >= width:
                    held.append(np.unique(anchors(tokens, width)[1]))
                    size += len(held[-1])
                    if size >= FLUSH:
                        yield from flush(held)
                        held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _merge_block(parts: pd.DataFrame) -> pd.DataFrame:
    once, repeated = np.zeros(BLOCK_CELLS, bool), np.zeros(BLOCK_CELLS, bool)
    for ones, more in zip(parts["once"], parts["more"]):
        own = np.frombuffer(ones, "<u2")
        repeated[own[once[own]]] = True
        once[own] = True
        own = np.frombuffer(more, "<u2")
        repeated[own] = True
        once[own] = True
    packed = np.packbits(repeated, bitorder="little").tobytes()
    return pd.DataFrame({"block": parts["block"].iloc[:1], "bits": [packed]})


def sketch_repeats(texts: DataFrame, width: int = WINDOW_WORDS) -> Repeats:
    """Merged sketch bits of all ``text`` of a frame, at most ``MOST_CELLS`` / 8 bytes a row."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    bits = (max(LEAST_CELLS, min(MOST_CELLS, size // BYTES_PER_CELL)) - 1).bit_length()
    partial = map_batches(texts.select("text"), _partial_sketches(width, bits), "block long, once binary, more binary")
    merged = partial.groupBy("block").applyInPandas(_merge_block, "block long, bits binary")
    rows = [np.zeros((1 << bits) // 8, np.uint8) for _ in ROWS]
    for found in merged.toLocalIterator():
        row, block = found["block"] >> 32, found["block"] & 0xFFFFFFFF
        start = block * BLOCK_CELLS // 8
        rows[row][start : start + BLOCK_CELLS // 8] = np.frombuffer(found["bits"], np.uint8)
    return Repeats(rows, bits)


def _kept(tokens: list[str], starts: np.ndarray, width: int) -> tuple[int, str]:
    """How many words the windows at ``starts`` cover, and all others joined by blanks."""
    marks = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + width, len(tokens)), -1)
    kept = np.cumsum(marks[:-1]) == 0
    return int((~kept).sum()), " ".join([t for t, k in zip(tokens, kept.tolist()) if k])


def _maybe_windows(tokens: list[str], width: int, repeats: Repeats):
    """Places and both hashes (64 and 32 bits) of the windows whose anchor may be repeated."""
    if len(tokens) < width:
        return None
    hashes, found = anchors(tokens, width)
    distinct, of = np.unique(found, return_inverse=True)
    places = np.flatnonzero(repeats.maybe(distinct)[of])
    if not len(places):
        return None
    one, two = (rolling(hashes, width, base)[places] for base in BASES)
    return places, one, (spread(two) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _candidates(width: int, shared):
    """Rows with windows that may be repeated, reduced to the smallest id in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeats = shared.value
        for batch in batches:
            held = []
            docs = batch.column("doc_id").to_pylist()
            for row, (doc, text) in enumerate(zip(docs, batch.column("text").to_pylist())):
                if doc is not None and (found := _maybe_windows(words(text), width, repeats)):
                    held.append((row, *found))
            if not held:
                continue
            rows = batch.take(pa.array([h[0] for h in held]))
            sizes = np.array([len(h[1]) for h in held])
            owner = np.repeat(rows.column("doc_id").to_numpy(), sizes)
            one, two = (np.concatenate([h[i] for h in held]) for i in (2, 3))
            order = np.lexsort((owner, two, one))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
            least = np.empty(len(order), np.int64)
            least[order] = owner[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            lost = owner > least
            cuts = np.cumsum(sizes)[:-1]
            split = lambda values, keep: [v[k] for v, k in zip(np.split(values, cuts), np.split(keep, cuts))]
            places = np.concatenate([h[1] for h in held])
            yield pa.RecordBatch.from_arrays(
                [
                    *(rows.column(c) for c in ("rid", "doc_id", "fingerprint", "text")),
                    pa.array(split(places.astype(np.int32), lost), pa.list_(pa.int32())),
                    pa.array(split(places.astype(np.int32), ~lost), pa.list_(pa.int32())),
                    pa.array(split(one.view(np.int64), ~lost), pa.list_(pa.int64())),
                    pa.array(split(two, ~lost), pa.list_(pa.int32())),
                ],
                names=["rid", "doc_id", "fingerprint", "text", "lost", "place", "one", "two"],
            )

    return run


def _result(rows: pa.RecordBatch, counts, removed, kept) -> pa.RecordBatch:
    own = [rows.column("doc_id"), rows.column("fingerprint")]
    counted = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
    return pa.RecordBatch.from_arrays(
        [*own, *counted], names=["doc_id", "fingerprint", "n_words", "n_removed", "kept"]
    )


def _untouched(width: int, shared):
    """The rows ``_candidates`` does not return, kept whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeats = shared.value
        for batch in batches:
            whole, counts, kept = [], [], []
            docs = batch.column("doc_id").to_pylist()
            for row, (doc, text) in enumerate(zip(docs, batch.column("text").to_pylist())):
                tokens = words(text)
                if doc is None or _maybe_windows(tokens, width, repeats) is None:
                    whole.append(row)
                    counts.append(len(tokens))
                    kept.append(" ".join(tokens))
            rows = batch.take(pa.array(whole, pa.int64()))
            yield _result(rows, counts, np.zeros(len(whole), np.int64), kept)

    return run


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("text", "lost", "gone"))
            for text, lost, gone in zip(*columns):
                tokens = words(text)
                number, rest = _kept(tokens, np.array([*lost, *(gone or [])], np.int64), width)
                counts.append(len(tokens))
                removed.append(number)
                kept.append(rest)
            yield _result(batch, counts, removed, kept)

    return run


def cut_documents(docs: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """``docs``, with all its columns, without the repeats; rows left empty by that go.

    A row that loses nothing keeps its text as it is; others have their words joined by one
    blank, and ``n_chars``, if it is a column, counts again. Repeated rows stay as many.
    """
    cut = remove_repeats(docs, width).filter("n_removed > 0").dropDuplicates(["doc_id", "fingerprint"])
    cut = cut.select(F.col("doc_id").alias("__id"), F.col("fingerprint").alias("__print"), F.col("kept").alias("__kept"))
    marked = docs.withColumn("__own", F.xxhash64("text"))
    joined = marked.join(cut, (F.col("doc_id") == F.col("__id")) & (F.col("__own") == F.col("__print")), "left")
    hit = F.col("__kept").isNotNull()
    changed = {"text": F.coalesce("__kept", "text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(hit, F.length("__kept").cast(kind)).otherwise(F.col("n_chars"))
    kept = joined.filter(~hit | (F.col("__kept") != ""))
    return kept.select(*(changed.get(c, F.col(c)).alias(c) for c in docs.columns))


def remove_repeats(df: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``n_words``, ``n_removed`` and ``kept``, one row per row of ``df``.

    Every word is removed that a window of ``width`` words covers which also starts in a
    row with a smaller doc_id; ``kept`` has the other words joined by one blank. Windows
    are judged on the input, so a chain of copies goes back to the smallest id. A null text
    has no words. A row without id neither removes nor loses anything; rows with the same
    id do not remove from each other.
    """
    texts = only(df, doc_id="long", text="string").withColumn("fingerprint", F.xxhash64("text"))
    repeats = df.sparkSession.sparkContext.broadcast(sketch_repeats(texts.filter("doc_id IS NOT NULL"), width))
    schema = "rid long, doc_id long, fingerprint long, text string, lost array<int>, place array<int>, one array<long>, two array<int>"
    numbered = texts.withColumn("rid", F.monotonically_increasing_id())
    maybe = settle(map_batches(numbered, _candidates(width, repeats), schema))
    windows = maybe.select("rid", "doc_id", F.inline(F.arrays_zip("place", "one", "two")))
    first = F.min("doc_id").over(Window.partitionBy("one", "two"))
    gone = windows.withColumn("first", first).filter(F.col("doc_id") > F.col("first"))
    gone = gone.groupBy("rid").agg(F.collect_list("place").alias("gone"))
    result = "doc_id long, fingerprint long, n_words long, n_removed long, kept string"
    cut = map_batches(maybe.select("rid", "doc_id", "fingerprint", "text", "lost").join(gone, "rid", "left"), _cut(width), result)
    return cut.unionByName(map_batches(texts, _untouched(width, repeats), result))
