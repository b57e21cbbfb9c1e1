"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct lower-case words and their five-letter beginnings. Training
takes every hash bucket that ``MIN_DOCUMENTS`` sampled documents share and fits, over all
of them, a bias, a weight each and a vector each whose products weigh pairs of terms: words
that offend only together get a score that no sum of single weights gives. Terms whose
frequency differs between the classes, alone, beside such a term or beside any frequent
term, learn in full steps, all others in small ones, so that rare words do not learn single
documents by heart.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areakit.llm.common import map_batches, only
from areakit.llm.labelled import held_out, labelled_sample, predicted

BUCKETS = 1 << 18
SAMPLE_ROWS = 8_000  # labelled documents used for training, at most
FACTORS = 8
MIN_DOCUMENTS = 3
MIN_Z, MIN_PAIR_Z = 3.5, 6.0  # of a term, and of one among the documents of such a term
FREQUENT_TERMS = 1_500  # the most frequent ones, of which all pairs are looked at
MIN_FREQUENT_PAIR_Z = 8.0  # of those, as they are a million
ROWS_AT_ONCE = 1_024
SMALL_STEP = 0.01
EPOCHS, RATE = 20, 0.3
THRESHOLD = 0.3
HELD_OUT = (4, 2)
BEGINNING = 5
CACHE_TERMS = 300_000

_TERM = re.compile(r"[^\W\d_]+")


def word_buckets(word: str) -> tuple[int, ...]:
    """The buckets of a word and, for a longer one, of its beginning."""
    found = (zlib.crc32(word.encode()) % BUCKETS,)
    if len(word) >= BEGINNING:
        found += (zlib.crc32(f"{word[:BEGINNING]}*".encode()) % BUCKETS,)
    return found


def text_words(text: str) -> set[str]:
    return set(_TERM.findall(text.lower()))


@dataclass(frozen=True)
class Machine:
    """A bias, the slot of each kept bucket (-1: not kept), and per slot a weight and a vector."""

    bias: float
    slot_of: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, slots: set[int]) -> float:
        chosen = np.fromiter(sorted(slots), np.int64, len(slots))
        vectors = self.vectors[chosen]
        pairs = 0.5 * float((vectors.sum(axis=0) ** 2 - (vectors**2).sum(axis=0)).sum())
        value = self.bias + float(self.weights[chosen].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of ``sizes`` rows, some of which may be empty."""
    out = np.zeros((len(sizes), *values.shape[1:]))
    filled = sizes > 0
    if filled.any():
        out[filled] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[filled], axis=0)
    return out


def _deviation(toxic: np.ndarray, n: np.ndarray, all_toxic: float, of: int) -> np.ndarray:
    """By how many deviations ``toxic`` of ``n`` documents differ from a draw out of ``of``."""
    share = n / of
    return np.abs(toxic - all_toxic * share) / np.sqrt(all_toxic * (1 - all_toxic / of) * share * (1 - share) + 0.25)


def _in_pairs(rows: list[np.ndarray], labels: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Frequent terms whose documents, where they hold another frequent term too, differ from all others.

    Neither of the two needs to differ alone: all pairs of the ``FREQUENT_TERMS`` are counted, as
    products of 0/1 matrices, and a pair counts if its toxic documents are more or fewer than both
    terms' own shares of toxic ones let expect.
    """
    frequent = np.sort(np.argsort(-n, kind="stable")[:FREQUENT_TERMS])
    place = np.full(len(n), -1)
    place[frequent] = np.arange(len(frequent))
    both = np.zeros((len(frequent), len(frequent)), np.float32)
    both_toxic = both.copy()
    for low in range(0, len(rows), ROWS_AT_ONCE):
        some = rows[low : low + ROWS_AT_ONCE]
        held = np.zeros((len(some), len(frequent)), np.float32)
        for i, row in enumerate(some):
            own = place[row]
            held[i, own[own >= 0]] = 1
        both += held.T @ held
        both_toxic += held.T @ (held * labels[low : low + ROWS_AT_ONCE, None].astype(np.float32))
    share = np.diag(both_toxic) / np.diag(both)
    all_share = labels.mean()
    # What single weights would make of the pair: odds that multiply.
    odds = lambda p: np.clip(p, 1e-3, 1 - 1e-3) / (1 - np.clip(p, 1e-3, 1 - 1e-3))
    joint = odds(share)[:, None] * odds(share)[None, :] / odds(all_share)
    expected = joint / (1 + joint)
    deviation = np.abs(both_toxic - both * expected) / np.sqrt(both * expected * (1 - expected) + 0.25)
    np.fill_diagonal(deviation, 0)
    found = np.zeros(len(n), bool)
    found[frequent] = (deviation >= MIN_FREQUENT_PAIR_Z).any(axis=1)
    return found


def marked(rows: list[np.ndarray], labels: np.ndarray, features: int) -> np.ndarray:
    """Which terms differ between the classes: alone, beside a term that does alone, or in a pair."""
    flat, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
    n = np.bincount(flat, minlength=features)
    toxic = np.bincount(flat, np.repeat(labels, sizes), features)
    alone = _deviation(toxic, n, labels.sum(), len(rows)) >= MIN_Z
    found = alone | _in_pairs(rows, labels, n)
    owner = np.repeat(np.arange(len(rows)), sizes)[np.argsort(flat, kind="stable")]
    ends = np.cumsum(n)
    for term in np.flatnonzero(alone).tolist():
        own = owner[ends[term] - n[term] : ends[term]]
        beside = np.concatenate([rows[i] for i in own.tolist()])
        both = np.bincount(beside, minlength=features)
        both_toxic = np.bincount(beside, np.repeat(labels[own], sizes[own]), features)
        found |= _deviation(both_toxic, both, toxic[term], len(own)) >= MIN_PAIR_Z
    return found


def fit(
    rows: list[np.ndarray],
    labels: np.ndarray,
    features: int,
    epochs: int = 30,
    rate: float = 0.1,
    steps: np.ndarray | None = None,
):
    """Bias, weights and vectors by AdaGrad on the log loss; ``rows`` hold feature numbers.

    ``steps`` scales the learning rate of each feature, 1 if not given.
    """
    random = np.random.default_rng(17)
    steps = np.ones(features) if steps is None else steps
    vectors = random.normal(0, 0.02, (features, FACTORS)) * steps[:, None]
    weights, bias = np.zeros(features), np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    seen_w, seen_v, seen_b = np.full(features, 1e-2), np.full(vectors.shape, 1e-2), 1e-2
    sizes = np.array([len(r) for r in rows])
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(len(rows)), max(1, len(rows) // 256)):
            own = sizes[batch]
            met, at = np.unique(np.concatenate([rows[i] for i in batch.tolist()]), return_inverse=True)
            owner = np.repeat(np.arange(len(batch)), own)
            w, v = weights[met], vectors[met]
            sums = _sums(v[at], own)
            value = bias + _sums(w[at], own) + 0.5 * (sums**2 - _sums(v[at] ** 2, own)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(value, -30, 30))) - labels[batch]) / len(batch)
            pull = np.bincount(at, error[owner], len(met))
            pairs = (error[:, None] * sums)[owner]
            slope_v = np.stack([np.bincount(at, pairs[:, f], len(met)) for f in range(FACTORS)], axis=1)
            slope_v += 1e-5 * v - pull[:, None] * v
            slope_w, slope_b = pull + 1e-5 * w, error.sum()
            seen_w[met] += slope_w**2
            seen_v[met] += slope_v**2
            seen_b += slope_b**2
            weights[met] -= rate * steps[met] * slope_w / np.sqrt(seen_w[met])
            vectors[met] -= 0.3 * rate * steps[met, None] * slope_v / np.sqrt(seen_v[met])
            bias -= rate * slope_b / np.sqrt(seen_b)
    return float(bias), weights, vectors


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            np.array(sorted({b for w in text_words(t) for b in word_buckets(w)}), "<i4").tobytes()
            for t in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(found, pa.binary())], names=["label", "buckets"]
        )


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``sample_rows`` labelled documents; only their buckets reach the driver."""
    sample = labelled_sample(docs, labels, "toxic", held_out(*HELD_OUT), sample_rows)
    found = map_batches(sample, _bucketed, "label int, buckets binary").collect()
    found.sort(key=lambda r: (bytes(r["buckets"]), r["label"]))  # whatever order tasks end in
    n, toxic = len(found), sum(r["label"] for r in found)
    slot_of = np.full(BUCKETS, -1, np.int32)
    if not 0 < toxic < n:
        bias = float(np.log((toxic + 0.5) / (n - toxic + 0.5)))
        return Machine(bias, slot_of, np.zeros(0), np.zeros((0, FACTORS)))
    rows = [np.frombuffer(r["buckets"], "<i4") for r in found]
    frequency = np.bincount(np.concatenate(rows), minlength=BUCKETS)
    shared = np.flatnonzero(frequency >= MIN_DOCUMENTS)
    slot_of[shared] = np.arange(len(shared))
    rows = [slots[slots >= 0] for slots in (slot_of[r] for r in rows)]
    target = np.array([r["label"] for r in found], np.float64)
    steps = np.where(marked(rows, target, len(shared)), 1, SMALL_STEP)
    bias, weights, vectors = fit(rows, target, len(shared), EPOCHS, RATE, steps)
    return Machine(bias, slot_of, weights, vectors)


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id`` and ``score`` of every whole text; a null or empty text gets the bias' score."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, slots_of = shared.value, {}
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                slots: set[int] = set()
                for word in text_words(text or ""):
                    known = slots_of.get(word)
                    if known is None:
                        if len(slots_of) >= CACHE_TERMS:
                            slots_of = {}
                        known = tuple(s for s in machine.slot_of[list(word_buckets(word))].tolist() if s >= 0)
                        slots_of[word] = known
                    slots.update(known)
                scores.append(machine.score(slots))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return map_batches(only(docs, doc_id="long", text="string"), run, "doc_id long, score double")


def toxic_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``doc_id``, ``score``, ``held_out`` and ``predicted``, one row per row of ``docs``.

    Learns from the text of labelled rows outside the held-out quarter only. Null ids are
    scored and never held out; equal texts get equal scores. Without labels of both
    classes every text gets the smoothed share of toxic ones.
    """
    scored = score_documents(docs, train(docs, labels, sample_rows))
    return predicted(scored, held_out(*HELD_OUT), threshold)
