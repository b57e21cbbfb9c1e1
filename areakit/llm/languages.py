"""Language identification by a byte convolutional network in numpy.

A text is folded to lower case and cut into windows of ``WINDOW`` UTF-8 bytes that overlap
by as much as the widest filter needs, so that together they cover the whole of it. Each
byte has a learned vector; learned filters of several widths slide over them, are
max-pooled over the window and rectified; a softmax over the learned languages follows. A
text's probabilities are the mean of its windows', each weighing as many bytes as it is
the first to cover.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from areakit.llm.common import map_batches, only
from areakit.llm.labelled import held_out

WINDOW = 256
WIDTHS = (2, 3, 4)
OVERLAP = max(WIDTHS) - 1
STEP = WINDOW - OVERLAP
EMBED = 8
FILTERS = 16  # of each width
SLICE = 64  # windows convolved at a time

# Documents used for training, each whole: so many of each language and in all, and so many bytes.
LANGUAGE_ROWS = 400
SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 4_000_000
EPOCHS = 4
RATE = 0.01

UNKNOWN = "und"
HELD_OUT = (4, 2)

_DRAWS = 1 << 40

_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # (256, EMBED); byte 0 pads and stays zero
    filters: list[np.ndarray]  # for each width (width, EMBED, FILTERS)
    shift: np.ndarray  # (len(WIDTHS), FILTERS)
    combine: np.ndarray  # (len(WIDTHS) * FILTERS, languages)
    bias: np.ndarray

    def responses(self, windows: np.ndarray) -> Iterator[np.ndarray]:
        """For each width the filters' values at every place, (windows, places, FILTERS)."""
        for width, filters, shift in zip(WIDTHS, self.filters, self.shift):
            places = windows.shape[1] - width + 1
            value = None
            for k in range(width):
                # What each byte adds to every filter at this offset, looked up.
                part = np.take(self.embed @ filters[k], windows[:, k : k + places], axis=0)
                value = part if value is None else np.add(value, part, out=value)
            yield value + shift if width == WIDTHS[0] else np.add(value, shift, out=value)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        best = [np.maximum(value.max(axis=1), 0) for value in self.responses(windows)]
        return np.concatenate(best, axis=1)

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        return softmax(pooled @ self.combine + self.bias)


def softmax(value: np.ndarray) -> np.ndarray:
    power = np.exp(value - value.max(axis=1, keepdims=True))
    return power / power.sum(axis=1, keepdims=True)


def folded(text: str) -> bytes:
    return text.lower().encode()


def window_starts(length: int) -> np.ndarray:
    """Where the windows of a text of ``length`` bytes start; an empty one has one window."""
    return np.arange(max(1, -(-(length - OVERLAP) // STEP))) * STEP


def cut(raw: bytes) -> np.ndarray:
    """All windows of a text, one row each, padded with zeros."""
    starts = window_starts(len(raw))
    return np.frombuffer(raw + bytes(WINDOW), np.uint8)[starts[:, None] + np.arange(WINDOW)]


def shares(length: int) -> np.ndarray:
    """The share of a text's bytes that each of its windows is the first to cover."""
    starts = window_starts(length)
    ends = np.minimum(starts + WINDOW, max(1, length))
    return np.diff(ends, prepend=0) / max(1, length)


def fit(texts: list[bytes], of: np.ndarray, languages: list[str], epochs: int = EPOCHS) -> Network:
    """Adam on the log loss of single windows; ``of`` numbers each text's language."""
    random = np.random.default_rng(31)
    net = Network(
        languages,
        random.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        [random.normal(0, 0.3, (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros((len(WIDTHS), FILTERS), np.float32),
        random.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    net.embed[0] = 0
    windows = np.concatenate([cut(t) for t in texts])
    owner = np.repeat(of, [len(window_starts(len(t))) for t in texts])
    # Every language weighs the same, however many windows it has.
    weight = (1 / np.maximum(1, np.bincount(owner, minlength=len(languages))))[owner]
    weight = (weight / weight.mean()).astype(np.float32)
    values = [net.embed, *net.filters, net.shift, net.combine, net.bias]
    means, squares = ([np.zeros_like(v) for v in values] for _ in range(2))
    step = 0
    for epoch in range(epochs):
        rate = RATE if epoch < epochs - 1 else RATE / 4
        for batch in np.array_split(random.permutation(len(windows)), max(1, len(windows) // SLICE)):
            step += 1
            for value, mean, square, slope in zip(values, means, squares, slopes(net, windows[batch], owner[batch], weight[batch])):
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope**2 - square)
                update = mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
                value -= (rate * (update + 1e-4 * value)).astype(np.float32)
    return net


def slopes(net: Network, windows: np.ndarray, owner: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weighted mean loss of a batch of windows, in the order of the parameters."""
    at = np.arange(len(windows))[:, None]
    places, best = [], []
    for value in net.responses(windows):
        places.append(value.argmax(axis=1))
        best.append(value[at, places[-1], np.arange(FILTERS)])
    pooled = np.maximum(np.concatenate(best, axis=1), 0)
    error = net.probabilities(pooled)
    error[np.arange(len(owner)), owner] -= 1
    error *= weight[:, None] / len(owner)
    to_best = (error @ net.combine.T) * (pooled > 0)
    to_embed, to_filters, to_shift = np.zeros_like(net.embed), [], np.zeros_like(net.shift)
    for number, (width, place) in enumerate(zip(WIDTHS, places)):
        own = to_best[:, number * FILTERS : (number + 1) * FILTERS]
        to_shift[number] = own.sum(axis=0)
        slope = np.zeros_like(net.filters[number])
        for k in range(width):
            read = windows[at, place + k]
            slope[k] = np.einsum("nf,nfe->ef", own, net.embed[read])
            to_bytes = own[:, :, None] * net.filters[number][k].T
            for i in range(EMBED):
                to_embed[:, i] += np.bincount(read.ravel(), to_bytes[:, :, i].ravel(), 256).astype(np.float32)
        to_filters.append(slope)
    to_embed[0] = 0
    return [to_embed, *to_filters, to_shift, pooled.T @ error, error.sum(axis=0)]


def score_texts(net: Network, texts: list[bytes]) -> np.ndarray:
    """Probabilities of every language for each whole text, a row each."""
    out = np.zeros((len(texts), len(net.languages)))
    held, owner, weight, size = [], [], [], 0

    def flush() -> None:
        windows = np.concatenate(held)
        found = np.concatenate([net.pooled(windows[i : i + SLICE]) for i in range(0, len(windows), SLICE)])
        np.add.at(out, np.concatenate(owner), net.probabilities(found) * np.concatenate(weight)[:, None])

    for number, text in enumerate(texts):
        held.append(cut(text))
        owner.append(np.full(len(held[-1]), number))
        weight.append(shares(len(text)))
        size += len(held[-1])
        if size >= 64 * SLICE:
            flush()
            held, owner, weight, size = [], [], [], 0
    if held:
        flush()
    return out


def language_sample(docs: DataFrame) -> DataFrame:
    """``lang`` and ``text`` of some documents of every language, whole ones.

    At most ``LANGUAGE_ROWS`` of a language and ``SAMPLE_ROWS`` in all, in hash order and the
    languages in turn, as far as they fit into ``SAMPLE_BYTES``; of more than ``SAMPLE_ROWS``
    languages the most frequent ones. Held-out rows and rows
    without id, language or text are left out.
    """
    rows = only(docs, doc_id="long", text="string", lang="string").filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.filter(~held_out(*HELD_OUT)).withColumn("own", F.xxhash64("doc_id", "lang", "text"))
    # Only some thousand rows of a frequent language come together to be ranked.
    # Of the counts at most ``SAMPLE_ROWS`` are broadcast: no more languages could be sampled.
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(SAMPLE_ROWS)
    share = F.pmod(F.col("own"), F.lit(_DRAWS)) / _DRAWS <= F.lit(4.0 * LANGUAGE_ROWS) / F.col("n")
    sizes = rows.select("doc_id", "lang", "own", F.octet_length("text").alias("bytes")).join(F.broadcast(counts), "lang").filter(share)
    order = Window.partitionBy("lang").orderBy(F.pmod(F.col("own"), F.lit(_DRAWS)), "own", "doc_id")
    ranked = sizes.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= LANGUAGE_ROWS)
    first = ranked.orderBy("place", "own", "doc_id").limit(SAMPLE_ROWS).collect()
    chosen, total = {}, 0
    for row in first:
        if total + row["bytes"] <= SAMPLE_BYTES:
            total += row["bytes"]
            chosen[row["doc_id"], row["own"]] = None
    spark: SparkSession = docs.sparkSession
    ids = spark.createDataFrame(list(chosen), "doc_id long, own long")  # at most SAMPLE_ROWS
    return rows.join(F.broadcast(ids), ["doc_id", "own"]).dropDuplicates(["doc_id", "own"]).select("lang", "text")


def train(docs: DataFrame) -> Network | None:
    """Fit on :func:`language_sample`; none if no text has a language."""
    rows = sorted((r["lang"], r["text"]) for r in language_sample(docs).collect())
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    return fit([folded(text) for _, text in rows], np.array([languages.index(lang) for lang, _ in rows]), languages)


def identify(docs: DataFrame, model: Network | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            asked = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
            if asked:
                found = score_texts(model, [folded(texts[i]) for i in asked])
                best = found.argmax(axis=1)
                scores[asked] = np.minimum(found[np.arange(len(asked)), best], 1)
                for i, language in zip(asked, best.tolist()):
                    names[i] = model.languages[language]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
            )

    return map_batches(only(docs, doc_id="long", text="string"), run, "doc_id long, lang_pred string, score double")


def identify_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``, one row per row of ``docs``.

    Learns from texts and languages outside the held-out quarter only. ``lang_pred`` is a
    language that was learned, the first by name of equally likely ones, and ``score`` its
    probability; it is ``und``, with score 0, if the text is null or has no letter, or nothing
    was learned. Null ids are identified and never held out.
    """
    return identify(docs, train(docs)).withColumn("held_out", held_out(*HELD_OUT)).select("doc_id", "held_out", "lang_pred", "score")
