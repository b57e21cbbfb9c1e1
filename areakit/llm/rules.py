"""Quality rules per document, and verdicts on whole hosts.

Rule failures are counted per host (the documents' ``source``). A host's failure rate is
shrunk towards the mean of all hosts by an empirical beta prior, whose mean and strength
come from the mean of the hosts' rates and from their variance beyond what chance gives hosts
of their sizes. Documents of a host whose shrunk
rate exceeds ``MAX_HOST_RATE`` go with it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areakit.llm.common import map_batches, only, words
from areakit.session import settle

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5

# Odd multipliers, one per place of a window; any would do.
_FACTORS = np.random.default_rng(5).integers(0, 2**63, WINDOW_WORDS, dtype=np.uint64) | np.uint64(1)


def repeated_words(tokens: list[str]) -> int:
    """Words inside windows of five words that occur twice or more in the text.

    Windows are compared by a hash first; those whose hash repeats are then compared
    word by word, so a collision changes nothing.
    """
    n = len(tokens) - WINDOW_WORDS + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, tokens), np.int64, len(tokens)).view(np.uint64)
    mixed = sum(hashes[i : i + n] * _FACTORS[i] for i in range(WINDOW_WORDS))
    _, group, sizes = np.unique(mixed, return_inverse=True, return_counts=True)
    maybe = np.flatnonzero(sizes[group] > 1).tolist()
    if not maybe:
        return 0
    windows = [tuple(tokens[i : i + WINDOW_WORDS]) for i in maybe]
    found = Counter(windows)
    covered = np.zeros(len(tokens) + 1, np.int64)
    for i, window in zip(maybe, windows):
        if found[window] > 1:
            covered[i] += 1
            covered[i + WINDOW_WORDS if i + WINDOW_WORDS < len(tokens) else -1] -= 1
    return int((np.cumsum(covered[:-1]) > 0).sum())


def repeated_lines(text: str) -> int:
    seen: set[str] = set()
    repeats = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            repeats += line in seen
            seen.add(line)
    return repeats


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            tokens = words(text)
            rows.append(
                (
                    len(tokens),
                    sum(map(len, tokens)),
                    sum(map(text.count, SYMBOLS)),
                    repeated_lines(text),
                    repeated_words(tokens),
                )
            )
        columns = np.array(rows, np.int64).reshape(-1, 5).T
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), *(pa.array(c) for c in columns)],
            names=["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        )


def measure_documents(df: DataFrame, host: str = "source") -> DataFrame:
    """The base measures of every whole text, with its host and ``base_failed``."""
    measured = map_batches(
        only(df, doc_id="long", text="string", **{host: "string"}).withColumnRenamed(host, "host"),
        _measure,
        "doc_id long, host string, n_words long, word_chars long, n_symbols long,"
        " n_dup_lines long, n_repeat_words long",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return measured.withColumn("base_failed", failed)


def host_verdicts(measured: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``host``, ``host_rate`` (shrunk) and ``host_kept`` for every host that is not null.

    The variance v of the hosts' rates, whose mean is m, holds that of drawing n documents at
    rate m, m (1 - m) / n in the mean over hosts, which is taken off. With what is left the
    prior counts as m (1 - m) / v - 1 documents with rate m (none if that is negative). Where
    nothing is left hosts do not differ beyond chance, and all have the mean rate; so has a
    single host.
    """
    hosts = (
        measured.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
        .withColumn("rate", F.col("failed") / F.col("n"))
    )
    hosts = settle(hosts)
    prior = hosts.agg(
        F.avg("rate").alias("m"), F.var_pop("rate").alias("v"), F.avg(1 / F.col("n")).alias("chance")
    ).first()
    mean = prior["m"] or 0.0
    variance = (prior["v"] or 0.0) - mean * (1 - mean) * (prior["chance"] or 0.0)
    if variance > 0:
        strength = max(mean * (1 - mean) / variance - 1, 0.0)
        rate = (F.col("failed") + F.lit(strength * mean)) / (F.col("n") + F.lit(strength))
    else:
        rate = F.lit(mean)
    return hosts.select("host", rate.alias("host_rate"), (rate <= max_rate).alias("host_kept"))


def judge_documents(df: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Base measures, ``base_failed``, ``host_rate`` and ``kept``, one row per row of ``df``.

    A null text has no words and fails. A document without a host is judged by its own
    rules only. Null and repeated doc_ids and repeated rows stay as they are, and count.
    """
    measured = settle(measure_documents(df, host))
    verdicts = host_verdicts(measured, max_rate)
    kept = ~F.col("base_failed") & F.coalesce(F.col("host_kept"), F.lit(True))
    return measured.join(verdicts, "host", "left").withColumn("kept", kept).drop("host_kept")
