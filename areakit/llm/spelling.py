"""Grouping spelling variants by a trie over letter counts.

Letters are dealt to ``GROUPS`` groups. A word's path in the trie is its number of letters
in each group, one level a group; words with equal counts share a leaf. Two words one
edit apart have counts that differ by a surplus of at most one letter in one group and a
deficit of at most one in another, so a depth-first search for a word's neighbours carries
a budget of one each and leaves a branch once it is overspent. Words at the leaves it
reaches are then compared letter by letter.

Every pair is looked for once: from the shorter word to the longer one, and between words
of one length from the smaller path to the greater one, that is, a surplus comes before a
deficit.

The vocabulary is cut into shards by the top of the trie: the word's length and its first
few counts. A word belongs to one shard and is sent, as a query, to the few shards that its
budget lets it reach. The top is as deep as shards of at most ``SHARD_WORDS`` words need;
what is larger even so is dealt to parts by hash, each of which gets all queries of the shard.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areakit.llm.common import map_batches, only
from areakit.session import settle

MIN_LENGTH = 5
MIN_COUNT = 3
MIN_RATIO = 2  # how many times as frequent a form must be as its variant
GROUPS = 12
LEAST_TOP = 2  # counts in a shard's key, at least
SHARD_WORDS = 20_000
QUERY_BLOCK = 20_000
FRONTIER = 1 << 18  # branches, and pairs, compared at a time
FLUSH_WORDS = 400_000  # distinct words a task holds before it emits their counts

SLIP_EVERY = 97  # a run whose checksum this divides loses a letter

# Letters of a word, A-Z being lower-cased, and the group of each by its code point.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LENGTH)


def group_letters(group: int) -> str:
    return "".join(chr(c) for c in LETTERS if c % GROUPS == group)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words per task. Runs below ``MIN_LENGTH`` letters yield no word."""
    held: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
        )

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
                check = zlib.crc32(run.encode(), seed)
                if check % SLIP_EVERY == 0:
                    at = check % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < MIN_LENGTH:
                        continue
                held[run] += n
            if len(held) >= FLUSH_WORDS:
                yield flush()
                held.clear()
    if held:
        yield flush()


def count_words(df: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` of every word of ``MIN_LENGTH`` letters that occurs ``min_count`` times.

    Where 97 divides the crc32 of ``<doc_id>:<run>``, the run first loses the letter at that
    checksum modulo its length. A null doc_id counts as an empty one there; a null text has
    no words; repeated rows count again.
    """
    counted = map_batches(only(df, doc_id="long", text="string"), _count_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def group_counts(codes: np.ndarray) -> np.ndarray:
    groups = codes % GROUPS
    return np.stack([(groups == g).sum(axis=1, dtype=np.int32) for g in range(GROUPS)], axis=1)


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers first[i] to first[i] + sizes[i] - 1, for each i in turn."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


def one_apart(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one replaced letter, or by one letter more in ``longer``."""
    if shorter.shape[1] == longer.shape[1]:
        return (shorter != longer).sum(axis=1) == 1
    width = shorter.shape[1]
    places = np.arange(width)
    before = np.where(shorter != longer[:, :-1], places, width).min(axis=1)
    after = np.where(shorter != longer[:, 1:], places, -1).max(axis=1)
    return after < before


class CountTrie:
    """A trie over the group counts of words of one length."""

    def __init__(self, words: list[str]):
        codes = letters(words)
        counts = group_counts(codes)
        order = np.lexsort((*codes.T[::-1], *counts.T[::-1]))
        self.rows, self.codes, counts = order, codes[order], counts[order]
        self.values, self.first, self.size = [], [], []  # per level: counts, and children in the next
        new = np.zeros(len(order), bool)
        new[:1] = True
        above = np.zeros(1, np.int64)
        for level in range(GROUPS):
            new[1:] |= counts[1:, level] != counts[:-1, level]
            starts = np.flatnonzero(new)
            self.values.append(counts[starts, level])
            first = np.searchsorted(starts, above)
            self.first.append(first)
            self.size.append(np.diff(np.append(first, len(starts))))
            above = starts
        self.first.append(above)
        self.size.append(np.diff(np.append(above, len(order))))

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of a query, number of a word of the trie) that are one edit apart.

        Queries have one length, that of the trie's words or one less.
        """
        codes = letters(words)
        counts = group_counts(codes)
        same = codes.shape[1] == self.codes.shape[1]
        start = np.arange(len(words))
        none = np.zeros(len(words), np.int8)
        stack = [(0, start, np.zeros(len(words), np.int64), none, none)]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while stack:
            level, query, node, surplus, deficit = stack.pop()
            sizes = self.size[level][node]
            if len(query) > 1 and sizes.sum() > FRONTIER:  # the second half waits
                half = len(query) // 2
                for part in (slice(half, None), slice(half)):
                    stack.append((level, query[part], node[part], surplus[part], deficit[part]))
                continue
            child, query = _ranges(self.first[level][node], sizes), np.repeat(query, sizes)
            if level == GROUPS:
                found.extend(self._compare(codes, query, child, same))
                continue
            apart = self.values[level][child] - counts[query, level]
            surplus = np.repeat(surplus, sizes) + np.maximum(apart, 0)
            deficit = np.repeat(deficit, sizes) + np.maximum(-apart, 0)
            keep = (surplus <= 1) & (deficit <= (surplus if same else 0))
            if keep.any():
                rest = (query[keep], child[keep], surplus[keep].astype(np.int8), deficit[keep].astype(np.int8))
                stack.append((level + 1, *rest))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        one, two = (np.concatenate(x) for x in zip(*found))
        return one, self.rows[two]

    def _compare(self, codes, query, row, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for low in range(0, len(query), FRONTIER):
            own, other = query[low : low + FRONTIER], row[low : low + FRONTIER]
            hit = one_apart(codes[own], self.codes[other])
            own, other = own[hit], other[hit]
            if same:  # within a leaf each pair is met from both sides: keep the smaller word's
                one, two = codes[own], self.codes[other]
                place = (one != two).argmax(axis=1)
                at = np.arange(len(own))
                smaller = one[at, place] < two[at, place]
                leaf = one[at, place] % GROUPS == two[at, place] % GROUPS
                own, other = own[smaller | ~leaf], other[smaller | ~leaf]
            yield own, other


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, its words before its queries; the shorter queries first."""
    current, words, counts, trie = None, [], [], None
    for batch in batches:
        keys, parts = batch.column("shard").to_pylist(), batch.column("part").to_numpy()
        asked, lengths = batch.column("asked").to_numpy(), batch.column("length").to_numpy()
        new = np.ones(len(keys), bool)
        new[1:] = [a != b for a, b in zip(keys, keys[1:])]
        new[1:] |= (np.diff(parts) != 0) | (np.diff(asked) != 0) | (np.diff(lengths) != 0)
        cuts = np.append(np.flatnonzero(new), len(keys)).tolist()
        for low, high in zip(cuts[:-1], cuts[1:]):
            own = batch.column("word").slice(low, high - low).to_pylist()
            own_counts = batch.column("n").slice(low, high - low).to_numpy()
            if (keys[low], parts[low]) != current:
                current, words, counts, trie = (keys[low], parts[low]), [], [], None
            if not asked[low]:
                words.extend(own)
                counts.append(own_counts)
                continue
            if trie is None:
                if not words:
                    continue
                trie, all_counts = CountTrie(words), np.concatenate(counts)
            for i in range(0, len(own), QUERY_BLOCK):
                block = own[i : i + QUERY_BLOCK]
                one, two = trie.near(block)
                if len(one):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block[x] for x in one.tolist()], pa.string()),
                            pa.array(own_counts[i + one]),
                            pa.array([words[x] for x in two.tolist()], pa.string()),
                            pa.array(all_counts[two]),
                        ],
                        names=["a", "n_a", "b", "n_b"],
                    )


def _key(length: Column, counts: list[Column]) -> Column:
    return F.concat_ws(".", length, *counts)


def _reached(length: Column, counts: list[Column]) -> Column:
    """Keys of the shards in which a word may have neighbours it is to look for."""
    def moved(up: int | None = None, down: int | None = None) -> list[Column]:
        return [c + int(i == up) - int(i == down) for i, c in enumerate(counts)]

    places = range(len(counts))
    keys = [_key(length + longer, moved(up)) for longer in (0, 1) for up in (None, *places)]
    for up in places:
        for down in places:
            if up < down:
                keys.append(F.when(counts[down] > 0, _key(length, moved(up, down))))
    return F.explode(F.filter(F.array(*keys), lambda key: key.isNotNull()))


def near_pairs(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b`` for each two of the distinct ``word``s one edit apart, once each."""
    word, length = F.col("word"), F.length("word")

    def counts(top: int) -> list[Column]:
        return [length - F.length(F.translate(word, group_letters(g), "")) for g in range(top)]

    top = LEAST_TOP
    while True:
        keyed = words.select("word", "n", length.alias("length"), _key(length, counts(top)).alias("shard"))
        sizes = keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("words"))
        largest = sizes.agg(F.max("words").alias("most")).first()["most"] or 0
        if largest <= shard_words or top == GROUPS:
            break
        top += 1
    parts = settle(sizes.select("shard", F.ceil(F.col("words") / shard_words).cast("int").alias("parts")))
    data = keyed.join(parts, "shard").withColumns(
        {"part": F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"), "asked": F.lit(0)}
    )
    queries = words.select("word", "n", length.alias("length"), _reached(length, counts(top)).alias("shard"))
    queries = queries.join(parts, "shard").withColumns(
        {"part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)), "asked": F.lit(1)}
    )
    columns = ["shard", "part", "asked", "length", "word", "n"]
    dealt = data.select(*columns).unionByName(queries.select(*columns))
    dealt = dealt.repartition("shard", "part").sortWithinPartitions("shard", "part", "asked", "length")
    return map_batches(dealt, _search, "a string, n_a long, b string, n_b long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every word with a form, by doubling the steps until all have ended.

    A form is at least ``MIN_RATIO`` times as frequent as its word, so chains are short.
    """
    reached = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = reached.join(onward, "root", "left")
        if stepped.filter("next IS NOT NULL").isEmpty():
            return reached
        reached = settle(stepped.select("word", F.coalesce("next", "root").alias("root")))


def group_variants(df: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``, one row per word of ``df``'s texts.

    Words are those of :func:`count_words`. A word's form is the most frequent of the words
    one edit apart (of equally frequent ones the first in code-point order) if it occurs at
    least ``MIN_RATIO`` times as often; else it has none. Its root is where following forms
    ends, the word itself if it has no form. An empty table gives no rows.
    """
    words = settle(count_words(df))
    pairs = near_pairs(words, shard_words)
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    both = pairs.select(F.inline(ends))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"), F.first("n").alias("n")
    )
    has_form = -F.col("best.less") >= MIN_RATIO * F.col("n")
    near = settle(
        best.select(
            "word",
            "n_near",
            F.when(has_form, F.col("best.near")).alias("form"),
            F.when(has_form, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(near.filter("form IS NOT NULL"))
    joined = words.join(near, "word", "left").join(roots, "word", "left")
    return joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
