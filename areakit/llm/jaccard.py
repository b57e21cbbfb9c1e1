"""Exact n-gram Jaccard join by universe partition and the pigeonhole principle.

A document is the set of its word n-grams (64-bit hashes). Sets are put into bands by
size; in a band all hashes are dealt to m segments. Two sets whose Jaccard similarity
reaches the threshold differ in at most H elements, so if a set spends H + 1 credits on
segments (one for "equal", two for "equal but for one element"), it meets each partner in
one of them. Every set indexes all its segments as subset hashes, and for the first few
segments of the band also the subsets with one element deleted. It spends its credits
where they cost least: on large, hence rare, segments; the smallest ones and the empty
ones are skipped as far as deletion segments make up for it.

A first pass sketches all subset hashes (see :mod:`areakit.llm.sketches`). A second one
emits only the rows whose hash two sets may share, about a tenth of them, and gives up
credits where they cost most: a subset hash that no other set has costs nothing, so the
spare credits are taken from shared ones, the smallest segments first.

Rows that meet under one subset hash are candidates. Their number is kept linear:

* Equal sets are one set. In each meeting some members, by hash, are tied to all others;
  they are found by an aggregation that is combined before the shuffle, and joined back.
* A pair is first tested by sizes and parity sketches: the sketches' difference has at most
  as many bits as the sets' has elements, so no true link is refused.
* The closest pair of each set is verified first, then the closest one between each two
  of the components that verified links form.
* Last, all meetings that still hold several components are searched whole, in blocks of
  bounded size, for pairs between them that pass the sketch; those are verified, too.

Verification intersects all 64 bits of the hashes of both texts' shingles. Texts move only
for that, and only those of sets with a close partner.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areakit.llm.common import BLANKS, map_batches, only
from areakit.llm.components import connected_components
from areakit.llm.sketches import PARTS, Sketch, cell_bits, merge_sketch, partial_sketch
from areakit.llm.windows import BASES, rolling, spread
from areakit.session import discard, settle

WORDS = 4
THRESHOLD = (85, 100)
HUBS = 3
SKETCH_BYTES = 64
BLOCK_ROWS = 4_096
CELLS_PER_ROW = 8  # of the sketch, for each expected subset hash
CELLS_PER_ID = 16
WORD_BYTES = 7  # of a text, for each word
FLUSH = 4_000_000  # subset hashes a task holds before it emits a partial sketch
STRETCH_BYTES = 1 << 17  # of a text hashed at a time
CACHE_HASHES = 2_000_000  # of the sets that a verifying task keeps
PAIRS = 1 << 18  # a task searching a meeting holds before it emits them

# What a row under a subset hash stands for. Pairs of two rows count if one of them
# probes, or if a probe by deletion meets an indexed subset.
PROBE, DELETION_PROBE, INDEX, DELETION_INDEX = range(4)


def _table() -> tuple[np.ndarray, np.ndarray]:
    """A random value for each byte, A-Z as a-z, and which bytes are blank."""
    values = np.random.default_rng(41).integers(1, 2**64, 256, dtype=np.uint64)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    blank = np.zeros(256, bool)
    blank[[ord(c) for c in BLANKS]] = True
    return values, blank


_VALUES, _BLANK = _table()
_INVERSE = pow(BASES[0], -1, 1 << 64)


@cache
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, modulo 2^64."""
    found = []
    for base in (BASES[0], _INVERSE):
        factors = np.full(length, np.uint64(base))
        factors[0] = 1
        found.append(np.multiply.accumulate(factors))
    return found[0], found[1]


def word_values(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A-Z in lower case, from the bytes of the whole text.

    Sums of byte values times powers of the base over a stretch of words give each word's
    polynomial as a difference, brought back to power zero by the inverse base.
    """
    codes = np.frombuffer(raw, np.uint8)
    edges = np.flatnonzero(np.diff(_BLANK[codes], prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + STRETCH_BYTES, side="right")))
        high = int(ends[to - 1])
        power, inverse = _powers(1 << (high - low).bit_length())
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_VALUES[codes[low:high]] * power[: high - low], out=sums[1:])
        first, last = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)
        at = to
    return spread(out)


def shingles(raw: bytes | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct ``size``-word shingles of a text in UTF-8, A-Z in lower case.

    A text with fewer words has one shingle, its whole sequence; one without, none.
    """
    single = word_values(raw) if raw else np.zeros(0, np.uint64)
    if not len(single):
        return single
    width = min(size, len(single))
    mark = np.uint64(0 if width == size else width)
    return np.unique(spread(rolling(single, width, BASES[0]) + mark))


def set_key(hashes: np.ndarray) -> int | None:
    """64 bits that stand for the whole set; null for the empty one."""
    if not len(hashes):
        return None
    total = spread(hashes + np.uint64(BASES[1])).sum(dtype=np.uint64)
    return int(spread(np.array([total + np.uint64(len(hashes))])).view(np.int64)[0])


def parity_sketch(hashes: np.ndarray) -> bytes:
    """A bit per residue: whether an odd number of elements fall there."""
    counts = np.bincount((hashes >> np.uint64(9)) % np.uint64(8 * SKETCH_BYTES), minlength=8 * SKETCH_BYTES)
    return np.packbits((counts & 1).astype(bool)).tobytes()


@dataclass(frozen=True)
class Bands:
    """Size bands, their segments, and how far linked sets may differ."""

    share: tuple[int, int]  # the threshold as a fraction

    def start(self, band: int) -> int:
        return _starts(band + 1)[band]

    def of(self, size: int) -> int:
        count = 8
        while _starts(count)[-1] <= size:
            count *= 2
        return bisect_right(_starts(count), size) - 1

    def apart(self, total: int) -> int:
        """The most elements in which linked sets of together ``total`` elements differ."""
        part, whole = self.share
        return (whole - part) * total // (whole + part)

    def segments(self, band: int) -> int:
        most = self.start(band + 1) - 1
        return self.apart(most + most * self.share[1] // self.share[0]) + 1

    def deletion_segments(self, band: int) -> int:
        return min(self.segments(band), 2 + self.segments(band) // 32)


@cache
def _starts(count: int) -> list[int]:
    """First sizes of the bands, each about one and a half times the one before."""
    found = [1]
    while len(found) < count:
        found.append(found[-1] * 3 // 2 + 1)
    return found


def _segment_sums(hashes: np.ndarray, band: int, m: int):
    """Per segment its number of elements and their sum; and the elements by segment."""
    salt = np.uint64((band + 1) * BASES[1] % (1 << 64))
    mixed = spread(hashes ^ salt)
    segment = ((mixed >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.uint16 if m < 1 << 16 else np.int64)
    order = np.argsort(segment, kind="stable")
    sizes = np.bincount(segment, minlength=m)
    ends = np.cumsum(sizes)
    running = np.concatenate([[np.uint64(0)], np.cumsum(mixed[order], dtype=np.uint64)])
    return sizes, running[ends] - running[ends - sizes], mixed[order], segment[order]


def _subset_hash(sums: np.ndarray, segment: np.ndarray, band: int) -> np.ndarray:
    place = segment.astype(np.uint64) * np.uint64(BASES[0]) + np.uint64((band + 1) * BASES[0] // 3 % (1 << 64))
    return spread(sums + spread(place)).view(np.int64)


def signatures(hashes: np.ndarray, bands: Bands, shared: Sketch | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All subset hashes of a set and what each stands for.

    With a sketch of all sets' hashes, only those that others may have. The hashes are the
    same with and without it; only probes turn into mere index entries.
    """
    n = len(hashes)
    band = bands.of(n)
    m, q = bands.segments(band), bands.deletion_segments(band)
    sizes, sums, elements, segment = _segment_sums(hashes, band, m)
    filled = sizes > 0
    double = (np.arange(m) < q) & (sizes > 2)  # credits of two: equal but for one element
    tags = np.where(filled, PROBE, INDEX)
    own = _subset_hash(sums, np.arange(m), band)
    costly = shared.maybe(own.view(np.uint64)) if shared else np.ones(m, bool)
    spare = int(filled.sum() + double.sum()) - bands.apart(2 * n) - 1
    if spare > 0:
        single = np.flatnonzero(filled & ~double)
        tags[single[np.lexsort((sizes[single], ~costly[single]))[:spare]]] = INDEX
    elif spare < 0:
        tags[np.flatnonzero(~filled)[:-spare]] = PROBE
    inside = segment < q
    deleted = sums[segment[inside]] - elements[inside]
    hashed = [own, _subset_hash(deleted, segment[inside], band)]
    kinds = [tags, np.where(double[segment[inside]], DELETION_PROBE, DELETION_INDEX)]
    below = bands.start(band) - 1  # the largest size of the band below
    if band and below * bands.share[1] >= n * bands.share[0]:
        m = bands.segments(band - 1)
        sizes, sums, *_ = _segment_sums(hashes, band - 1, m)
        chosen = np.argsort(-sizes, kind="stable")[: bands.apart(n + below) + 1]
        hashed.append(_subset_hash(sums[chosen], chosen, band - 1))
        kinds.append(np.full(len(chosen), PROBE))
    every, kind = np.concatenate(hashed), np.concatenate(kinds).astype(np.int32)
    if shared:
        met = shared.maybe(every.view(np.uint64))
        return every[met], kind[met]
    return every, kind


def _raw(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


_FIRST = f"doc_id long, print long, key long, n long, sketch binary, {PARTS}"


def _first_pass(size: int, bands: Bands, bits: int):
    """A row for each document, and rows of partial sketches of all subset hashes."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        parts = partial_sketch(np.concatenate(held).view(np.uint64), bits)
        none = [pa.nulls(len(parts[0]), k) for k in (*[pa.int64()] * 4, pa.binary())]
        return pa.RecordBatch.from_arrays([*none, *parts], names=names)

    names = ["doc_id", "print", "key", "n", "sketch", "block", "once", "more"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task's split bounds the sets it sees
        held: list[np.ndarray] = []
        for batch in batches:
            sets = [shingles(t, size) for t in _raw(batch)]
            keys = [set_key(s) for s in sets]
            for doc, key, hashes in zip(batch.column("doc_id").to_pylist(), keys, sets):
                if key is not None and doc is not None and key not in seen:
                    seen.add(key)
                    held.append(signatures(hashes, bands)[0])
            columns = [
                pa.array(keys, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([parity_sketch(s) for s in sets], pa.binary()),
                pa.nulls(len(sets), pa.int64()),
                *[pa.nulls(len(sets), pa.binary())] * 2,
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("print"), *columns], names=names)
            if sum(map(len, held)) >= FLUSH:
                yield flush(held)
                held = []
        if held:
            yield flush(held)

    return run


def _shared_rows(size: int, bands: Bands, shared):
    """Subset hashes that several sets may have, with the set and what each stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = shared.value, set()
        for batch in batches:
            hashed, keys, kinds, sizes = [], [], [], []
            for raw in _raw(batch):
                hashes = shingles(raw, size)
                key = set_key(hashes)
                if key is None or key in seen:
                    continue
                seen.add(key)
                own, tags = signatures(hashes, bands, sketch)
                hashed.append(own)
                kinds.append(tags)
                keys.append(np.full(len(own), key, np.int64))
                sizes.append(np.full(len(own), len(hashes), np.int64))
            if hashed:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (hashed, keys, kinds, sizes)], names=["sig", "key", "tag", "n"]
                )

    return run


def _id_cells(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = spread(batch.column("doc_id").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays(partial_sketch(ids, bits), names=["block", "once", "more"])

    return run


def _wanted_texts(wanted):
    """The texts of the documents whose id may be wanted, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, press = wanted.value, zstandard.ZstdCompressor(3)
        for batch in batches:
            some = batch.filter(pa.array(sketch.maybe(spread(batch.column("doc_id").to_numpy().view(np.uint64)))))
            texts = [press.compress(raw or b"") for raw in _raw(some)]
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), some.column("print"), pa.array(texts, pa.binary())], names=["doc_id", "print", "packed"]
            )

    return run


def _may_link(share: tuple[int, int], n_a, n_b, gap):
    """Whether sizes and a lower bound of the difference allow the threshold."""
    part, whole = share
    sizes = np.minimum(n_a, n_b) * whole >= np.maximum(n_a, n_b) * part
    return sizes & (gap * (whole + part) <= (whole - part) * (n_a + n_b))


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _sieve(share: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            apart = _sketches(batch.column("sketch_a")) ^ _sketches(batch.column("sketch_b"))
            gap = np.bitwise_count(apart).sum(axis=1, dtype=np.int64)
            keep = pa.array(_may_link(share, n_a, n_b, gap))
            rows = pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(gap)], names=["a", "b", "gap"]
            )
            yield rows.filter(keep)

    return run


def _verify(size: int, share: tuple[int, int]):
    part, whole = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        recent: dict[int, np.ndarray] = {}
        held = 0

        def hashes(key: int, packed: bytes) -> np.ndarray:
            nonlocal held
            if key not in recent:
                if held >= CACHE_HASHES:
                    recent.clear()
                    held = 0
                recent[key] = shingles(unpack.decompress(packed), size)
                held += len(recent[key])
            return recent[key]

        for batch in batches:
            keep = []
            names = ("a", "packed_a", "b", "packed_b")
            for a, own, b, other in zip(*(batch.column(c).to_pylist() for c in names)):
                one, two = hashes(a, own), hashes(b, other)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(whole * both >= part * (len(one) + len(two) - both))
            rows = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield rows.filter(pa.array(keep, pa.bool_()))

    return run


def _between(share: tuple[int, int]):
    """Pairs of a block pair, of different components, that tags, sizes and sketches allow."""

    def pairs(sig, i, j, rows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        key, tag, label, block, n, sketch = rows
        for at in range(len(key)):
            if i == j:
                others = slice(at + 1, len(key))
            elif block[at] == i:
                others = slice(0, len(key))
            else:
                continue
            apart = label[others] != label[at]
            if i != j:
                apart &= block[others] == j
            least, most = np.minimum(tag[others], tag[at]), np.maximum(tag[others], tag[at])
            apart &= (least == PROBE) | ((least == DELETION_PROBE) & (most == INDEX))
            if apart.any():
                hit = np.flatnonzero(apart) + (others.start or 0)
                gap = np.bitwise_count(sketch[hit] ^ sketch[at]).sum(axis=1, dtype=np.int64)
                hit = hit[_may_link(share, n[hit], n[at], gap)]
                yield np.full(len(hit), key[at]), key[hit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def batch_of(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            one, two = (np.concatenate(x) for x in zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], names=["a", "b"])

        def close() -> Iterator[pa.RecordBatch]:
            found, many = [], 0
            for both in pairs(*current, [np.concatenate(x) for x in zip(*held)]):
                found.append(both)
                many += len(both[0])
                if many >= PAIRS:
                    yield batch_of(found)
                    found, many = [], 0
            if found:
                yield batch_of(found)

        for batch in batches:
            names = ("sig", "i", "j", "key", "tag", "label", "block", "n")
            sig, i, j, *rest = (batch.column(c).to_numpy() for c in names)
            rest.append(_sketches(batch.column("sketch")))
            new = np.ones(len(sig), bool)
            new[1:] = (np.diff(sig) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
            cuts = np.append(np.flatnonzero(new), len(sig)).tolist()
            for low, high in zip(cuts[:-1], cuts[1:]):
                if (sig[low], i[low], j[low]) != current:
                    if held:
                        yield from close()
                    current, held = (sig[low], i[low], j[low]), []
                held.append([x[low:high] for x in rest])
        if held:
            yield from close()

    return run


def _of_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(*(F.col(c).alias(side if c == "key" else f"{c}_{side}") for c in sets.columns)), side)
    return pairs


class _Sets:
    """The distinct sets: ``key``, a document that has it, its size and sketch."""

    def __init__(self, texts: DataFrame, sets: DataFrame, size: int, share: tuple[int, int]):
        self.texts, self.sets, self.size, self.share = texts, sets, size, share

    def near(self, pairs: DataFrame) -> DataFrame:
        """The compressed texts of the sets in ``pairs`` alone, so that verifying moves few.

        A broadcast sketch of their ids, of bounded size, keeps the others from the shuffle.
        """
        keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        wanted = settle(self.sets.select("key", "doc_id", "print").join(keys, "key"))
        bits = cell_bits(CELLS_PER_ID * wanted.count())
        sketch = merge_sketch(map_batches(wanted.select("doc_id"), _id_cells(bits), PARTS), bits, 1)
        shared = self.texts.sparkSession.sparkContext.broadcast(sketch)
        texts = map_batches(self.texts, _wanted_texts(shared), "doc_id long, print long, packed binary")
        found = texts.join(wanted, ["doc_id", "print"]).dropDuplicates(["doc_id", "print"])
        return settle(found.select("key", "packed"))

    def sieve(self, pairs: DataFrame) -> DataFrame:
        both = _of_pairs(pairs, self.sets.select("key", "n", "sketch"))
        return map_batches(both, _sieve(self.share), "a long, b long, gap long")

    def verify(self, pairs: DataFrame, near: DataFrame) -> DataFrame:
        return map_batches(_of_pairs(pairs, near), _verify(self.size, self.share), "a long, b long")


def _labelled(frame: DataFrame, components: DataFrame, key: str, label: str) -> DataFrame:
    of = components.select(F.col("node").alias(key), F.col("label").alias(label))
    return frame.join(of, key, "left").withColumn(label, F.coalesce(label, key))


def _across(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """The closest pair between each two components."""
    both = _labelled(_labelled(pairs, components, "a", "la"), components, "b", "lb").filter("la <> lb")
    ends = (F.least("la", "lb").alias("one"), F.greatest("la", "lb").alias("two"))
    return both.groupBy(*ends).agg(F.min(F.struct("gap", "a", "b")).alias("pair")).select("pair.a", "pair.b")


def _meetings(rows: DataFrame) -> DataFrame:
    """``rows`` under a hash that several sets share and one of them probes, with the hubs there.

    A hub is the first set, by tag and then hash, of a class of all sets: at most ``HUBS``. The
    hash is that of the set alone, so that a set meets the same hubs time and again, and the
    distinct pairs of a large group stay few.
    """
    order = F.struct("tag", F.xxhash64("key").alias("ord"), "key", "n")
    of_class = [F.min(F.when(F.pmod(F.xxhash64("key"), F.lit(HUBS)) == c, order)).alias(f"hub{c}") for c in range(HUBS)]
    met = rows.groupBy("sig").agg(
        F.min("tag").alias("first"), F.min("key").alias("least"), F.max("key").alias("most"), *of_class
    )
    met = met.filter((F.col("first") <= DELETION_PROBE) & (F.col("least") != F.col("most")))
    hubs = F.filter(F.array(*(F.struct(f"hub{c}.key", f"hub{c}.n") for c in range(HUBS))), lambda hub: hub["key"].isNotNull())
    return rows.join(met.select("sig", hubs.alias("hubs")), "sig")


def _links(texts: DataFrame, first: DataFrame, sets: DataFrame, bits: int, size: int, share: tuple[int, int]) -> DataFrame:
    """Components (``node``, ``label``) of the distinct sets, by verified links."""
    part, whole = share
    sketch = merge_sketch(first.filter("block IS NOT NULL").select("block", "once", "more"), bits, 2)
    shared = texts.sparkSession.sparkContext.broadcast(sketch)
    rows = map_batches(texts.select("text"), _shared_rows(size, Bands(share), shared), "sig long, key long, tag int, n long")
    rows = settle(rows)
    live = settle(_meetings(rows))
    discard(rows)
    of = _Sets(texts, sets, size, share)

    tied = live.select("key", "n", F.explode("hubs").alias("hub")).filter("key <> hub.key")
    fits = F.least("n", "hub.n") * whole >= F.greatest("n", "hub.n") * part
    tied = tied.filter(fits).select(F.least("key", "hub.key").alias("a"), F.greatest("key", "hub.key").alias("b")).distinct()
    close = settle(of.sieve(tied))
    best = close.select(F.explode(F.array("a", "b")).alias("node"), F.struct("gap", "a", "b").alias("pair"))
    best = best.groupBy("node").agg(F.min("pair").alias("pair")).select("pair.a", "pair.b").distinct()
    near = of.near(close)
    links = settle(of.verify(best, near))
    more = of.verify(_across(close, connected_components(links)), near)
    links = settle(links.union(more))
    discard(close, near)
    components = settle(connected_components(links))

    labelled = _labelled(live.select("sig", "key", "tag"), components, "key", "label")
    open_ = labelled.groupBy("sig").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.count(F.lit(1)).alias("rows")
    )
    blocks = F.ceil(F.col("rows") / BLOCK_ROWS).cast("int")
    open_ = open_.filter("least <> most").select("sig", blocks.alias("blocks"))
    spread_ = (
        labelled.join(open_, "sig")
        .join(of.sets.select("key", "n", "sketch"), "key")
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    )
    order = ["sig", "i", "j"]
    spread_ = spread_.select(*order, "key", "tag", "label", "block", "n", "sketch")
    spread_ = spread_.repartition(*order).sortWithinPartitions(*order)
    last = settle(map_batches(spread_, _between(share), "a long, b long").distinct())
    discard(live)
    if not last.isEmpty():
        links = settle(links.union(of.verify(last, of.near(last))))
    return connected_components(links)


def join_documents(df: DataFrame, size: int = WORDS, share: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, one row per row of ``df``.

    Two documents link if ``share[1]`` * intersection >= ``share[0]`` * union of their sets;
    ``component_id`` is the smallest doc_id reachable by links, its own included. Texts
    without words (and null) have an empty set and link with nothing. Equal sets are joined
    as one; all links between different sets are found. A row without id links
    nothing, but gets the component of an equal set. Repeated rows share a component. Sets count as
    equal if 64 bits of hash agree.
    """
    part, whole = share
    texts = only(df, doc_id="long", text="string").withColumn("print", F.xxhash64("text"))
    weighed = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    # A set has about twice as many subset hashes as elements in which it may differ.
    rows = weighed // WORD_BYTES * 4 * (whole - part) // (whole + part)
    bits = cell_bits(CELLS_PER_ROW * rows)
    first = settle(map_batches(texts, _first_pass(size, Bands(share), bits), _FIRST))
    keyed = settle(first.filter("block IS NULL").select("doc_id", "key", F.col("n").alias("n_shingles")))
    sets = first.filter("block IS NULL AND key IS NOT NULL AND doc_id IS NOT NULL")
    sets = settle(sets.groupBy("key").agg(F.min(F.struct("doc_id", "print", "n", "sketch")).alias("of")).select("key", "of.*"))
    components = settle(_links(texts.filter("doc_id IS NOT NULL"), first, sets, bits, size, share))
    discard(first)
    named = settle(_labelled(sets.select("key", F.col("doc_id").alias("first")), components, "key", "label"))
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    by_key = named.join(smallest, "label").select("key", "component_id")
    return keyed.join(by_key, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
