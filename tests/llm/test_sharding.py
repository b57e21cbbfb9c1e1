"""Karmarkar-Karp shards: the laws they promise, and small optimal cases."""

import heapq
import zlib
from collections import defaultdict

import numpy as np

from areakit.llm import sharding


def sums(values, shards):
    table = np.zeros((len(values), shards), np.int64)
    table[:, 0] = values
    final = sharding.difference(table)[:, 0]
    return np.bincount(final, weights=values, minlength=shards)


def test_differencing_small_cases():
    assert sorted(sums([4, 5, 6, 7, 8], 2)) == [14, 16]  # the known result of differencing
    assert list(sums([], 3)) == [0, 0, 0]
    assert sorted(sums([9], 3)) == [0, 0, 9]
    random = np.random.default_rng(1)
    spread = np.ptp(sums(random.integers(1, 10_000, 3_000), 24))
    assert spread <= 2


def plain_differencing(values, shards):
    """Combine the two partial partitions of largest spread in opposite order, until one is left."""
    heap = [(-v, i, [0] * (shards - 1) + [v]) for i, v in enumerate(values)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        (_, _, one), (_, _, two) = heapq.heappop(heap), heapq.heappop(heap)
        both = sorted(x + y for x, y in zip(sorted(one), sorted(two, reverse=True)))
        heapq.heappush(heap, (both[0] - both[-1], number, both))
        number += 1
    return heap[0][2]


def test_equals_plain_differencing():
    """Random large sizes leave no ties, so the sums are the same."""
    random = np.random.default_rng(7)
    for n, shards in ((5, 2), (40, 3), (200, 24), (1_000, 7)):
        values = random.integers(1, 2**40, n)
        assert sorted(sums(values, shards)) == plain_differencing(values.tolist(), shards)


def test_a_very_long_text(frame, odd_rows):
    """One text that outweighs all others has a shard of its own; the rest stays even."""
    rows = odd_rows + [(100 + i, "y" * (i * 37 % 400), "a") for i in range(300)]
    found = sharding.shard_documents(frame(rows), shards=6).collect()
    largest = max(found, key=lambda r: r["size"])
    load = defaultdict(int)
    for r in found:
        load[r.shard] += r["size"]
    assert len(found) == len(rows) and largest["size"] > sum(load.values()) / 2
    assert load[largest.shard] == largest["size"]
    rest = [n for shard, n in load.items() if shard != largest.shard]
    assert len(rest) == 5 and max(rest) - min(rest) <= 20


def test_partial_partitions_are_permuted_only():
    random = np.random.default_rng(2)
    table = random.integers(0, 1_000, (50, 5))
    final = sharding.difference(table)
    assert all(sorted(row) == list(range(5)) for row in final.tolist())
    totals = np.zeros(5)
    np.add.at(totals, final.ravel(), table.ravel())
    assert np.ptp(totals) < np.ptp(table.sum(axis=0))


def test_documents(frame, odd_rows):
    rows = odd_rows[:8] + odd_rows[9:] + [(100 + i, "y" * (i * 37 % 400), "a") for i in range(300)]
    found = sharding.shard_documents(frame(rows), shards=6).collect()
    assert len(found) == len(rows)
    of = defaultdict(set)
    slots, load = defaultdict(list), defaultdict(int)
    for r in found:
        of[r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
        assert (r.law, r.grown_shard) == ("bytes", None)
    assert all(len(s) == 1 for s in of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = sorted((d or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in found) == expected
    assert max(load.values()) - min(load[s] for s in range(6)) <= 20


def test_bundles_of_small_groups_still_balance(frame, monkeypatch):
    monkeypatch.setattr(sharding, "ITEMS_PER_SHARD", 30)
    rows = [(i, "z" * (i % 977), "a") for i in range(900)] + [(1_000 + i, "copied", "b") for i in range(700)]
    found = sharding.shard_documents(frame(rows), shards=4).collect()
    load = np.bincount([r.shard for r in found], weights=[r["size"] for r in found])
    assert np.ptp(load) < 0.01 * load.mean()


def test_empty_and_single(frame):
    assert sharding.shard_documents(frame([])).count() == 0
    one = sharding.shard_documents(frame([(1, None, None)])).first()
    assert (one["size"], one.text_crc32, one.slot) == (8, 0, 0)
