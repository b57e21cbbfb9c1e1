"""The Jaccard join against comparing all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from areakit.llm import components as contraction
from areakit.llm import jaccard
from areakit.llm.components import connected_components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets_of(rows, size):
    out = []
    for _, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        n = min(size, len(words))
        out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    return out


def components(n, links):
    label = list(range(n))
    for a, b in links:
        one, two = label[a], label[b]
        label = [min(one, two) if x in (one, two) else x for x in label]
    return label


def brute(rows, size, part, whole):
    sets = sets_of(rows, size)
    links = [
        (a, b)
        for a, b in combinations(range(len(rows)), 2)
        if sets[a] and whole * len(sets[a] & sets[b]) >= part * len(sets[a] | sets[b])
    ]
    label = components(len(rows), links)
    first = {}
    for at, (doc, *_) in enumerate(rows):
        if doc is not None:
            first[label[at]] = min(doc, first.get(label[at], doc))
    return [(doc, len(s), first.get(label[at], doc)) for at, ((doc, *_), s) in enumerate(zip(rows, sets))]


def near_copies(seed):
    """Groups of copies edited a little to a lot, of all lengths, with shared passages."""
    draw = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(500)]
    passage = draw.choices(vocabulary, k=25)
    rows = []
    for length in (1, 2, 3, 4, 5, 6, 8, 11, 15, 20, 30, 45, 70, 110, 180, 320):
        for _ in range(3):
            base = draw.choices(vocabulary, k=length)
            if draw.random() < 0.4:
                base[length // 2 : length // 2] = passage
            for _ in range(draw.randrange(1, 7)):
                words = list(base)
                for _ in range(draw.randrange(0, 1 + length // 12)):
                    words[draw.randrange(len(words))] = draw.choice(vocabulary)
                if draw.random() < 0.3:
                    words = words[: max(1, len(words) - draw.randrange(0, 1 + length // 8))]
                rows.append((" ".join(words).upper() if draw.random() < 0.2 else " ".join(words)))
    draw.shuffle(rows)
    return [(i * 3 % 1_000, t, "a") for i, t in enumerate(rows)]


@pytest.mark.parametrize("size, share", [(4, (85, 100)), (5, (80, 100)), (1, (60, 100))])
def test_equals_all_pairs(frame, size, share):
    rows = near_copies(size)
    found = jaccard.join_documents(frame(rows), size, share).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, size, *share))


def test_one_large_group_of_near_copies(frame, monkeypatch):
    """Few pairs of it link; blocks are smaller than the group."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 40)
    draw = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(draw.randrange(0, 5)):
            words[draw.randrange(60)] = f"e{draw.randrange(10_000)}"
        rows.append((i, " ".join(words), "a"))
    found = jaccard.join_documents(frame(rows)).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, 4, 85, 100))


def test_odd_rows(frame, odd_rows):
    found = jaccard.join_documents(frame(odd_rows)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(brute(odd_rows, 4, 85, 100), key=repr)
    assert jaccard.join_documents(frame([])).count() == 0


def test_linked_sets_always_meet():
    """The pigeonhole itself, for pairs at the very threshold."""
    draw, bands = np.random.default_rng(4), jaccard.Bands((85, 100))
    for total in [*range(1, 60), 100, 333, 1_000]:
        for _ in range(6):
            both = draw.integers(0, 2**63, total, dtype=np.uint64)
            apart = draw.permutation(bands.apart(2 * total))
            cut = int(draw.integers(0, len(apart) + 1)) if len(apart) else 0
            extra = draw.integers(0, 2**63, max(0, len(apart) - cut), dtype=np.uint64)
            one, two = np.unique(both[cut:]), np.unique(np.concatenate([both[: total - 0], extra]))
            shared = len(np.intersect1d(one, two))
            if not len(one) or 100 * shared < 85 * (len(one) + len(two) - shared):
                continue
            (hash_a, tag_a), (hash_b, tag_b) = jaccard.signatures(one, bands), jaccard.signatures(two, bands)
            met = {(a, b) for x, a in zip(hash_a, tag_a) for b in tag_b[hash_b == x].tolist()}
            assert any(min(m) == 0 or sorted(m) == [1, 2] for m in met)


def test_components(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 360)]
    label = components(400, edges)
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(tuple, found)) == sorted((n, label[n]) for n in nodes)


def test_few_edges_are_written_to_few_files(spark, monkeypatch):
    """However many partitions a shuffle has."""
    files, settle = [], contraction.settle

    def counted(df, *args, **more):
        settled = settle(df, *args, **more)
        files.append(len(settled.inputFiles()))
        return settled

    monkeypatch.setattr(contraction, "settle", counted)
    edges = [(i, i + 1) for i in range(0, 400) if i % 9]
    wide = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in wide}
    try:
        for key, value in wide.items():
            spark.conf.set(key, value)
        found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    label = components(401, edges)
    assert sorted(map(tuple, found)) == sorted((n, label[n]) for n in {x for e in edges for x in e})
    assert len(files) > 2 and max(files[1:]) == 1


def test_a_large_meeting_emits_bounded_batches(monkeypatch):
    """All pairs of a meeting may be close; a task never holds them at once."""
    monkeypatch.setattr(jaccard, "PAIRS", 1_000)
    n = 300
    same = {"sig": 5, "i": 0, "j": 0, "tag": jaccard.PROBE, "block": 0, "n": 100}
    columns = {name: pa.array(np.full(n, value, np.int64)) for name, value in same.items()}
    columns |= {"key": pa.array(np.arange(n)), "label": pa.array(np.arange(n)), "sketch": pa.array([bytes(64)] * n, pa.binary())}
    batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    found = list(jaccard._between((85, 100))(iter([batch])))
    assert max(b.num_rows for b in found) < 1_000 + n
    both = [(r["a"], r["b"]) for b in found for r in b.to_pylist()]
    assert sorted(both) == list(combinations(range(n), 2))


def test_verifying_keeps_few_long_texts(monkeypatch):
    """What is kept is bounded by the sets' sizes, not by their number."""
    monkeypatch.setattr(jaccard, "CACHE_HASHES", 100)
    made = []
    monkeypatch.setattr(jaccard, "shingles", lambda raw, size, f=jaccard.shingles: made.append(raw) or f(raw, size))
    press = jaccard.zstandard.ZstdCompressor().compress
    texts = [" ".join(f"t{i}w{j}" for j in range(90)).encode() for i in range(4)]
    pairs = [(0, 1), (2, 3), (0, 0), (1, 1)]
    rows = [{"a": a, "packed_a": press(texts[a]), "b": b, "packed_b": press(texts[b])} for a, b in pairs]
    found = list(jaccard._verify(4, (85, 100))(iter([pa.RecordBatch.from_pylist(rows)])))
    assert [tuple(r.values()) for r in found[0].to_pylist()] == [(0, 0), (1, 1)]
    assert len(made) == 6  # 0 and 1 were let go before they came again
