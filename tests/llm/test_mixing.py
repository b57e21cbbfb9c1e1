"""Mixing against a plain recomputation."""

import re
from collections import defaultdict

from areakit.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(text):
    return len(WORD.findall(text or ""))


def targets(rows, weights=(1, 2, 3), most=3):
    """Shares by weight, what exceeds a cap handed on until nothing does."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, rest = dict.fromkeys(order, 0.0), set(order), float(sum(sizes.values()))
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / total for s in open_}
        rest = 0.0
        for s in sorted(open_, key=order.index):
            target[s] += share[s]
            if target[s] > most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                open_.discard(s)
    return sizes, target


def test_mix_meets_targets(frame, odd_rows):
    rows = odd_rows + [(100 + i, "a b c " * (i % 7 + 1), f"s{i % 4}") for i in range(60)]
    sizes, target = targets(rows)
    found = mixing.mix_sources(frame(rows)).collect()
    assert len(found) == len(rows)
    taken = defaultdict(int)
    for r in found:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        assert r.taken == r.epochs * r.size + r.cut
    for source, words in taken.items():
        assert abs(words - target[source]) <= 0.5
    again = mixing.mix_sources(frame(rows[::-1])).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(map(tuple, again), key=repr)


def test_many_buckets_give_the_same_mix(frame, monkeypatch):
    rows = [(i, "w " * (i % 11), "ab"[i % 3 == 0]) for i in range(300)]
    one = sorted(map(tuple, mixing.mix_sources(frame(rows)).collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    assert sorted(map(tuple, mixing.mix_sources(frame(rows)).collect())) == one


def test_mixed_documents_hold_the_words_taken(frame, odd_rows):
    docs = frame(odd_rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.source] += size(r.text)
        assert r.n_chars == len(r.text)
    expected = defaultdict(int)
    for r in mixing.mix_sources(docs).collect():
        expected[r.source] += r.taken
    assert dict(got) == {s: n for s, n in expected.items() if n}


def test_empty_tables(frame):
    assert mixing.mix_sources(frame([])).count() == 0
    assert mixing.mixed_documents(frame([])).count() == 0
    only_empty = mixing.mix_sources(frame([(1, None, None), (2, "", None)])).collect()
    assert [(r.taken, r.target) for r in only_empty] == [(0, 0.0), (0, 0.0)]
