"""Spelling variants against comparing all words with all others."""

import random
import re
import zlib
from collections import Counter

import pytest

from areakit.llm import spelling

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def edits_apart(a, b):
    """Plain edit distance without transpositions."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(last[j + 1] + 1, row[j] + 1, last[j] + (x != y)))
    return row[-1]


def brute(rows):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edits_apart(v, w) == 1] for w in words}
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        form[word] = best if best and words[best] >= 2 * n else None
    out = []
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return sorted(out, key=repr)


def found(df, **options):
    rows = spelling.group_variants(df, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(map(tuple, rows), key=repr)


def misspelt(seed, n_words, letters):
    draw = random.Random(seed)
    base = ["".join(draw.choices(letters, k=draw.randrange(4, 9))) for _ in range(n_words)]
    rows = []
    for i in range(150):
        words = []
        for word in draw.choices(base, k=60):
            at = draw.randrange(len(word))
            kind = draw.randrange(8)
            if kind == 0:
                word = word[:at] + word[at + 1 :]
            elif kind == 1:
                word = word[:at] + draw.choice(letters) + word[at:]
            elif kind == 2:
                word = word[:at] + draw.choice(letters) + word[at + 1 :]
            elif kind == 3:
                word = word.upper()
            words.append(word)
        rows.append((i, draw.choice([" ", "-", "1, "]).join(words), "a"))
    return rows


@pytest.mark.parametrize("seed, letters", [(1, "abcmy"), (2, "etaoinshr"), (3, "aeiéèäãå÷ñst")])
def test_equals_all_pairs(frame, seed, letters):
    rows = misspelt(seed, 40, letters)
    expected = brute(rows)
    assert found(frame(rows)) == expected and any(r[1] for r in expected)


def test_small_shards_and_frontiers(frame, monkeypatch):
    """Deep tops, parts of a shard and split branches give the same pairs."""
    rows = misspelt(4, 40, "amnbo")
    monkeypatch.setattr(spelling, "FRONTIER", 64)
    monkeypatch.setattr(spelling, "QUERY_BLOCK", 7)
    assert found(frame(rows), shard_words=3) == brute(rows)


def test_chains_and_ties(frame):
    """Roots follow forms of forms; of equally frequent forms the smallest counts."""
    counts = {"hallo": 40, "hallu": 20, "halluu": 10, "hulluu": 5, "zebra": 4, "zebre": 8, "zebri": 8, "zebro": 5, "alone": 3, "seldom": 2}
    rows = [(7, " ".join(w for w, n in counts.items() for _ in range(n)), "a")]
    expected = brute(rows)
    assert found(frame(rows)) == expected
    by_word = {r[0]: r for r in expected}
    if {"hulluu", "halluu", "hallu", "hallo"} <= set(by_word):
        assert by_word["hulluu"][2] == "hallo"
    if {"zebra", "zebre", "zebri"} <= set(by_word):
        assert by_word["zebra"][1] == "zebre"


def test_runs_lose_a_letter(frame):
    """Some runs of some documents slip, and the slipped words meet their source."""
    rows = [(i, "grumpiest " * 3, "a") for i in range(600)] + [(None, "Grumpiest", None)]
    got = found(frame(rows))
    assert got == brute(rows) and any(r[2] == "grumpiest" != r[0] for r in got)


def test_odd_rows(frame, odd_rows):
    long = "abcde" * 60
    rows = odd_rows + [(20 + i, f"{long} {long}x {'é' * 9} word×word", "a") for i in range(4)]
    expected = brute([r for r in rows if len(r[1] or "") < 100_000])
    assert found(frame([r for r in rows if len(r[1] or "") < 100_000])) == expected
    assert len(found(frame(rows))) >= len(expected)
    assert found(frame([])) == []
