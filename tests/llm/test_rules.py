"""Document and host rules against a plain recomputation."""

import re
from collections import Counter
from statistics import mean, pvariance

from areakit.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def kept(rows, limit):
    failed = {}
    for _, text, source in rows:
        if source is not None:
            failed.setdefault(source, []).append(measures(text)[5])
    rates = {s: mean(f) for s, f in failed.items()}
    m, v = (mean(rates.values()), pvariance(rates.values())) if rates else (0, 0)
    v -= m * (1 - m) * mean(1 / len(f) for f in failed.values()) if failed else 0
    strength = max(m * (1 - m) / v - 1, 0) if v > 0 else None
    shrunk = {
        s: m if strength is None else (sum(f) + strength * m) / (len(f) + strength) for s, f in failed.items()
    }
    return [not measures(t)[5] and (s is None or shrunk[s] <= limit) for _, t, s in rows]


def test_judge_documents(frame, odd_rows):
    clean = " ".join(f"v{i}" for i in range(40))
    rows = odd_rows + [(20 + i, clean + f" {i}", "bad" if i < 2 else "good") for i in range(8)]
    for host in range(8):
        rows += [(100 * host + 200 + i, "a b" if i and host % 3 == 0 else clean, f"host{host}") for i in range(30)]
    rows += [(40 + i, "a b", "bad") for i in range(9)] + [(60, "x y # <b>\nx y # <b>\n" * 9, "good"), (61, "a a a a a a", "a")]
    expected = [(d, *measures(t), k) for (d, t, _), k in zip(rows, kept(rows, 0.5))]
    found = rules.judge_documents(frame(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert any(not k and not measures(t)[5] for (_, t, _), k in zip(rows, kept(rows, 0.5)))


def test_hosts_that_agree_and_empty(frame):
    rows = [(1, "a b c", "h"), (2, None, "h"), (3, "", None)]
    assert [r.kept for r in rules.judge_documents(frame(rows)).collect()] == [False] * 3
    assert rules.judge_documents(frame([])).count() == 0


def test_chance_is_taken_off_the_variance(frame):
    """A small host that failed by chance goes with the mean of all, a large one does not."""
    clean, short = " ".join(f"v{i}" for i in range(40)), "a b"
    rows = [(i, short if i < 10 else clean, f"h{i}") for i in range(100)]
    rows += [(200, short, "three"), (201, short, "three"), (202, clean, "three")]
    found = {r.doc_id: r.kept for r in rules.judge_documents(frame(rows)).collect()}
    assert found[202] and not found[200] and sum(found.values()) == 91
    rows += [(300 + i, short if i < 190 else clean, "large") for i in range(200)]
    rows += [(600 + i, clean, f"other{i % 5}") for i in range(500)]
    found = {r.doc_id: (r.kept, r.base_failed) for r in rules.judge_documents(frame(rows)).collect()}
    assert [found[r[0]][0] for r in rows] == kept(rows, 0.5)
    assert not any(found[300 + i][0] for i in range(200))
