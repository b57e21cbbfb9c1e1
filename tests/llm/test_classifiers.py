"""The two classifiers: what they can learn, held-out rows, and odd inputs."""

import random
import tracemalloc
import zlib

import numpy as np
import pytest

from areakit.llm import quality, toxicity

LABELS = "doc_id long, toxic int, quality int, text string"


def held(doc, modulus, remainder):
    return doc is not None and zlib.crc32(str(doc).encode()) % modulus == remainder


def test_factorization_learns_pairs():
    """Class 1 needs both marks; either alone is as frequent in class 0."""
    draw = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(1_200):
        marks = [[0, 1], [0], [1], []][i % 4]
        rows.append(np.array(sorted({*marks, *draw.integers(2, 12, 3).tolist()})))
        labels.append(int(len(marks) == 2))
    bias, weights, vectors = toxicity.fit(rows, np.array(labels, float), 12)
    machine = toxicity.Machine(bias, np.zeros(0, np.int32), weights, vectors)
    both, one, other = (machine.score(s) for s in ({0, 1, 5}, {0, 5}, {1, 5}))
    assert both > 0.8 and one < 0.2 and other < 0.2
    additive = [bias + weights[list(s)].sum() for s in ({0, 1, 5}, {0, 5})]
    assert (vectors[0] @ vectors[1]) > 0.5 and additive[0] < np.log(both / (1 - both))


def test_training_keeps_terms_without_a_signal_of_their_own(spark, frame):
    """The mention is as frequent in both classes and offends only beside the insult."""
    draw = random.Random(8)
    vocabulary = [f"tok{chr(97 + i)}en" for i in range(26)]
    docs, labels = [], []
    for i in range(2_400):
        case = i % 16
        insult, mention, bad = case in (0, 8), case in (0, 2, 3, 4), case in (0, 1, 5, 9)
        own = ["grumble"] * insult + ["people"] * mention + ["vexing"] * (bad and not insult)
        docs.append((i, " ".join(draw.choices(vocabulary, k=12) + own), "a"))
        labels.append((i, int(bad), 1, "x"))
    known = {i: t for i, t, *_ in labels if not held(i, 4, 2)}
    with_mention = [t for i, t in known.items() if "people" in docs[i][1]]
    share, n = sum(known.values()) / len(known), len(with_mention)
    machine = toxicity.train(frame(docs), spark.createDataFrame(labels, LABELS))
    shown = (("people",), ("grumble",), ("people", "grumble"))
    slots = [{int(machine.slot_of[b]) for w in words for b in toxicity.word_buckets(w)} for words in shown]
    assert all(min(s) >= 0 for s in slots)
    alone, insulted, both = (machine.score(s) for s in slots)
    assert both > 0.5 > max(alone, insulted)
    assert abs(sum(with_mention) / n - share) < 0.02


def test_training_learns_pairs_of_which_neither_term_tells_anything(spark, frame):
    """Class 1 has both terms or neither: every single weight is worthless."""
    draw = random.Random(9)
    vocabulary = [f"tok{chr(97 + i)}en" for i in range(26)]
    docs, labels, truth = [], [], {}
    for i in range(4_000):
        one, two = draw.random() < 0.5, draw.random() < 0.5
        docs.append((i, " ".join(draw.choices(vocabulary, k=8) + ["grumble"] * one + ["people"] * two), "a"))
        truth[i] = int(one == two)
        labels.append((i, truth[i], 1, "x"))
    found = toxicity.toxic_documents(frame(docs), spark.createDataFrame(labels, LABELS), threshold=0.5).collect()
    right = [r.predicted == truth[r.doc_id] for r in found if r.held_out]
    assert len(right) > 800 and sum(right) >= 0.95 * len(right)


def test_score_equals_the_plain_sum_over_pairs():
    draw = np.random.default_rng(4)
    machine = toxicity.Machine(-0.3, np.zeros(0, np.int32), draw.normal(0, 0.5, 30), draw.normal(0, 0.4, (30, toxicity.FACTORS)))
    for size in (0, 1, 2, 7, 30):
        slots = set(draw.choice(30, size, replace=False).tolist())
        value = machine.bias + sum(machine.weights[s] for s in slots)
        value += sum(machine.vectors[a] @ machine.vectors[b] for a in slots for b in slots if a < b)
        assert np.isclose(machine.score(slots), 1 / (1 + np.exp(-value)))


@pytest.fixture
def toxic(spark, frame):
    draw = random.Random(5)
    vocabulary = [f"tok{chr(97 + i)}en" for i in range(26)]
    docs, labels = [], []
    for i in range(240):
        words = draw.choices(vocabulary, k=30)
        bad = i % 3 == 0
        if bad:
            words[draw.randrange(30)] = draw.choice(["Grumble", "grumbler,", "GRUMBLING"])
        docs.append((i, " ".join(words), "a"))
        labels.append((i, int(bad), 1, "x"))
    return frame(docs + [(None, "grumble", None), (900, None, None), (901, "", "b"), (7, docs[7][1], "a")]), labels


def test_toxic_documents(spark, toxic):
    docs, labels = toxic
    found = toxicity.toxic_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == 244
    truth = {i: t for i, t, *_ in labels}
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert all(r.predicted == truth[r.doc_id] for r in found if r.doc_id in truth)
    assert [r.predicted for r in found if r.doc_id is None] == [1]


def test_held_out_labels_are_not_learned(spark, toxic):
    docs, labels = toxic
    turned = [(i, 1 - t if held(i, 4, 2) else t, q, x) for i, t, q, x in labels]
    one, two = (
        {(r.doc_id, r.score) for r in toxicity.toxic_documents(docs, spark.createDataFrame(rows, LABELS)).collect()}
        for rows in (labels, turned)
    )
    assert one == two


def test_no_labels(spark, frame, odd_rows):
    none = spark.createDataFrame([], LABELS)
    scores = {r.score for r in toxicity.toxic_documents(frame(odd_rows), none).collect()}
    assert len(scores) == 1
    scored = quality.quality_documents(frame(odd_rows), none)
    assert {r.score for r in scored.collect()} == {0.5} and scored.count() == len(odd_rows)
    assert toxicity.toxic_documents(frame([]), none).count() == 0
    assert quality.quality_documents(frame([]), none).count() == 0


def test_chunks_cover_every_byte():
    for length in (0, 1, 31, 32, 480, 512, 513, 992, 993, 5_000):
        starts = quality.chunk_starts(length)
        assert len(starts) >= 1 and starts[-1] + quality.CHUNK >= length
        assert all(b - a == quality.CHUNK - quality.OVERLAP for a, b in zip(starts, starts[1:]))


def test_scores_do_not_depend_on_neighbours():
    draw = np.random.default_rng(1)
    net = quality.fit([draw.integers(1, 255, (2, quality.CHUNK), np.uint8) for _ in range(8)], np.arange(8) % 2.0, 1)
    texts = [bytes(draw.integers(1, 255, n, np.uint8)) for n in (0, 3, 511, 3_000, 40_000)]
    together = quality.score_texts(net, texts)
    alone = [quality.score_texts(net, [t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_gradients_agree_with_differences():
    draw = np.random.default_rng(2)
    documents = [draw.integers(1, 255, (k, quality.CHUNK), np.uint8) for k in (1, 2, 3)]
    labels = np.array([0.0, 1.0, 1.0])
    net = quality.fit(documents, labels, 0)
    for name in ("embed", "filters", "shift", "combine"):
        setattr(net, name, getattr(net, name).astype(np.float64))

    def loss():
        firsts = np.array([0, 1, 3])
        chunks = np.concatenate(documents)
        pooled = quality.combine(quality.chunk_features(net, chunks), firsts)
        p = quality.sigmoid(pooled @ net.combine + net.bias)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    slopes = quality._slopes(net, documents, labels, 0.0)
    for name, slope in zip(("embed", "filters", "shift", "combine"), slopes):
        value = getattr(net, name)
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        step = 1e-5
        value[at] += step
        up = loss()
        value[at] -= 2 * step
        down = loss()
        value[at] += step
        assert np.isclose((up - down) / (2 * step), slope[at], rtol=0.02), name


def test_scores_equal_a_plain_convolution():
    """One chunk after the other, one filter and place after the other."""
    draw = np.random.default_rng(9)
    texts = [bytes(draw.integers(1, 40, n, np.uint8)) for n in (0, 5, 512, 1_300)]
    net = quality.fit([quality.chunked(t) for t in texts], np.array([0.0, 1.0, 1.0, 0.0]), 2)
    for text, score in zip(texts, quality.score_texts(net, texts)):
        features = []
        for chunk in quality.chunked(text):
            blocks = []
            for start in range(0, quality.CHUNK, quality.BLOCK):
                places = range(start, start + quality.BLOCK)
                embedded = [x for p in places for x in net.embed[chunk[p]]]
                equal = [
                    sum(p >= lag and chunk[p] == chunk[p - lag] and chunk[p] != 0 for p in places) / quality.BLOCK
                    for lag in quality.LAGS
                ]
                blocks.append(np.array(embedded + equal))
            pairs = [one @ net.filters[0] + two @ net.filters[1] + net.shift for one, two in zip(blocks, blocks[1:])]
            features.append(np.maximum(np.max(pairs, axis=0), 0))
        pooled = np.concatenate([np.mean(features, axis=0), np.max(features, axis=0)])
        assert np.isclose(score, 1 / (1 + np.exp(-(pooled @ net.combine + net.bias))), atol=1e-4)


def test_training_memory_does_not_follow_the_texts(monkeypatch):
    """Sixteen texts of half a megabyte, and gradients that do not depend on the slices."""
    draw = np.random.default_rng(10)
    long = [quality.chunked(bytes(draw.integers(1, 255, 500_000, np.uint8))) for _ in range(16)]
    tracemalloc.start()
    quality.fit(long, np.arange(16) % 2.0, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    documents, labels = [d[:60] for d in long[:3]], np.array([1.0, 0.0, 1.0])
    net = quality.fit(documents, labels, 0)
    whole = quality._slopes(net, documents, labels, 0.0)
    monkeypatch.setattr(quality, "SLICE", 7)
    for one, two in zip(whole, quality._slopes(net, documents, labels, 0.0)):
        assert np.allclose(one, two, atol=1e-5)


def test_training_takes_whole_texts_up_to_a_size(spark, frame, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda documents, labels: seen.extend(documents))
    docs = frame([(i, chr(97 + i % 26) * (1_000 * (1 + i % 5)), "a") for i in range(60)] + [(70, "z" * 50_000, "a")])
    known = [(r.doc_id, 0, r.doc_id % 2, "x") for r in docs.collect()]
    quality.train(docs, spark.createDataFrame(known, LABELS), sample_bytes=40_000)
    sizes = [len(b"".join([d[0].tobytes(), *(c[quality.OVERLAP :].tobytes() for c in d[1:])]).rstrip(b"\0")) for d in seen]
    assert 36_000 <= sum(sizes) <= 40_000 and all(n % 1_000 == 0 and n <= 5_000 for n in sizes)


def test_odd_rows_with_a_trained_model(spark, toxic, odd_rows):
    """Very long, empty, null and repeated texts among those that are learned from and scored."""
    docs, labels = toxic
    more = [(None if i is None else 2_000 + i, t, None, s, 0, 7, "k", 9, "x") for i, t, s in odd_rows]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    labels = labels + [(2_000 + i, i % 2, (i + 1) % 2, "x") for i in range(10)] + labels[:3]
    known = spark.createDataFrame(labels, LABELS)
    for found in (toxicity.toxic_documents(docs, known), quality.quality_documents(docs, known)):
        scored = found.collect()
        assert len(scored) == 244 + len(odd_rows) and all(0 <= r.score <= 1 for r in scored)
        same = {r.score for r in scored if r.doc_id in (2_001, 2_002)}
        assert len(same) == 1 and len({r.score for r in scored}) > 10


def test_training_reads_whole_texts(spark, frame, monkeypatch):
    """Every byte of every labelled text, however long, reaches the fit."""
    texts = ["".join(chr(33 + (i + j * j) % 90) for j in range(n)) for i, n in enumerate((0, 10, 700, 6_000, 40_000))]
    seen = []
    monkeypatch.setattr(quality, "fit", lambda documents, labels: seen.extend(documents))
    docs = frame([(10 * i + k, t, "a") for i, t in enumerate(texts) for k in (1, 2, 3)])
    known = [(r.doc_id, 0, r.doc_id % 2, "x") for r in docs.collect()]
    quality.train(docs, spark.createDataFrame(known, LABELS))
    joined = {b"".join([d[0].tobytes(), *(c[quality.OVERLAP :].tobytes() for c in d[1:])]).rstrip(b"\0") for d in seen}
    assert joined == {texts[i // 10].encode() for i, *_ in known if not held(i, 5, 0)} and len(joined) == 5


def test_quality_documents(spark, frame):
    draw = random.Random(6)
    vocabulary = ["".join(draw.choices("etaoinshrdlu", k=draw.randrange(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(260):
        words, good = draw.choices(vocabulary, k=draw.randrange(40, 260)), i % 3 != 0
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 2 else [w for w in words[:30] for _ in range(9)]
        docs.append((i, " ".join(words), "a"))
        labels.append((i, 0, int(good), "x"))
    made, known = frame(docs + [(None, None, None), (500, "", "b")]), spark.createDataFrame(labels, LABELS)
    found = quality.quality_documents(made, known).collect()
    assert len(found) == 262 and all(r.held_out == held(r.doc_id, 5, 0) for r in found)
    right = [r.predicted == labels[r.doc_id][2] for r in found if r.doc_id is not None and r.doc_id < 260 and r.held_out]
    assert sum(right) >= 0.9 * len(right)
    kept = quality.good_documents(made, known)
    assert kept.columns == made.columns
    good = {r.doc_id for r in found if r.score >= 0.3}
    assert {r.doc_id for r in kept.collect()} == good
