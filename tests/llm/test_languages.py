"""Languages: held-out accuracy, what is not learned from, and odd inputs."""

import random
import zlib

import numpy as np
import pytest

from areakit.llm import languages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, place int, bytes int, own long"
SYLLABLES = {
    "aa": ["ka", "to", "mi", "ren", "sol"],
    "bb": ["sch", "ung", "ver", "ßen", "än"],
    "cc": ["eau", "que", "ille", "é", "ment"],
}


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2


def prose(draw, lang, n):
    words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randrange(2, 5))) for _ in range(n)]
    return " ".join(w.upper() if draw.random() < 0.1 else w for w in words)


@pytest.fixture
def texts():
    draw = random.Random(3)
    rows = []
    for i in range(240):
        lang = sorted(SYLLABLES)[i % 3 if i % 5 else 0]
        rows.append((i, prose(draw, lang, draw.randrange(8, 300)), lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, "x", 1, 2, 3) for i, t, lang in rows], SCHEMA)


def test_held_out_languages(spark, texts):
    found = {r.doc_id: r for r in languages.identify_documents(frame(spark, texts)).collect()}
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 for i, r in found.items())
    right = [found[i].lang_pred == lang for i, _, lang in texts if held(i)]
    assert len(right) > 30 and sum(right) >= 0.97 * len(right)


def test_held_out_languages_and_other_columns_are_not_learned(spark, texts):
    turned = [(i, t, "aa" if held(i) else lang) for i, t, lang in texts]
    one, two = (
        sorted(tuple(r) for r in languages.identify_documents(frame(spark, rows)).collect()) for rows in (texts, turned)
    )
    assert one == two


def test_odd_rows(spark, texts, odd_rows):
    odd = [(None if i is None else 1_000 + i, t, None) for i, t, _ in odd_rows]
    odd += [(1_100, "123 -- 4", "aa"), (1_101, prose(random.Random(1), "bb", 40_000), None), (1_102, "ß", "bb"), texts[0]]
    found = languages.identify_documents(frame(spark, texts + odd)).collect()
    assert len(found) == len(texts) + len(odd)
    by_id = {r.doc_id: r for r in found}
    for i, text, _ in odd:
        if i is not None:
            lettered = any(c.isalpha() for c in text or "")
            assert (by_id[i].lang_pred == "und") == (not lettered)
            assert lettered or by_id[i].score == 0
    assert by_id[1_101].lang_pred == "bb"
    assert not any(r.held_out for r in found if r.doc_id is None)


def test_nothing_to_learn(spark, odd_rows):
    rows = [(i, t, None) for i, t, _ in odd_rows]
    found = languages.identify_documents(frame(spark, rows)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)} and len(found) == len(rows)
    assert languages.identify_documents(frame(spark, [])).count() == 0


def test_one_language(spark):
    found = languages.identify_documents(frame(spark, [(i, f"word {i}", "aa") for i in range(12)])).collect()
    assert {r.lang_pred for r in found} == {"aa"}


def test_windows_cover_every_byte():
    for length in (0, 1, 2, 3, 255, 256, 257, 509, 510, 511, 5_000):
        starts, shares = languages.window_starts(length), languages.shares(length)
        assert len(starts) == len(shares) and starts[-1] + languages.WINDOW >= length
        assert all(b - a == languages.STEP for a, b in zip(starts, starts[1:]))
        assert length == 0 or np.isclose(shares.sum(), 1) and (shares > 0).all()
        raw = bytes(1 + i % 200 for i in range(length))
        windows = languages.cut(raw)
        joined = b"".join([windows[0].tobytes(), *(w[languages.OVERLAP :].tobytes() for w in windows[1:])])
        assert joined.rstrip(b"\0") == raw


def small_net(seed=0):
    draw = np.random.default_rng(seed)
    texts = [bytes(draw.integers(1, 255, n, np.uint8)) for n in (0, 3, 255, 300, 3_000)]
    return texts, languages.fit(texts, np.arange(5) % 3, ["x", "y", "z"], 1)


def test_scores_equal_a_plain_convolution_and_do_not_depend_on_neighbours():
    texts, net = small_net()
    together = languages.score_texts(net, texts)
    for text, row in zip(texts, together):
        assert np.allclose(languages.score_texts(net, [text])[0], row, atol=1e-6)
        plain = np.zeros(3)
        for window, share in zip(languages.cut(text), languages.shares(len(text))):
            embedded = net.embed[window]
            pooled = []
            for number, width in enumerate(languages.WIDTHS):
                for f in range(languages.FILTERS):
                    places = range(languages.WINDOW - width + 1)
                    values = [(embedded[p : p + width] * net.filters[number][:, :, f]).sum() + net.shift[number, f] for p in places]
                    pooled.append(max(0, max(values)))
            power = np.exp(np.array(pooled) @ net.combine + net.bias)
            plain += share * power / power.sum()
        if len(text):
            assert np.allclose(plain, row, atol=1e-4)


def test_gradients_agree_with_differences():
    texts, net = small_net(1)
    for name in ("embed", "shift", "combine", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters = [f.astype(np.float64) for f in net.filters]
    windows = np.concatenate([languages.cut(t) for t in texts])[:9]
    owner = np.arange(len(windows)) % 3
    weight = np.linspace(0.5, 2, len(windows))

    def loss():
        chosen = net.probabilities(net.pooled(windows))[np.arange(len(owner)), owner]
        return -(weight * np.log(chosen)).mean()

    values = [net.embed, *net.filters, net.shift, net.combine, net.bias]
    for value, slope in zip(values, languages.slopes(net, windows, owner, weight)):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        value[at] += 1e-6
        up = loss()
        value[at] -= 2e-6
        down = loss()
        value[at] += 1e-6
        assert np.isclose((up - down) / 2e-6, slope[at], rtol=0.02)
