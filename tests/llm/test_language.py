"""Language tagger: gradients, held-out accuracy, odd rows."""

import tracemalloc

import numpy as np
import pytest
from conftest import *  # noqa: F401,F403

from emberfold.llm.language import Tagger, Training, fit_tagger, held_out, with_language
from emberfold.llm.queries import QUERIES


def test_gradients_are_those_of_the_loss():
    tagger = Tagger(["a", "b", "c"], 3, 0)
    tagger.weights = {k: v.astype(np.float64) for k, v in tagger.weights.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (5, 4)), np.array([0, 1, 2, 1])

    def loss():
        p = tagger.probabilities(x)
        return -np.log(p[:, np.arange(4), y]).mean()

    grads = tagger._gradients(x, y)
    for name, at in [("out", (1, 2)), ("bias", (1,)), ("rec0", (0, 1)), ("rec0", (2, 4)),
                     ("rec1", (1, 7)), ("in0", (int(x[1, 2]), 0)), ("in1", (int(x[3, 0]), 8))]:
        w = tagger.weights[name]
        kept, step = w[at], 0.02
        w[at] = kept + step
        up = loss()
        w[at] = kept - step
        down = loss()
        w[at] = kept
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), rel=0.02, abs=2e-5)


def plain_scores(tagger, text):
    """One byte after the other, in double precision, straight from the gates' equations."""
    w, n = {k: v.astype(float) for k, v in tagger.weights.items()}, tagger.hidden
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def states(data, way):
        h, out = np.zeros(n), []
        for byte in data:
            a, b = w[f"in{way}"][byte], h @ w[f"rec{way}"]
            z, r = sigmoid(a[:n] + b[:n]), sigmoid(a[n:2 * n] + b[n:2 * n])
            new = np.tanh(a[2 * n:] + r * b[2 * n:])
            h = z * h + (1 - z) * new
            out.append(h)
        return out

    data, total, letters = (text or "").encode(), np.zeros(len(tagger.labels)), 0
    for at in range(0, len(data), 256):
        window = data[at:at + 256].rstrip(b" ")
        window = window.ljust(-(-len(window) // 64) * 64)
        forward, backward = states(window, 0), states(window[::-1], 1)[::-1]
        for byte, f, b in zip(window, forward, backward):
            if byte > 127 or chr(byte).isalpha():
                score = np.concatenate([f, b]) @ w["out"] + w["bias"]
                total += np.exp(score - score.max()) / np.exp(score - score.max()).sum()
                letters += 1
    return total / max(letters, 1)


def test_prediction_equals_plain_version(spark, docs):
    tagger = fit_tagger(docs.where(~held_out()), "doc_id", "text", "lang", Training(steps=40))
    rows = with_language(docs.select("doc_id", "text").where("length(text) < 3000").limit(60), tagger).collect()
    rows += with_language(spark.createDataFrame([(1, "short   " + " " * 300 + "é" * 130 + " end   "), (2, "ß")],
                                                "doc_id bigint, text string"), tagger).collect()
    for r in rows:
        p = plain_scores(tagger, r["text"])
        assert r["score"] == pytest.approx(p.max(), abs=1e-4)
        assert r["lang_pred"] == tagger.labels[p.argmax()] or np.sort(p)[-1] - np.sort(p)[-2] < 1e-4


def test_long_texts_take_bounded_memory():
    tagger = Tagger(["a", "b"], 2, 0)
    part = ("some words and others, é and so on " * 60)[:2048]
    base = tagger.pool([part.encode()[:2048]])
    tracemalloc.start()
    got = tagger.pool([part.encode()[:2048] * 2000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, base, atol=1e-5) and peak < 40e6  # 4 MB of text


def test_query_accuracy(spark, sf_dir, docs):
    rows = QUERIES["op1_language"](spark, sf_dir).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.93
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark, odd, empty):
    tagger = fit_tagger(odd.where(~held_out()), "doc_id", "text", "lang", Training(steps=5))
    tagged = with_language(odd, tagger)
    assert tagged.columns == [*odd.columns, "lang_pred", "score"]
    rows = tagged.collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert r["score"] > 0 if letters else r["score"] == 0
    assert fit_tagger(empty, "doc_id", "text", "lang") is None
    assert with_language(empty, tagger).count() == 0
    assert {r["lang_pred"] for r in with_language(odd, None).collect()} == {"und"}
    with pytest.raises(ValueError):
        with_language(odd, tagger, pred="root")


def test_sample_is_bounded_when_an_id_repeats(spark, monkeypatch):
    plan = Training()
    seen = []
    monkeypatch.setattr(Tagger, "fit", lambda self, x, y, plan: seen.append(np.bincount(y)))
    rows = [(1, f"{'some longer text of words ' * 40}{k}", "en") for k in range(3 * plan.docs_per_label)]
    rows += [(k, f"autre texte {k}", "fr") for k in range(50)]
    fit_tagger(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"),
               "doc_id", "text", "lang", plan)
    assert len(seen) == 1
    assert seen[0][0] == plan.docs_per_label * plan.windows_per_doc and seen[0][1] == 50
