"""The convolutional classifier against a plain convolution word by word, and its gradients against differences of the loss."""

import numpy as np
import pyarrow as pa
import pytest

from pixelspark.llm import toxicity

TEXTS = ["one two three two one", "", "Bad, bad words! here", "ünïcödé 中文 (brackets) a", "x", "  \n ", "one two", " ".join(f"w{i % 9}" for i in range(60))]


def arrow(texts):
    return pa.array(texts, pa.large_string())


def plain_pooled(model, text):
    """Every filter at every word, words beyond the end being nothing; the largest value, at least 0."""
    ids, codes, _ = toxicity.word_ids(arrow([text]))
    words = [model.embed[ids[c]].sum(0) for c in codes]
    out = []
    for w, kernel, shift in zip(toxicity.WIDTHS, model.filters, model.shift):
        for f in range(toxicity.FILTERS):
            found = [sum(float(words[i + k] @ kernel[k][:, f]) for k in range(w) if i + k < len(words)) + shift[f] for i in range(len(words))]
            out.append(max([0.0, *found]))
    return out


def plain_score(model, text):
    z = float(np.dot(plain_pooled(model, text), model.out)) + model.bias
    return 1 / (1 + np.exp(-z))


def initial(monkeypatch, texts, y):
    monkeypatch.setattr(toxicity, "EPOCHS", 0)
    return toxicity.train(arrow(texts), y, np.ones(len(y)))


def test_scores_are_those_of_a_plain_convolution(monkeypatch):
    y = np.array([0, 0, 1, 0, 1, 0, 0, 1])
    model = initial(monkeypatch, TEXTS, y)
    rng = np.random.default_rng(3)
    model.shift = [rng.normal(0, 0.3, toxicity.FILTERS) for _ in toxicity.WIDTHS]
    assert np.allclose(model.pooled(arrow(TEXTS)), [plain_pooled(model, t) for t in TEXTS], atol=1e-5)
    assert np.allclose(model.score(arrow(TEXTS)), [plain_score(model, t) for t in TEXTS], atol=1e-5)


def loss(model, texts, y, weight):
    p = np.array([plain_score(model, t) for t in texts])
    return -float((weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum())


def test_first_step_goes_down_every_slope(monkeypatch):
    """Adam's first step moves each parameter against the sign of its gradient; differences of the plain loss give that sign."""
    texts = [t for t in TEXTS if t.strip()]
    y, weight = np.array([0, 1, 0, 1, 0, 1]), np.array([1.0, 2.0, 0.5, 1.0, 1.0, 3.0])
    monkeypatch.setattr(toxicity, "DECAY", 0.0)
    before = initial(monkeypatch, texts, y)
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    monkeypatch.setattr(toxicity, "BATCH", 100)
    after = toxicity.train(arrow(texts), y, weight)
    rng, checked = np.random.default_rng(0), 0

    def slope(values, at, h=1e-6):
        old = values[at]
        values[at] = old + h
        up = loss(before, texts, y, weight)
        values[at] = old - h
        down = loss(before, texts, y, weight)
        values[at] = old
        return (up - down) / (2 * h)

    ids, _, _ = toxicity.word_ids(arrow(texts))
    seen = np.unique(ids)
    pairs = [(before.out, after.out, [(i,) for i in range(len(before.out))])]
    pairs += [(b, a, [(i,) for i in range(toxicity.FILTERS)]) for b, a in zip(before.shift, after.shift)]
    pairs += [(b, a, [tuple(rng.integers(0, n) for n in b.shape) for _ in range(12)]) for b, a in zip(before.filters, after.filters)]
    pairs.append((before.embed, after.embed, [(int(rng.choice(seen)), int(rng.integers(0, toxicity.SIZE))) for _ in range(40)]))
    for values, moved, places in pairs:
        for at in places:
            g, step = slope(values, at), moved[at] - values[at]
            if abs(g) > 1e-5:
                assert step == pytest.approx(-toxicity.RATE * np.sign(g), rel=0.02), (values.shape, at, g, step)
                checked += 1
            else:
                assert abs(step) <= toxicity.RATE * 1.001
    assert checked > 60


def test_training_lowers_the_loss_and_separates():
    r = np.random.default_rng(1)
    clean, bad = [f"c{i}" for i in range(40)], [f"t{i}" for i in range(6)]
    y = (r.random(200) < 0.3).astype(np.int64)
    texts = [" ".join([*r.choice(clean, 30), *(r.choice(bad, 2) if k else [])]) for k in y]
    model = toxicity.train(arrow(texts), y, np.ones(len(y)))
    score = model.score(arrow(texts))
    assert score[y == 1].min() > score[y == 0].max()
