"""Scores against a plain network, word by word and window by window."""

import math

import numpy as np
import pytest

from corpusmill.llm import toxicity


def _states(model, xs, way):
    """Hidden states of one direction after each of the inputs, with plain loops."""
    h = [0.0] * toxicity.HIDDEN
    out, n = [], toxicity.HIDDEN
    for x in xs:
        a = [float(v) for v in x @ model.p["wx"][way] + model.p["b"][way][0]]
        g = [sum(h[i] * float(model.p["u"][way][i][j]) for i in range(n)) for j in range(3 * n)]
        z = [1 / (1 + math.exp(-(a[j] + g[j]))) for j in range(n)]
        r = [1 / (1 + math.exp(-(a[n + j] + g[n + j]))) for j in range(n)]
        new = [math.tanh(a[2 * n + j] + r[j] * g[2 * n + j]) for j in range(n)]
        h = [new[j] + z[j] * (h[j] - new[j]) for j in range(n)]
        out.append(h)
    return out


def _plain(model, text):
    words = toxicity.words_of(text)
    bias = float(model.p["bo"][0])
    if not words:
        return 1 / (1 + math.exp(-bias))
    xs = model.inputs(words)[:-1]
    best = -math.inf
    for at in range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE):
        own = xs[at : at + toxicity.WINDOW]
        hidden = np.array([f + g for f, g in zip(_states(model, own, 0), _states(model, own[::-1], 1)[::-1], strict=True)])
        weight = np.exp(np.tanh(hidden @ model.p["wa"] + model.p["ba"]) @ model.p["va"])
        best = max(best, float((weight / weight.sum()) @ hidden @ model.p["wo"]) + bias)
    return 1 / (1 + math.exp(-best))


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    mild = [" ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n)) for n in rng.integers(3, 150, 60)]
    return toxicity.train(mild + [m[: len(m) // 2] + " vile rude idiot " + m[len(m) // 2 :] for m in mild], [0] * 60 + [1] * 60)


def test_scores_are_those_of_a_plain_network(model, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n)) + (" idiot" if n % 2 else "") for n in (1, 2, 5, 31, 32, 33, 95, 96, 97, 130, 300)]
    texts += [None, "", " 12 \n", "vile", "vile", "x " * 500]
    got = toxicity.scores(model, texts)
    want = [_plain(model, t) for t in texts]
    assert got == pytest.approx(want, abs=1e-4)
    assert [g >= toxicity.THRESHOLD for g in got] == [w >= toxicity.THRESHOLD for w in want]
    assert got[texts.index("vile")] == got[texts.index("vile") + 1]
    monkeypatch.setattr(toxicity, "_BLOCK_WORDS", 50)  # blocks and batches change nothing
    monkeypatch.setattr(toxicity, "_SCORED", 3)
    assert toxicity.scores(model, texts) == pytest.approx(got, abs=1e-5)


def test_passages_score_alike_at_all_offsets(model):
    rng = np.random.default_rng(3)
    filler = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(260)]
    texts = [" ".join(filler[:i] + ["vile", "rude", "idiot"] + filler[i:]) for i in range(0, 261, 3)]
    found = toxicity.scores(model, texts)
    assert found.min() > 0.7 and toxicity.scores(model, [" ".join(filler)])[0] < 0.3


def test_training_and_scoring_read_windows_alike(model):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(300)] + ["idiot"]
    words = [w.encode() for w in words]
    codes = rng.integers(0, len(words), 500).astype(np.int32)
    projected = model.projected(model.inputs(words))
    for stride in (toxicity.TRAIN_STRIDE, toxicity.STRIDE, 1):
        own = toxicity.windows(codes, len(words), stride)
        assert model.logits(projected, own) == pytest.approx(model.forward(projected, own), abs=1e-4)
