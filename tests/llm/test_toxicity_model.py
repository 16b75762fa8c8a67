"""Toxicity: scores and one training step against plain versions, vector by vector."""

import math

import numpy as np
import pytest

from quillon.llm import op1_toxicity as op
from quillon.llm.op1_toxicity import Model, Scores, score_of, subwords, words

TEXTS = ["you are an idiot friend", "a calm and sunny day, my friend", "idiot, idiots and a day", "calm friends are sunny", "sunny idiotic day", "you and a calm day"] * 3
LABELS = [1, 0, 1, 0, 1, 0] * 3
BITS = 12


def plain_score(model, text):
    """The softmax over the mean of the words' vectors, a word's vector being the mean of those of its subwords."""
    own = []
    for w in sorted(words(text)):
        known = [model.vectors[g].astype(float) for g in subwords(w, BITS) if model.used[g]]
        own.append(np.mean(known, axis=0) if known else np.zeros(model.vectors.shape[1]))
    mean = (np.mean(own, axis=0) if own else np.zeros(model.vectors.shape[1])) * float(op.SCALE)
    z = mean @ model.softmax.astype(float) + model.bias
    return math.exp(z[1] - z.max()) / np.exp(z - z.max()).sum()


@pytest.mark.parametrize("text", [*TEXTS[:6], "", "never seen xyzzy", "idiottt sunnny", "a " * 50, "ü é 你好 idiot"])
def test_scores(text):
    model = Model(TEXTS, LABELS, bits=BITS, examples=400)
    numbers, constant = model.numbers()
    assert score_of(Scores(numbers), constant, text) == pytest.approx(plain_score(model, text), abs=1e-4)


def test_one_training_step():
    """All texts in one batch, one step: the gradients of the cross-entropy by loops over texts, words and subwords."""
    n = len(TEXTS)
    got = Model(TEXTS, LABELS, bits=BITS, examples=n)
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.05, (1 << BITS, op.WIDTH)).astype(np.float32).astype(float)
    softmax = rng.normal(0, 0.5, (op.WIDTH, 2)).astype(np.float32).astype(float)
    share = sum(LABELS) / n
    bias = np.array([0.0, math.log(share / (1 - share))])
    own = [[[g for g in subwords(w, BITS) if got.used[g]] for w in sorted(words(t))] for t in TEXTS]
    own = [[w for w in d if w] for d in own]
    g_softmax, g_vectors, loss_scale = np.zeros_like(softmax), np.zeros_like(vectors), float(op.SCALE)
    for doc, y in zip(own, LABELS, strict=True):
        mean = sum(vectors[w].mean(axis=0) for w in doc) / len(doc) * loss_scale
        z = mean @ softmax + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[y] -= 1
        g_softmax += np.outer(mean, p) / n
        for w in doc:
            for g in w:
                g_vectors[g] += (p @ softmax.T) * loss_scale / len(doc) / len(w)
    at = np.abs(g_vectors).sum(axis=1) > 0
    vectors[at] -= op.RATE * g_vectors[at] / np.sqrt(1e-8 + (g_vectors[at] ** 2).mean(axis=1))[:, None]
    softmax -= 0.2 * op.RATE * g_softmax / np.sqrt(1e-8 + g_softmax**2)
    assert got.softmax == pytest.approx(softmax, abs=2e-3)
    assert np.abs(got.vectors - vectors).max() < 2e-3
    assert np.abs(got.vectors - vectors).mean() < 1e-5


def test_ties_and_order():
    """Equal words in any order and number give equal scores; so do equal texts."""
    model = Model(TEXTS, LABELS, bits=BITS, examples=400)
    numbers, constant = model.numbers()
    score = lambda t: score_of(Scores(numbers), constant, t)
    assert score("idiot day calm") == pytest.approx(score("calm, CALM idiot idiot day!"), abs=1e-12)
    assert score("") == pytest.approx(0.5) == score(None) == score(" \n")
