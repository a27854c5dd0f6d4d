"""The line CRF against enumeration of all labellings and against differences of its likelihood."""

from __future__ import annotations

from itertools import pairwise, product

import numpy as np

from ticksmith.llm import quality


def worlds(logit, step):
    """(labels, weight) of every labelling of one row's lines."""
    for y in product((0, 1), repeat=len(logit)):
        yield y, np.exp(sum(logit[i] for i, v in enumerate(y) if v) + sum(step[a, b] for a, b in pairwise(y)))


def made(seed, counts):
    r = np.random.default_rng(seed)
    n = int(np.sum(counts))
    return np.array(counts), r.normal(size=(n, 3)), r.normal(size=3), r.normal(size=(2, 2)), r


def test_marginals_equal_enumeration():
    counts, x, w, step, _ = made(1, [3, 0, 1, 6, 6, 2])
    logit, weight = x @ w, np.array([1.0, 5.0, 2.0, 0.5, 3.0, 1.0])
    good, pairs = quality.marginals(logit, counts, step, weight)
    at, want, met = 0, [], np.zeros((2, 2))
    for n, k in zip(counts, weight, strict=True):
        each = list(worlds(logit[at:at + n], step))
        z = sum(p for _, p in each)
        want += [sum(p for y, p in each if y[i]) / z for i in range(n)]
        for y, p in each:
            for a, b in pairwise(y):
                met[a, b] += k * p / z
        at += n
    assert np.allclose(good, want) and np.allclose(pairs, met)


def test_gradient_equals_differences_of_the_likelihood():
    counts, x, w, step, r = made(2, [4, 1, 0, 5, 2, 3])
    label = r.integers(0, 2, len(counts)).astype(float)

    def value(w, step):
        at, total = 0, 0.0
        for n, y in zip(counts, label, strict=True):
            logit = x[at:at + n] @ w
            own = y * logit.sum() + max(0, n - 1) * step[int(y), int(y)]
            total += (own - np.log(sum(p for _, p in worlds(logit, step)))) / max(1, n)
            at += n
        return total / len(counts) - quality.PRIOR_W / 2 * (w ** 2).sum() - quality.PRIOR_STEP / 2 * (step ** 2).sum()

    of_w, of_step = quality.gradient(w, step, counts, x, label)
    e = 1e-5
    for i in range(3):
        d = np.eye(3)[i] * e
        assert np.isclose(of_w[i], (value(w + d, step) - value(w - d, step)) / (2 * e), atol=1e-7)
    for i, j in product(range(2), range(2)):
        d = np.zeros((2, 2))
        d[i, j] = e
        assert np.isclose(of_step[i, j], (value(w, step + d) - value(w, step - d)) / (2 * e), atol=1e-7)


def test_neighbours_change_a_line_of_a_fitted_chain():
    # lines of no evidence take the label of those around them
    counts = np.array([4] * 40)
    label = np.arange(40) % 2 * 1.0
    x = np.concatenate([[[1.0, 2 * y - 1], [1.0, 0.0], [1.0, 0.0], [1.0, 2 * y - 1]] for y in label])
    model = quality.fit(counts, np.ones(160), x, label)
    good, _ = quality.marginals(x @ model.weights, counts, model.step)
    assert np.all((good > 0.5) == np.repeat(label, 4).astype(bool))
    alone, _ = quality.marginals(x @ model.weights, counts, np.zeros((2, 2)))
    assert not np.all((alone > 0.5) == np.repeat(label, 4).astype(bool))


def test_one_very_long_text():
    good, _ = quality.marginals(np.full(20_000, 0.1), np.array([20_000]), np.array([[1.0, -1.0], [-1.0, 1.0]]))
    assert np.isfinite(good).all() and good[10_000] > 0.6
