"""Slopes of the factorisation machine beside differences of its loss."""

import math
from dataclasses import replace

import numpy as np

from catamill.llm import quality_classifier as Q


def test_factorisation_slopes_are_those_of_differences():
    """One step of the descent, taken back to its slopes (Adagrad begins at 1e-3), beside differences of the loss."""
    rnd = np.random.default_rng(4)
    fit = Q.Fit(buckets=8, rank=2, epochs=1, steps=1, decay=0.0, rate=0.05)
    m = replace(Q.start(fit), bias=0.2, linear=rnd.normal(0, 0.3, fit.width), factors=rnd.normal(0, 0.5, (fit.width, 2)))
    rows, columns = np.array([0, 0, 0, 1, 1, 2, 2, 2]), np.array([0, 13, 15, 13, 16, 0, 16, 19])
    values, label = rnd.normal(0, 1, 8), np.array([1.0, 0.0, 1.0])

    def loss(model):
        out = []
        for r in range(3):
            own = [(c, v) for q, c, v in zip(rows, columns, values, strict=True) if q == r]
            pairs = sum(model.factors[a] @ model.factors[b] * x * y for i, (a, x) in enumerate(own) for b, y in own[i + 1 :])
            z = model.bias + sum(model.linear[c] * v for c, v in own) + pairs
            out.append(math.log1p(math.exp(z)) - label[r] * z)
        return sum(out) / 3

    after = Q.descend(m, [(rows, columns, values, label)])
    slope = lambda before, now: (d := (before - now) / fit.rate) * math.sqrt(1e-3) / math.sqrt(1 - d * d)

    def difference(name, at):
        out = []
        for step in (1e-6, -1e-6):
            moved = np.array(getattr(m, name), np.float64)
            moved[at] += step
            out.append(loss(replace(m, **{name: float(moved) if name == "bias" else moved})))
        return (out[0] - out[1]) / 2e-6

    assert abs(slope(m.bias, after.bias) - difference("bias", ())) < 1e-6
    for c in set(columns.tolist()):
        assert abs(slope(m.linear[c], after.linear[c]) - difference("linear", c)) < 1e-6
        for f in range(2):
            assert abs(slope(m.factors[c, f], after.factors[c, f]) - difference("factors", (c, f))) < 1e-6
    untouched = [c for c in range(fit.width) if c not in columns]
    assert (after.linear[untouched] == m.linear[untouched]).all() and (after.factors[untouched] == m.factors[untouched]).all()
