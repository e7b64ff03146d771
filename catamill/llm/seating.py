"""Gibbs steps for the tables of a dish in a Pitman-Yor restaurant, for many dishes at once.

Given its c customers, a dish has t tables with probability in proportion to S(c, t) times the weights of opening its
first, second, .. t-th table. S, a generalised Stirling number, sums the products of (1 - d)(2 - d).. over all ways to
seat c customers at t tables; so a draw of t removes all of the dish's customers and seats them anew, given all others.
S is exact for up to EXACT customers; beyond, it is a rapidly falling series for few tables and a saddle point for many.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import numpy as np

EXACT = 512
#: Most places of t that are weighed for one dish, and entries that are weighed at once.
PLACES, AT_ONCE = 4096, 1 << 20
TERMS = 40


def lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function of positive numbers, by Stirling's series above 8."""
    x = np.asarray(x, np.float64)
    low = x < 8
    y = np.where(low, x + 8, x)
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    if low.any():
        z = np.where(low, x, 1.0)
        product = np.ones_like(z)
        for k in range(8):
            product = product * (z + k)
        out = np.where(low, out - np.log(product), out)
    return out


@functools.lru_cache(maxsize=8)
def stirling_table(d: float, most: int = EXACT) -> np.ndarray:
    """log S(c, t) at [c, t]; minus infinity for t > c."""
    out = np.full((most + 1, most + 2), -np.inf)
    out[0, 0] = 0
    for n in range(most):
        with np.errstate(divide="ignore"):
            grow = np.log(np.maximum(n - d * np.arange(1, most + 2), 0))
        out[n + 1, 1:] = np.logaddexp(out[n, :-1], out[n, 1:] + grow)
    return out


def log_stirling(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """log S(c, t) for 1 <= t <= c."""
    out = np.empty(len(c))
    exact = c <= EXACT
    if exact.any():
        out[exact] = stirling_table(d)[c[exact], t[exact]]
    few = ~exact & (t <= c.astype(np.float64) ** d)
    if few.any():
        out[few] = _series(c[few], t[few].astype(np.float64), d)
    many = ~exact & ~few
    if many.any():
        out[many] = _saddle(c[many].astype(np.float64), t[many].astype(np.float64), d)
    return out


def _series(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """S(c, t) = sum over j of (-1)^j binomial(t, j) gamma(c - d j) / gamma(-d j), over d^t t!."""
    sizes, own = np.unique(c, return_inverse=True)
    first = lgamma(sizes - d)
    total, choose = np.zeros(len(t)), np.ones(len(t))
    for j in range(1, TERMS + 1):
        choose = choose * (t - j + 1) / j
        whole = abs(d * j - round(d * j)) < 1e-12  # the gamma function has poles there
        if not whole:
            total += (-1) ** j * choose * (np.exp(lgamma(sizes - d * j) - first) / math.gamma(-d * j))[own]
    return np.log(np.maximum(total, 1e-300)) + first[own] - t * math.log(d) - lgamma(t + 1)


def _saddle(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """The coefficient of x^c in ((1 - (1 - x)^d) / d)^t at its saddle point."""
    low, high = np.full(len(c), -80.0), np.full(len(c), -1e-12)  # of log(1 - x)
    for _ in range(60):
        u = (low + high) / 2
        mean = t * -np.expm1(u) * np.exp((d - 1) * u) / (-np.expm1(d * u) / d)
        low, high = np.where(mean > c, u, low), np.where(mean > c, high, u)
    u = (low + high) / 2
    x, q, b = -np.expm1(u), np.exp(u), -np.expm1(d * u) / d
    m = x * q ** (d - 1) / b
    spread = t * (m + x * x * (1 - d) * q ** (d - 2) / b - m * m)
    out = lgamma(c + 1) - lgamma(t + 1) + t * np.log(b) - c * np.log(x) - 0.5 * np.log(2 * np.pi * np.maximum(spread, 1e-12))
    return np.where(t == c, 0.0, out)


def draw_tables(c: np.ndarray, old: np.ndarray, opening: Callable[[np.ndarray, np.ndarray], np.ndarray], d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish with c customers, drawn given everything else. old: its tables before. opening(k, i): log
    weight of opening a table for dish k where it has i. No customer has no table, one has one.

    All numbers of tables are weighed up to EXACT customers. Beyond, those around the old number and around where the
    next table's weight meets that of the tables that there are; of more than PLACES, each n-th from a place drawn."""
    c = np.asarray(c, np.int64)
    out = np.minimum(c, 1)
    at = np.flatnonzero(c > 1)
    if not len(at):
        return out
    first, last = np.ones(len(at), np.int64), c[at].copy()
    big = np.flatnonzero(last > EXACT)
    if len(big):
        k, n = at[big], c[at[big]]
        guess = np.minimum(np.exp(np.minimum(opening(k, old[k].astype(np.float64)), 60.0)) / d, n).astype(np.int64) + 1
        first[big] = np.maximum(1, np.minimum(old[k], guess) // 2 - 20)
        last[big] = np.minimum(n, 2 * np.maximum(old[k], guess) + 50)
    step = 1 + (last - first) // PLACES
    first = np.minimum(first + (rng.random(len(at)) * step).astype(np.int64), last)
    width = (last - first) // step + 1
    begin = 0
    ends = np.cumsum(width)
    while begin < len(at):
        base = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, base + AT_ONCE, side="right")))
        k, w = at[begin:stop], width[begin:stop]
        starts = np.cumsum(w) - w
        own = np.repeat(np.arange(len(k)), w)
        t = first[begin:stop][own] + step[begin:stop][own] * (np.arange(w.sum()) - starts[own])
        hop = step[begin:stop][own]
        weight = hop * opening(k[own], t + (hop - 1) / 2)  # from this place to the next
        before = np.cumsum(weight) - weight
        weight = before - before[starts][own] + log_stirling(c[k[own]], t, d)
        weight = np.exp(weight - np.maximum.reduceat(weight, starts)[own])
        so_far = np.cumsum(weight)
        so_far -= (so_far - weight)[starts][own]
        total = so_far[starts + w - 1]
        past = np.add.reduceat((so_far < (rng.random(len(k)) * total)[own]).astype(np.int64), starts)
        out[k] = t[starts + np.minimum(past, w - 1)]
        begin = stop
    return out
