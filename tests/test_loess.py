"""Loess by weighted moments against rows of weights, and its memory."""

import tracemalloc

import numpy as np
import pytest

from tidewatch.operators.stl import _estimate, _smooth, stl_decompose


def by_rows(y, span, rw, total):
    """Every point's window as a row of weights."""
    n = len(y)
    half = (span + 1) // 2
    at = np.arange(1, n + 1)
    nleft = np.clip(at - half + 1, 1, max(1, n - span + 1))
    fit, ok = _estimate(y, rw, at.astype(float), nleft, min(span, n), span, 1, total)
    return np.where(ok, fit, y)


@pytest.mark.parametrize(("n", "span"), [(50, 7), (400, 41), (400, 40), (30, 31), (9, 9), (2, 7), (1200, 901)])
def test_moments_equal_rows_of_weights(n, span):
    rng = np.random.default_rng(n + span)
    y = 1e4 + rng.normal(0, 10, n).cumsum()
    rw = rng.uniform(0, 1, n) * (rng.random(n) < 0.8)
    rw[n // 3:n // 3 + min(60, n // 2)] = 0.0          # windows without any weight keep their value
    for weights in (None, np.ones(n), rw):
        for total in (n, 10 * n):
            expected = by_rows(y, span, weights, total)
            assert np.abs(_smooth(y, span, 1, weights, total) - expected).max() <= 1e-9 * np.abs(y).max()


def test_constant_and_straight_lines_are_kept():
    x = np.arange(500.0)
    for y in (np.full(500, 3.25e8), 1e6 + 2.5 * x):
        assert np.abs(_smooth(y, 101, 1, np.linspace(0.1, 1, 500)) - y).max() <= 1e-12 * y.max()


def test_memory_does_not_grow_with_the_span():
    y = np.random.default_rng(1).normal(size=200_000)
    peaks = []
    for span in (101, 2001):
        tracemalloc.start()
        _smooth(y, span, 1, np.ones(len(y)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] <= 1.5 * peaks[0] and peaks[1] <= 50 << 20


def test_long_period_is_recovered():
    n, period = 8 * 720, 720
    x = np.arange(n)
    wave = 10 * np.sin(2 * np.pi * x / period)
    y = 0.001 * x + wave + np.random.default_rng(2).normal(0, 0.1, n)
    trend, seasonal, resid = stl_decompose(y, period, outer=2)
    assert np.abs(seasonal - wave).max() < 1.0
    assert np.abs(trend - 0.001 * x).max() < 1.0 and np.abs(resid).max() < 1.0
