"""STL (Seasonal-Trend decomposition by Loess, Cleveland et al. 1990) in NumPy.

Runs inside a grouped pandas function, one series per call. Defaults follow the published
procedure with robust fitting: seasonal smoother 7, trend span = smallest odd integer
>= 1.5 * period / (1 - 1.5 / seasonal), low-pass span = smallest odd integer > period,
local-linear fits everywhere, every point evaluated (no jumps), 2 inner and 15 outer
(robustness) iterations, bisquare weights at 6 * median |residual|.
"""

from __future__ import annotations

import math

import numpy as np

#: Weights held at once for points near the ends of a series, where each has a window of its own shape.
EDGE_CELLS = 1 << 18


def _odd_at_least(x: int) -> int:
    return x if x % 2 == 1 else x + 1


def default_spans(period: int, seasonal: int = 7) -> tuple[int, int]:
    trend = _odd_at_least(int(math.ceil(1.5 * period / (1.0 - 1.5 / seasonal))))
    low_pass = _odd_at_least(period + 1)
    return trend, low_pass


def _estimate(y: np.ndarray, rw: np.ndarray | None, xs: np.ndarray, nleft: np.ndarray,
              width: int, span: int, degree: int,
              total_rows: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Local (degree 0/1) tricube-weighted fit of ``y`` at 1-based positions ``xs``.

    Every fit uses the ``width`` consecutive points starting at ``nleft`` (1-based).
    ``total_rows``: rows of the whole series where ``y`` is a part of it (they decide whether a
    slope is fitted). Returns the fitted values and whether any weight was positive.
    """
    n = len(y)
    pos = nleft[:, None] + np.arange(width)[None, :]            # 1-based positions
    nright = nleft + width - 1
    h = np.maximum(xs - nleft, nright - xs).astype(float)
    if span > n:
        h = h + (span - n) // 2
    r = np.abs(pos - xs[:, None])
    hh = h[:, None]
    safe_h = np.where(hh > 0, hh, 1.0)
    tricube = (1.0 - (r / safe_h) ** 3) ** 3
    w = np.where(r <= 0.999 * hh, np.where(r <= 0.001 * hh, 1.0, tricube), 0.0)
    if rw is not None:
        w = w * rw[pos - 1]
    total = w.sum(axis=1)
    ok = total > 0
    w = w / np.where(ok, total, 1.0)[:, None]
    if degree > 0:
        centre = (w * pos).sum(axis=1)
        b = xs - centre
        c = (w * (pos - centre[:, None]) ** 2).sum(axis=1)
        adjust = (h > 0) & (np.sqrt(c) > 0.001 * ((total_rows or n) - 1.0))
        slope = np.where(adjust, b / np.where(c > 0, c, 1.0), 0.0)
        w = np.where(adjust[:, None], w * (slope[:, None] * (pos - centre[:, None]) + 1.0), w)
    return (w * y[pos - 1]).sum(axis=1), ok


def _tricube(r: np.ndarray, h: float) -> np.ndarray:
    """Weights at distances ``r`` of a window that reaches ``h`` far."""
    return np.where(r <= 0.999 * h, np.where(r <= 0.001 * h, 1.0, (1.0 - (r / max(h, 1.0)) ** 3) ** 3), 0.0)


def _inner_fits(y: np.ndarray, span: int, degree: int, rw: np.ndarray | None,
                total_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Fits at the points whose window of ``span`` rows is whole, from weighted moments.

    There the tricube weights depend on the offset alone, so each moment of the local line (weights
    times offset, offset squared, value) is one correlation with a band of ``span`` numbers: memory
    is a few arrays of the length of ``y``, whatever the span. Products of weights are summed as
    they are, so a window without any positive weight has a total of exactly 0.
    """
    half = (span + 1) // 2
    d = np.arange(span) - (half - 1.0)
    h = float(max(half - 1, span - half))
    band = _tricube(np.abs(d), h)
    level = y.mean()                         # a fitted line keeps constants; this keeps the digits
    v = y - level

    def moment(values: np.ndarray, power: int) -> np.ndarray:
        return np.correlate(values, band * d ** power, "valid")

    fits = len(y) - span + 1
    if rw is None:
        s0, s1, s2 = (np.full(fits, (band * d ** k).sum()) for k in range(3))
    else:
        s0, s1, s2 = (moment(rw, k) for k in range(3))
        v = v * rw
    ok = s0 > 0
    s0 = np.where(ok, s0, 1.0)
    fit = moment(v, 0) / s0
    if degree > 0:
        centre = s1 / s0
        spread = np.maximum(s2 / s0 - centre ** 2, 0.0)
        adjust = (h > 0) & (np.sqrt(spread) > 0.001 * (total_rows - 1.0))
        slope = np.where(adjust, -centre / np.where(spread > 0, spread, 1.0), 0.0)
        fit = fit + slope * (moment(v, 1) / s0 - centre * fit)
    return fit + level, ok


def _smooth(y: np.ndarray, span: int, degree: int, rw: np.ndarray | None,
            total_rows: int | None = None) -> np.ndarray:
    """Loess smooth evaluated at every point 1..n: moments where the window is whole, and rows of
    weights, ``EDGE_CELLS`` at a time, where it is cut off at an end."""
    n = len(y)
    if n < 2:
        return y.copy()
    half, width = (span + 1) // 2, min(span, n)
    fit, ok = np.empty(n), np.empty(n, bool)
    ends = [(0, n)]
    if span < n:
        inner = slice(half - 1, n - span + half)
        fit[inner], ok[inner] = _inner_fits(y, span, degree, rw, total_rows or n)
        ends = [(0, half - 1), (n - span + half, n)]
    step = max(1, EDGE_CELLS // width)
    for first, last in ends:
        for a in range(first, last, step):
            b = min(last, a + step)
            at = np.arange(a + 1, b + 1)
            nleft = np.clip(at - half + 1, 1, n - width + 1)
            fit[a:b], ok[a:b] = _estimate(y, rw, at.astype(float), nleft, width, span, degree, total_rows)
    return np.where(ok, fit, y)


def _cycle_subseries(y: np.ndarray, period: int, span: int, degree: int,
                     rw: np.ndarray | None, offset: int = 0,
                     total_rows: int | None = None) -> np.ndarray:
    """Smooth each cycle-subseries and extend it by one point at both ends (n + 2p). ``y`` may be
    the part from ``offset`` of a series of ``total_rows``."""
    n = len(y)
    out = np.empty(n + 2 * period)
    for j in range(period):
        sub = y[j::period]
        k = len(sub)
        srw = rw[j::period] if rw is not None else None
        smooth = np.empty(k + 2)
        whole = len(range((offset + j) % period, total_rows or n, period))
        smooth[1:k + 1] = _smooth(sub, span, degree, srw, whole)
        right = min(span, k)
        v, ok = _estimate(sub, srw, np.array([0.0]), np.array([1]), right, span, degree, whole)
        smooth[0] = v[0] if ok[0] else smooth[1]
        left = max(1, k - span + 1)
        v, ok = _estimate(sub, srw, np.array([k + 1.0]), np.array([left]), k - left + 1, span,
                          degree, whole)
        smooth[k + 1] = v[0] if ok[0] else smooth[k]
        out[j::period] = smooth
    return out


def _moving_average(x: np.ndarray, length: int) -> np.ndarray:
    return np.convolve(x, np.full(length, 1.0 / length), mode="valid")


def _robustness_weights(y: np.ndarray, fit: np.ndarray) -> np.ndarray:
    r = np.abs(y - fit)
    n = len(r)
    s = np.sort(r)
    mid1 = n // 2 + 1
    mid2 = n - mid1 + 1
    h = 3.0 * (s[mid1 - 1] + s[mid2 - 1])          # 6 * median
    with np.errstate(divide="ignore", invalid="ignore"):
        bisq = (1.0 - (r / h) ** 2) ** 2
    return np.where(r <= 0.001 * h, 1.0, np.where(r <= 0.999 * h, bisq, 0.0))


def stl_decompose(y, period: int, seasonal: int = 7, trend: int | None = None,
                  low_pass: int | None = None, robust: bool = True,
                  inner: int | None = None, outer: int | None = None):
    """Return ``(trend, seasonal, resid)`` arrays for a gap-free series ``y``."""
    y = np.asarray(y, dtype=float)
    if period < 2:
        raise ValueError("period must be >= 2")
    if seasonal < 3 or seasonal % 2 == 0:
        raise ValueError("seasonal must be an odd integer >= 3")
    d_trend, d_low = default_spans(period, seasonal)
    trend = d_trend if trend is None else trend
    low_pass = d_low if low_pass is None else low_pass
    inner = (2 if robust else 5) if inner is None else inner
    outer = (15 if robust else 0) if outer is None else outer
    t, s, rw = np.zeros(len(y)), np.zeros(len(y)), None
    for k in range(outer + 1):
        t, s = stl_pass(y, t, rw, period, seasonal, trend, low_pass, inner)
        if k == outer:
            break
        rw = _robustness_weights(y, t + s)
    return t, s, y - s - t


def stl_pass(y: np.ndarray, t: np.ndarray, rw: np.ndarray | None, period: int, seasonal: int,
             trend: int, low_pass: int, inner: int, offset: int = 0,
             total_rows: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The inner loop: ``inner`` updates of seasonal and trend, from the trend ``t``. ``y`` may be
    the part from ``offset`` of a series of ``total_rows``."""
    n = len(y)
    total = n if total_rows is None else total_rows
    s = np.zeros(n)
    for _ in range(inner):
        cycle = _cycle_subseries(y - t, period, seasonal, 1, rw, offset, total)
        low = _smooth(_moving_average(_moving_average(_moving_average(cycle, period),
                                                      period), 3), low_pass, 1, None, total)
        s = cycle[period:period + n] - low
        t = _smooth(y - s, trend, 1, rw, total)
    return t, s


def reach(period: int, seasonal: int, trend: int, low_pass: int, inner: int) -> int:
    """Rows on either side that a value can depend on through ``stl_pass``."""
    return inner * ((seasonal // 2 + 3) * period + low_pass + trend)
