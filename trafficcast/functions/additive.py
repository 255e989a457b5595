"""Additive forecast of one series: piecewise-linear trend plus seasons, fitted to a proven optimum.

The model is the one of Taylor & Letham, "Forecasting at Scale" (The American Statistician 72(1),
2018), with this engine's own estimator. The noise variance comes from the least-squares residuals.
What is left is convex: squared errors, Gaussian priors on level, slope and seasons, and a Laplace
prior on the slope changes. Level, slope and seasons have a closed form given the slope changes, which
leaves a lasso of at most 25 unknowns. Its solver works on the set of non-zero slope changes and their
signs, as in Lee et al., "Efficient sparse coding algorithms" (NIPS 2006), and ends after finitely many
steps; the gap to the dual problem tells how far the result can be from the optimum.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DAY = 86_400.0
WEEK = 7 * DAY
_CHANGEPOINTS = 25
#: Steps of the solver before it gives up, which the gap then shows.
_STEPS = 2000
#: Relative duality gap up to which a fit counts as optimal.
GAP = 1e-8
_LEAST_NOISE = 1e-10
#: Prior precision that keeps slope changes unique where the points do not.
_RIDGE = 1e-6


@dataclass(frozen=True)
class Fit:
    """level + slope * x + sum of bends * max(x - knot, 0) + waves, times scale; x runs over the span."""

    start: float
    span: float
    scale: float
    level: float
    slope: float
    knots: np.ndarray
    bends: np.ndarray
    #: (period in seconds, multiple, weight of the sine, weight of the cosine)
    waves: list[tuple[float, int, float, float]]
    #: Relative distance to the optimum, at most.
    gap: float

    @property
    def converged(self) -> bool:
        return bool(self.gap <= GAP)


def _seasons(t: np.ndarray) -> list[tuple[float, int]]:
    """(period, Fourier order) of each season the history can support."""
    span = t[-1] - t[0]
    out = []
    if span >= 2 * WEEK:
        out.append((WEEK, 3))
    if span >= 2 * DAY and np.min(np.diff(t)) < DAY:
        out.append((DAY, 4))
    return out


def _waves(t, seasons):
    angles = [2 * np.pi * k * t / period for period, order in seasons for k in range(1, order + 1)]
    return [f(a) for a in angles for f in (np.sin, np.cos)]


def _sweep(A: np.ndarray, b: np.ndarray, weight: float, x: np.ndarray) -> np.ndarray:
    """Each unknown in turn at its minimum, some times over."""
    x = x.copy()
    for i in np.tile(np.arange(len(b)), 20):
        pull = b[i] - A[i] @ x + A[i, i] * x[i]
        x[i] = np.sign(pull) * max(abs(pull) - weight, 0.0) / A[i, i]
    return x


def lasso(A: np.ndarray, b: np.ndarray, weight: float) -> tuple[np.ndarray, float]:
    """Minimum of x'Ax/2 - b'x + weight * |x| for positive definite A, and the duality gap at it."""
    x, sign = np.zeros(len(b)), np.zeros(len(b))

    def value(v):
        return v @ A @ v / 2 - b @ v + weight * np.abs(v).sum()

    for _ in range(_STEPS):
        active = np.flatnonzero(sign)
        target = np.linalg.solve(A[np.ix_(active, active)], b[active] - weight * sign[active])
        if np.all(np.sign(target) == sign[active]):
            x[active] = target
            slope = np.abs(A @ x - b)
            slope[active] = 0
            if not len(b) or slope.max() <= weight * (1 + 1e-12):
                break
            entering = int(slope.argmax())
            sign[entering] = np.sign(b - A @ x)[entering]
            continue
        # The target lies beyond a change of sign: go to the best point on the way to it.
        step = target - x[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            crossing = np.where(step != 0, -x[active] / step, 0)
        reach = [*crossing[(crossing > 0) & (crossing < 1)], 1.0]
        points = []
        for share in reach:
            point = x.copy()
            point[active] += share * step
            point[active[np.isclose(crossing, share, rtol=1e-14, atol=0)]] = 0
            points.append(point)
        best = min(points, key=value)
        # Rounding can leave no way down along the whole set; one unknown at a time there always is one.
        x = best if value(best) < value(x) else _sweep(A, b, weight, x)
        sign = np.sign(x)
    gradient = A @ x - b
    dual = np.clip(-gradient, -weight, weight)
    excess = dual + gradient
    gap = weight * np.abs(x).sum() - x @ dual + (excess @ np.linalg.solve(A, excess)) / 2 if len(b) else 0.0
    return x, max(float(gap), 0.0)


def fit(t, y, changepoint_scale: float, seasonality_scale: float) -> Fit:
    """Times in epoch seconds, ascending; y may hold NaN. Without two usable points the fit is a constant."""
    t, y = np.asarray(t, dtype=float), np.asarray(y, dtype=float)
    start, span = t[0], max(t[-1] - t[0], 1.0)
    usable = ~np.isnan(y)
    none = np.zeros(0)
    if usable.sum() < 2:
        level = y[usable][0] if usable.any() else np.nan
        return Fit(start, span, 1.0, float(level), 0.0, none, none, [], 0.0)

    head = int(np.floor(0.8 * len(t)))
    n_knots = max(min(_CHANGEPOINTS, head - 1), 0)
    at = np.linspace(0, max(head - 1, 0), n_knots + 1).round().astype(int)[1:]
    knots = (t[at] - start) / span
    seasons = _seasons(t)

    scale = float(np.max(np.abs(y[usable])) or 1.0)
    x, z = (t[usable] - start) / span, y[usable] / scale
    smooth = np.column_stack([np.ones_like(x), x, *_waves(t[usable], seasons)])
    hinges = np.maximum(x[:, None] - knots, 0.0)
    # The largest design that leaves as many points to judge the noise by; a line if none does.
    designs = [np.column_stack([smooth, hinges]), smooth, smooth[:, :2]]
    wide = next((d for d in designs if len(z) >= 2 * d.shape[1]), designs[-1])
    rest, rank = z - wide @ np.linalg.lstsq(wide, z)[0], np.linalg.matrix_rank(wide)
    noise = max(rest @ rest / max(len(z) - rank, 1), _LEAST_NOISE)

    prior = np.full(smooth.shape[1], 1.0 / seasonality_scale**2)
    prior[:2] = 1.0 / 25.0
    inner = np.linalg.inv(smooth.T @ smooth / noise + np.diag(prior))
    cross, moment = smooth.T @ hinges / noise, smooth.T @ z / noise
    A = hinges.T @ hinges / noise - cross.T @ inner @ cross + _RIDGE * np.eye(n_knots)
    A = (A + A.T) / 2
    b = hinges.T @ z / noise - cross.T @ inner @ moment
    bends, gap = lasso(A, b, 1.0 / changepoint_scale)
    theta = inner @ (moment - cross @ bends)
    error = z - smooth @ theta - hinges @ bends
    total = error @ error / noise / 2 + theta @ (prior * theta) / 2 + np.abs(bends).sum() / changepoint_scale
    multiples = [(period, k) for period, order in seasons for k in range(1, order + 1)]
    waves = [(p, k, float(theta[2 + 2 * i]), float(theta[3 + 2 * i])) for i, (p, k) in enumerate(multiples)]
    return Fit(start, span, scale, float(theta[0]), float(theta[1]), knots, bends, waves, gap / max(total, 1.0))


def predict(model: Fit, future) -> np.ndarray:
    future = np.asarray(future, dtype=float)
    x = (future - model.start) / model.span
    value = model.level + model.slope * x + np.maximum(x[:, None] - model.knots, 0.0) @ model.bends
    for period, k, sine, cosine in model.waves:
        angle = 2 * np.pi * k * future / period
        value = value + sine * np.sin(angle) + cosine * np.cos(angle)
    return model.scale * value


def fit_predict(t, y, future, changepoint_scale: float, seasonality_scale: float) -> np.ndarray:
    """Forecast at `future`; times in epoch seconds, ascending; y may hold NaN."""
    return predict(fit(t, y, changepoint_scale, seasonality_scale), future)
