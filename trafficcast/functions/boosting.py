"""Boosted regression trees for many targets of one small table, side by side.

All targets share the rows' features and so their histogram bins; each has trees, rows and residuals
of its own. A level of all targets' trees is grown at once from one histogram.
"""

from __future__ import annotations

import numpy as np

#: Most bins of a feature; with fewer distinct values each has its own.
BINS = 32


def binned(features: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin of every cell of both tables, by thresholds from the first; order is kept."""
    codes = []
    for column, other in zip(features.T, others.T, strict=True):
        values = np.unique(column[~np.isnan(column)])
        middle = (values[1:] + values[:-1]) / 2
        if len(middle) >= BINS:
            middle = np.unique(middle[np.linspace(0, len(middle) - 1, BINS - 1).round().astype(int)])
        # Missing values sort last, into the last bin.
        codes.append([np.searchsorted(middle, c) for c in (column, other)])
    return tuple(np.array(part).T.reshape(-1, features.shape[1]) for part in zip(*codes, strict=True))


def boosted_trees(
    features: np.ndarray,
    targets: np.ndarray,
    others: np.ndarray,
    rounds: int,
    depth: int,
    rate: float,
    least: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Predictions (rows x targets) of the training rows and of other rows.

    Squared error from the mean on; NaN targets take no part. A leaf has at least `least` rows. A
    target without any row is NaN.
    """
    codes, other_codes = binned(features, others)
    n, width = codes.shape
    h = targets.shape[1]
    known = ~np.isnan(targets)
    counts = known.sum(axis=0)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(known, targets, 0).sum(axis=0) / counts
    fitted, beyond = np.tile(mean, (n, 1)), np.tile(mean, (len(other_codes), 1))
    rows, columns = np.nonzero(known)
    if not len(rows):
        return fitted, beyond
    cells = codes[rows]
    bins = int(codes.max(initial=0)) + 1
    feature = np.arange(width)
    every = np.arange(h)

    for _ in range(rounds):
        residual = targets[rows, columns] - fitted[rows, columns]
        node = np.zeros(len(rows), np.int64)
        inside = np.zeros((n, h), np.int64)
        outside = np.zeros((len(other_codes), h), np.int64)
        for level in range(depth):
            leaves = 1 << level
            place = columns * leaves + node
            at = ((place[:, None] * width + feature) * bins + cells).ravel()
            shape = (h, leaves, width, bins)
            size = int(np.prod(shape))
            total = np.bincount(at, np.repeat(residual, width), size).reshape(shape).cumsum(axis=3)
            count = np.bincount(at, minlength=size).reshape(shape).cumsum(axis=3)
            rest, left = total[..., -1:] - total, count
            right = count[..., -1:] - count
            with np.errstate(invalid="ignore", divide="ignore"):
                gain = total**2 / left + rest**2 / right - total[..., -1:] ** 2 / count[..., -1:]
            gain = np.where((left >= least) & (right >= least), gain, -np.inf).reshape(h, leaves, -1)
            best = gain.argmax(axis=2)
            splits = np.take_along_axis(gain, best[..., None], 2)[..., 0] > 1e-12
            by, cut = best // bins, np.where(splits, best % bins, bins)
            node = 2 * node + (cells[np.arange(len(rows)), by[columns, node]] > cut[columns, node])
            for table, nodes in ((codes, inside), (other_codes, outside)):
                chosen = np.take_along_axis(table, by[every, nodes].reshape(len(table), -1), 1) if len(table) else nodes
                nodes += nodes + (chosen > cut[every, nodes])
        leaves = 1 << depth
        place = columns * leaves + node
        count = np.bincount(place, minlength=h * leaves)
        value = rate * np.bincount(place, residual, h * leaves) / np.maximum(count, 1)
        fitted += value[every * leaves + inside]
        beyond += value[every * leaves + outside]
    return fitted, beyond
