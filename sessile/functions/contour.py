"""Measurements of one frame's outline: arrays of places i and heights j (counted upward) of its edge points."""

from __future__ import annotations

import numpy as np


def _first_holes(line: np.ndarray, value: np.ndarray, beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """The lines, ascending, and of each the first value that is missing above its least one, plus ``beyond``; the
    least one where none is missing."""
    if not len(line):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    base, low = int(line.min()), int(value.min())
    span = int(value.max()) - low + 1
    code = (line - base) * span + (value - low)
    code.sort()
    code = code[np.concatenate([[True], code[1:] != code[:-1]])]
    at = code // span
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    value = code - at * span
    # Along a line without holes a value less its rank stays what it is at first.
    ahead = value - np.arange(len(at))
    whole = ahead[starts]
    own = np.concatenate([starts[1:], [len(at)]]) - starts
    k = np.where(ahead != np.repeat(whole, own), np.arange(len(at)) - np.repeat(starts, own), len(at))
    hole, first = np.minimum.reduceat(k, starts), value[starts] + low
    return at[starts] + base, np.where(hole < len(at), first + hole + beyond, first)


def _weighted(a: np.ndarray, b: np.ndarray) -> float:
    """Mean of the middles of a and b, weighted by their distances; 0 without any."""
    weight = np.abs(a - b).astype(float)
    return float((weight * (a + b) / 2).sum() / weight.sum()) if weight.sum() > 0 else 0.0


def _left(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether a place is at most the mean place of the top row."""
    return i <= np.floor(i[j == j.max()].mean())


def horizontal_center(i: np.ndarray, j: np.ndarray, margin: int = 4) -> float | None:
    """Mean of the middles of the rows, weighted by their widths; 0 without any row, None without points.

    Rows go from 0 to ``margin`` below the top of the left side.  A left
    extreme starts at the row's greatest i of that side and a hole gives the
    place before it; a right one mirrors that.
    """
    if not len(i):
        return None
    i, j = i.astype(np.int64), j.astype(np.int64)
    left = _left(i, j)
    (rows_l, ends_l), (rows_r, ends_r) = _first_holes(j[left], -i[left], 1), _first_holes(j[~left], i[~left], 1)
    use = (rows_l >= 0) & (rows_l <= rows_l[-1] - margin)
    if not len(rows_r):
        return 0.0
    at = np.minimum(np.searchsorted(rows_r, rows_l), len(rows_r) - 1)
    use &= rows_r[at] == rows_l
    return _weighted(ends_r[at][use], -ends_l[use])


def vertical_center(i: np.ndarray, j: np.ndarray, margin: int = 4) -> float | None:
    """Mean of the middles of the columns, weighted by their heights; 0 without any column, None without points.

    Each side splits at its outermost point into an upper and a lower part.
    Columns below the overhang lie between both parts, the others between the
    upper part and the ground.
    """
    if not len(i):
        return None
    i, j = i.astype(np.int64), j.astype(np.int64)
    left = _left(i, j)
    tops, unders = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for side, is_left in ((left, True), (~left, False)):
        x, y = i[side], j[side]
        if not len(x):
            continue
        up = y > np.floor(y[x == (x.min() if is_left else x.max())].mean())
        at, above = _first_holes(x[up], y[up], -1)
        down_at, below = _first_holes(x[~up], -y[~up], -1)
        between, ground = np.zeros(len(at), bool), np.zeros(len(at), bool)
        where = np.minimum(np.searchsorted(down_at, at), max(0, len(down_at) - 1))
        if len(down_at) and len(at):
            low, high = down_at[0], down_at[-1]
            there = down_at[where] == at
            between = there & ((at >= low + margin) & (at < high) if is_left else (at >= low) & (at < high - margin))
            ground = ~between & ((at >= high) & (at < at[-1]) if is_left else (at >= at[0]) & (at < low))
        use = between | ground
        tops.append(above[use])
        unders.append(np.where(between, -below[where], 0)[use] if len(down_at) else np.zeros(int(use.sum()), np.int64))
    return _weighted(np.concatenate(tops), np.concatenate(unders))


def middle_slope(i: np.ndarray, j: np.ndarray) -> float | None:
    """Slope of the line through the middles of the rows; None for fewer than two different middles."""
    if not len(i):
        return None
    order = np.lexsort((i, j))
    i, j = i[order].astype(float), j[order].astype(float)
    starts = np.flatnonzero(np.r_[True, j[1:] != j[:-1]])
    x, y = (i[starts] + i[np.r_[starts[1:], len(j)] - 1]) / 2, j[starts]
    u = x - x.mean()
    spread = float(u @ u)
    return float(u @ (y - y.mean())) / spread if spread > 0 else None
