"""Kernels on outlines against plain loops."""

import numpy as np
import pytest

from sessile.functions import contour, kernels
from sessile.operators import centers, edges, fit


def walk(values, step):
    """The first value that is missing on the way from the least (step 1) or greatest (step -1) one; None without a hole."""
    at = min(values) if step > 0 else max(values)
    for _ in range(len(values)):
        if at not in values:
            return at
        at += step
    return None


def mean(rows):
    total = sum(abs(a - b) for a, b in rows)
    return sum(abs(a - b) * (a + b) / 2 for a, b in rows) / total if total else 0.0


def sides(points):
    top = max(j for _, j in points)
    mid = np.floor(np.mean([i for i, j in points if j == top]))
    return [p for p in points if p[0] <= mid], [p for p in points if p[0] > mid]


def plain_horizontal(points, margin):
    left, right = sides(points)
    last, rows = max(j for _, j in left) - margin, []
    for row in range(last + 1):
        a, b = {i for i, j in left if j == row}, {i for i, j in right if j == row}
        if a and b:
            hole_a, hole_b = walk(a, -1), walk(b, 1)
            rows.append((max(a) if hole_a is None else hole_a - 1, min(b) if hole_b is None else hole_b + 1))
    return mean(rows)


def plain_vertical(points, margin):
    rows = []
    for is_left, side in zip((True, False), sides(points), strict=True):
        if not side:
            continue
        outer = (min if is_left else max)(i for i, _ in side)
        turn = np.floor(np.mean([j for i, j in side if i == outer]))
        up, down = [p for p in side if p[1] > turn], [p for p in side if p[1] <= turn]
        u, d = [i for i, _ in up], [i for i, _ in down]
        for x in sorted(set(u)):
            above = {j for i, j in up if i == x}
            hole = walk(above, 1)
            high = min(above) if hole is None else hole - 1
            below = {j for i, j in down if i == x}
            if below and (min(d) + margin <= x < max(d) if is_left else min(d) <= x < max(d) - margin):
                hole = walk(below, -1)
                rows.append((high, max(below) if hole is None else hole + 1))
            elif max(d) <= x < max(u) if is_left else min(u) <= x < min(d):
                rows.append((high, 0))
    return mean(rows)


def shapes():
    rng = np.random.default_rng(4)
    for n, w, h in ((1, 3, 3), (6, 4, 4), (60, 12, 9), (300, 20, 30), (300, 60, 8)):
        for _ in range(12):
            yield np.unique(np.stack([rng.integers(0, w, n), rng.integers(0, h, n)], axis=1), axis=0)
    for theta in (50, 90, 130):
        y, x = np.mgrid[:80, :140]
        a = np.where((x - 70) ** 2 + (79 - y + 40 * np.cos(np.radians(theta))) ** 2 <= 1600, 250, 0).astype(np.uint8)
        a[rng.integers(0, 80, 60), rng.integers(0, 140, 60)] = 250
        yield np.stack(kernels.outline(a, 100), axis=1)


@pytest.mark.parametrize("margin", [0, 1, 4])
def test_centres_against_loops(margin):
    for points in shapes():
        i, j = points[np.random.default_rng(1).permutation(len(points))].T
        pairs = [tuple(p) for p in points.tolist()]
        assert contour.horizontal_center(i, j, margin) == pytest.approx(plain_horizontal(pairs, margin), abs=1e-9)
        assert contour.vertical_center(i, j, margin) == pytest.approx(plain_vertical(pairs, margin), abs=1e-9)


def test_middle_slope_against_a_fit():
    for points in shapes():
        i, j = points.T
        rows = sorted(set(j.tolist()))
        x = np.array([(i[j == r].min() + i[j == r].max()) / 2 for r in rows])
        if len(set(x.tolist())) < 2:
            assert contour.middle_slope(i, j) is None
        else:
            assert contour.middle_slope(i, j) == pytest.approx(np.polyfit(x, rows, 1)[0], rel=1e-6, abs=1e-9)
    none = np.empty(0, np.int64)
    assert contour.middle_slope(none, none) is contour.horizontal_center(none, none) is contour.vertical_center(none, none) is None


def plain_path(i, j):
    by = np.lexsort((i, j))
    xy = np.stack([i[by], j[by]], axis=1).astype(float)
    left, at, order = np.ones(len(xy), dtype=bool), 0, []
    for _ in range(len(xy)):
        order.append(at)
        left[at] = False
        at = int(np.where(left, ((xy - xy[at]) ** 2).sum(axis=1), np.inf).argmin())
    return by[np.array(order, dtype=int)]


@pytest.mark.parametrize("n, wide", [(0, 1), (1, 5), (2, 1), (50, 5), (400, 12), (2000, 60), (2000, 3000), (1500, 100_000)])
def test_path_order_against_a_plain_search(n, wide):
    rng = np.random.default_rng(n)
    for _ in range(2):
        i, j = rng.integers(-wide, wide, n), rng.integers(0, max(1, wide // 2), n)
        assert kernels.greedy_path(i, j).tolist() == plain_path(i, j).tolist()
    line = np.arange(n)[::-1]
    assert kernels.greedy_path(line, np.zeros(n, int)).tolist() == line.tolist()


def test_kernels_from_frames_and_from_points_agree(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(12):
        a = rng.integers(0, 256, (20, 30)).astype(np.uint8) if k else np.zeros((20, 30), np.uint8)
        rows.append(("a", k, 20, 30, bytearray(a.tobytes())))
    frames = spark.createDataFrame([*rows, ("a", 99, 20, 30, None)], "run_id string, frame_no int, height int, width int, px binary")
    cfg = fit.TwoPass((9, 1), (9, 1), ((60.0, 7, 1), (None, 8, 2)))
    points = edges.edge_points(frames, 120)
    key = ["run_id", "frame_no"]
    apart = fit.two_pass(points, cfg).join(centers.horizontal_center(points), key).join(centers.vertical_center(points), key).join(fit.middle_line(points), key)
    fused = {r.frame_no: r for r in fit.frame_measures(frames, 120, 255, 4, cfg).collect()}
    assert len(fused) == 13 and all(v is None for n in (0, 99) for v in fused[n][2:])
    got = apart.collect()
    assert len(got) == 11 and all(r.asDict() == pytest.approx(fused[r.frame_no].asDict(), nan_ok=True) for r in got)
    both = {r.frame_no: (r.h_center, r.v_center) for r in centers.frame_centers(frames, 120).collect()}
    assert all(both[n] == (fused[n].h_center, fused[n].v_center) for n in fused)
    assert "Exchange" not in fit.frame_measures(frames, 120, 255, 4)._jdf.queryExecution().executedPlan().toString()
