"""Two-dimensional kernels on single gray frames (uint8 arrays), run by Arrow batches.

What lies outside a frame is ignored by dilation and erosion, repeated by the
blur, and white for warps.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np


def ellipse(size: int) -> np.ndarray:
    """Mask of a filled ellipse in a square: in each row the chord of the circle through the square's rim, rounded."""
    r = size // 2
    y = np.arange(size) - r
    half = np.rint(np.sqrt(np.maximum(0, r * r - y * y)) if r else np.zeros(size)).astype(int)
    return np.abs(np.arange(size) - r)[None, :] <= half[:, None]


def _shifted(image: np.ndarray, mask: np.ndarray, fill: int, best) -> np.ndarray:
    """Best of the pixels under a mask around each place.

    The padded frame is one run of pixels, in which a step to the right is a
    shift by one and a step down one by its width.  Rows of a mask without
    holes take the best of ``n`` neighbours, which the next longer row goes on
    from.
    """
    (h, w), ry, rx = image.shape, mask.shape[0] // 2, mask.shape[1] // 2
    wide = w + mask.shape[1] - 1
    padded = np.full((h + mask.shape[0] - 1, wide), fill, dtype=image.dtype)
    padded[ry : ry + h, rx : rx + w] = image
    out, size = np.full((h, wide), fill, dtype=image.dtype), (h - 1) * wide + w
    todo = []
    for dy, row in enumerate(mask):
        at = np.flatnonzero(row)
        if len(at) and at[-1] - at[0] + 1 == len(at):
            todo.append((len(at), dy * wide + int(at[0])))
        else:
            todo += [(1, dy * wide + int(dx)) for dx in at]
    # Two stretches of memory take turns, so that none is asked for in between.
    flat, spare, result = padded.ravel(), np.empty(padded.size, image.dtype), out.ravel()[:size]
    n, reach = padded.size, 1
    for length, start in sorted(todo):
        while reach < length:
            step = min(reach, length - reach)
            n -= step
            best(flat[:n], flat[step : step + n], out=spare[:n])
            flat, spare = spare, flat
            reach += step
        best(result, flat[start : start + size], out=result)
    return np.ascontiguousarray(out[:, :w])


def dilate(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return _shifted(image, mask, 0, np.maximum)


def erode(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return _shifted(image, mask, 255, np.minimum)


def close(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return erode(dilate(image, mask), mask)


def opened(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return dilate(erode(image, mask), mask)


def blur(image: np.ndarray, size: int = 3) -> np.ndarray:
    """Binomial smoothing, rounded half up."""
    weights = np.array([1.0])
    for _ in range(size - 1):
        weights = np.convolve(weights, [0.5, 0.5])
    r = size // 2
    out = np.pad(image.astype(float), r, mode="edge")
    out = sum(w * out[k : k + image.shape[0]] for k, w in enumerate(weights))
    out = sum(w * out[:, k : k + image.shape[1]] for k, w in enumerate(weights))
    return np.floor(out + 0.5).astype(np.uint8)


def threshold(image: np.ndarray, value: int, most: int = 255, inverse: bool = False) -> np.ndarray:
    return np.where((image > value) != inverse, most, 0).astype(np.uint8)


def min_max(image: np.ndarray) -> np.ndarray:
    """Pixels stretched to 0..1; zeros where all are equal."""
    low, high = int(image.min()), int(image.max())
    return (image - float(low)) / (high - low) if high > low else np.zeros(image.shape)


def _centre(image: np.ndarray, times: int, axis: int) -> tuple[np.ndarray, int]:
    """What a linear resize to 1 / ``times`` sees along an axis, as a sum of the second number of pixels."""
    pick = lambda k: image[k::times] if axis == 0 else image[:, k::times]
    return (pick(times // 2), 1) if times % 2 else (pick(times // 2 - 1) + pick(times // 2), 2)


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Linear resize with pixel centres aligned, rounded half up."""
    if height and width and image.shape[0] % height == 0 and image.shape[1] % width == 0:
        rows, n = _centre(image.astype(np.uint16), image.shape[0] // height, 0)
        both, m = _centre(rows, image.shape[1] // width, 1)
        return ((2 * both + n * m) // (2 * n * m)).astype(np.uint8)

    def axis(old: int, new: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.clip((np.arange(new) + 0.5) * old / new - 0.5, 0, old - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, old - 1), at - low

    y0, y1, fy = axis(image.shape[0], height)
    x0, x1, fx = axis(image.shape[1], width)
    a = image.astype(float)
    rows = a[y0] * (1 - fy)[:, None] + a[y1] * fy[:, None]
    return np.floor(rows[:, x0] * (1 - fx) + rows[:, x1] * fx + 0.5).astype(np.uint8)


def cubic(image: np.ndarray, height: int, width: int, sharp: float = -0.75) -> np.ndarray:
    """Cubic resize with pixel centres aligned; borders repeat, results are rounded half up and clipped."""

    def axis(a: np.ndarray, new: int) -> np.ndarray:
        old = a.shape[0]
        at = (np.arange(new) + 0.5) * old / new - 0.5
        low = np.floor(at).astype(int)
        out = 0.0
        for k in range(-1, 3):
            d = np.abs(at - low - k)
            near = (sharp + 2) * d**3 - (sharp + 3) * d**2 + 1
            far = sharp * (d**3 - 5 * d**2 + 8 * d - 4)
            out = out + np.where(d <= 1, near, np.where(d < 2, far, 0.0))[:, None] * a[np.clip(low + k, 0, old - 1)]
        return out

    both = axis(axis(image.astype(float), height).T, width).T
    return np.clip(np.floor(both + 0.5), 0, 255).astype(np.uint8)


def pad_top(image: np.ndarray, least: int = 130) -> np.ndarray:
    """White rows on top up to a least height."""
    return np.pad(image, ((max(0, least - image.shape[0]), 0), (0, 0)), constant_values=255)


# Weights of ITU-R BT.601 luma and chroma.
LUMA = np.array([0.299, 0.587, 0.114])
CR, CB = 0.713, 0.564


def luma_chroma(rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Y, Cr and Cb (around 128) of an image of three channels."""
    r, g, b = (rgb[..., k].astype(float) for k in range(3))
    y = LUMA[0] * r + LUMA[1] * g + LUMA[2] * b
    parts = y, (r - y) * CR + 128, (b - y) * CB + 128
    return tuple(np.clip(np.floor(p + 0.5), 0, 255).astype(np.uint8) for p in parts)


def from_luma_chroma(y: np.ndarray, cr: np.ndarray, cb: np.ndarray) -> np.ndarray:
    """The image of three channels of Y, Cr and Cb."""
    y, cr, cb = (x.astype(float) for x in (y, cr - 128.0, cb - 128.0))
    rgb = np.stack([y + 1.403 * cr, y - 0.714 * cr - 0.344 * cb, y + 1.773 * cb], axis=-1)
    return np.clip(np.floor(rgb + 0.5), 0, 255).astype(np.uint8)


def profiles(image: np.ndarray, sx: int = 1, sy: int = 2, mask: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns of the shrunken frame divided by their mean, as it is and closed; zeros where the mean is 0."""
    small = resized(image, image.shape[0] // sy, image.shape[1] // sx) if (sx, sy) != (1, 1) else image

    def sums(a: np.ndarray) -> np.ndarray:
        v = a.sum(axis=0, dtype=np.int64).astype(float)
        return v / v.mean() if v.any() else v

    return sums(small), sums(small if mask is None else close(small, mask))


def jumps(rows: np.ndarray, steep: float) -> np.ndarray:
    """Whether each place but the first of each row differs by more than ``steep`` from the one before."""
    return np.abs(np.diff(rows, axis=1)) > steep


def first_jump(rows: np.ndarray, steep: float) -> np.ndarray:
    """Place before the first jump at 10 to n - 11 of each row; -1 without one."""
    n = rows.shape[1]
    inside = jumps(rows, steep)[:, 9 : max(9, n - 11)]
    return np.where(inside.any(axis=1), 9 + inside.argmax(axis=1), -1) if inside.shape[1] else np.full(len(rows), -1)


def last_jump(rows: np.ndarray, steep: float) -> np.ndarray:
    """Place of the last jump at 11 to n - 10 of each row; -1 without one."""
    n = rows.shape[1]
    inside = jumps(rows, steep)[:, 10 : max(10, n - 10)]
    return np.where(inside.any(axis=1), 10 + inside.shape[1] - inside[:, ::-1].argmax(axis=1), -1) if inside.shape[1] else np.full(len(rows), -1)


def region_mean(image: np.ndarray, rows: tuple[int, int], columns: tuple[int, int]) -> float | None:
    """Mean of rows and columns a to b (from 0, negative from the end, b exclusive); None if there are none."""
    (r0, r1), (c0, c1) = [[min(n, max(0, v + n if v < 0 else v)) for v in pair] for pair, n in ((rows, image.shape[0]), (columns, image.shape[1]))]
    part = image[r0:r1, c0:c1]
    return float(part.mean()) if part.size else None


def outline(image: np.ndarray, low: int, high: int = 255) -> tuple[np.ndarray, np.ndarray]:
    """``i`` and ``j`` (counted upward) of the left and rightmost pixel in (low, high] of each row and the topmost of each column."""
    h, w = image.shape
    hit = (image > low) & (image <= high)
    y, x = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    left, right, top = hit[y].argmax(axis=1), w - 1 - hit[y][:, ::-1].argmax(axis=1), hit[:, x].argmax(axis=0)
    code = np.unique(np.concatenate([left, right, x]) * h + h - 1 - np.concatenate([y, y, top]))
    return code // h, code % h


def greedy_path(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Order of points from the lowest (ties: leftmost), each time to the nearest one left (ties: lower, then more to the left).

    Points lie in cells of about two; a search goes over rings of cells until
    no farther one can hold a nearer point.  Where the next point is many rings
    away, all points that are left are looked at in one go.
    """
    by = np.lexsort((i, j))
    x, y, n = i[by].astype(float), j[by].astype(float), len(by)
    if not n:
        return by
    size = max(1.0, float(np.sqrt(max(1.0, np.ptp(x)) * max(1.0, np.ptp(y)) * 2 / n)))
    cx, cy = ((x - x.min()) // size).astype(int).tolist(), ((y - y.min()) // size).astype(int).tolist()
    cells: dict[tuple[int, int], list[int]] = {}
    for k in range(n):
        cells.setdefault((cx[k], cy[k]), []).append(k)
    rings = [[(0, 0)]] + [[(a, b) for a in range(-r, r + 1) for b in range(-r, r + 1) if max(abs(a), abs(b)) == r] for r in range(1, 7)]
    xs, ys = x.tolist(), y.tolist()
    low_x, low_y = float(x.min()), float(y.min())
    rest, gone = np.arange(n), np.zeros(n, bool)
    order, at = [], 0
    for left in range(n - 1, -1, -1):
        order.append(at)
        gone[at] = True
        here = cells[cx[at], cy[at]]
        here.remove(at)
        if not left:
            break
        px, py, col, row = xs[at], ys[at], cx[at], cy[at]
        # From the point to the nearest side of its cell.
        inner = min(px - low_x - col * size, (col + 1) * size - (px - low_x), py - low_y - row * size, (row + 1) * size - (py - low_y))
        best, found, r = np.inf, -1, 0
        for ring in rings:
            # What lies in this ring is at least so far away.
            if r and best < (inner + (r - 1) * size) ** 2:
                break
            for a, b in ring:
                for k in cells.get((col + a, row + b), ()):
                    d = (xs[k] - px) ** 2 + (ys[k] - py) ** 2
                    if d < best or (d == best and k < found):
                        best, found = d, k
            r += 1
        else:
            if best >= (inner + (r - 1) * size) ** 2:
                if 2 * left < len(rest):
                    rest = rest[~gone[rest]]
                d = np.where(gone[rest], np.inf, (x[rest] - px) ** 2 + (y[rest] - py) ** 2)
                found = int(rest[d.argmin()])
        at = found
    return by[np.array(order, dtype=int)]


def bottom_row(image: np.ndarray, every: int = 50, least: int = 2) -> int:
    """Above the lowest row whose sampled columns sum to more than ``least``, down to row 1; else 0."""
    found = np.flatnonzero(image[1:, ::every].sum(axis=1, dtype=np.int64) > least)
    return int(found[-1]) if len(found) else 0


def unified(image: np.ndarray, target: int, bottom: int, pad_bottom: int = 5) -> np.ndarray:
    """The rows above ``bottom`` but the last, white on top up to ``target - 1`` rows, black below."""
    keep = image[: max(0, bottom - 1)]
    return np.pad(np.pad(keep, ((max(0, target - 1 - len(keep)), 0), (0, 0)), constant_values=255), ((0, pad_bottom), (0, 0)))


def surface_height(image: np.ndarray, degrees: float, center: tuple[float, float], seed: int, above: int = 10, residual: float = 2.0, trials: int = 1000) -> int | None:
    """``above`` rows over the middle of the line through the edges of a frame turned about ``center``; None without one.

    The edges are those of the frame as it is; their places are turned, not its pixels.
    """
    y, x = np.nonzero(edges(image))
    t, dx, dy = np.deg2rad(degrees), x - float(center[0]), y - float(center[1])
    ends = line_ends(center[0] + np.cos(t) * dx + np.sin(t) * dy, center[1] - np.sin(t) * dx + np.cos(t) * dy, seed, residual, trials)
    return None if ends is None else int((ends[1] + ends[3]) // 2) - above


def line_ends(x: np.ndarray, y: np.ndarray, seed: int, residual: float, trials: int) -> tuple[float, float, float, float] | None:
    """x and y of both ends of the line that most points are near to; None without one."""
    line = ransac_line(y.astype(float), x.astype(float), seed, residual, trials)
    if line is None:
        return None
    low, high = float(x.min()), float(x.max())
    return low, line[1] + line[0] * low, high, line[1] + line[0] * high


@lru_cache(maxsize=4)
def _turn(degrees: float, center: tuple[float, float], shape: tuple[int, int]) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Where each pixel of a turned frame comes from in the frame with a rim, and the weights of the four pixels there.

    A run is turned by one angle, so that this is computed once for it.
    """
    t, (h, w) = np.deg2rad(degrees), shape
    dx, dy = np.arange(w) - center[0], (np.arange(h) - center[1])[:, None]
    sx = np.clip(center[0] + np.cos(t) * dx - np.sin(t) * dy + 1, 0, w + 0.999)
    sy = np.clip(center[1] + np.sin(t) * dx + np.cos(t) * dy + 1, 0, h + 0.999)
    x0, y0 = sx.astype(np.int32), sy.astype(np.int32)
    fx, fy = sx - x0, sy - y0
    weights = (1 - fx) * (1 - fy), fx * (1 - fy), (1 - fx) * fy, fx * fy
    return y0 * np.int32(w + 2) + x0, tuple(v.astype(np.float32) for v in weights)


def rotated(image: np.ndarray, degrees: float, center: tuple[float, float]) -> np.ndarray:
    """Rotation about (x, y), counter-clockwise for positive angles, bilinear."""
    at, weights = _turn(float(degrees), (float(center[0]), float(center[1])), image.shape)
    padded, wide = np.pad(image, 1, constant_values=255).ravel(), image.shape[1] + 2
    out = np.full(image.shape, 0.5, np.float32)
    for shift, weight in zip((0, 1, wide, wide + 1), weights, strict=True):
        out += padded[shift:].take(at) * weight
    return out.astype(np.uint8)


def edges(image: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Thin edges: gradient maxima above ``low`` that are connected to one above ``high``."""
    p = np.pad(image.astype(np.int16), 1, mode="edge")
    down, across = p[:-2] + 2 * p[1:-1] + p[2:], p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    gx, gy = down[:, 2:] - down[:, :-2], across[2:] - across[:-2]
    size = np.abs(gx) + np.abs(gy)
    # Only gradients that are steep enough get a direction.
    y, x = np.nonzero(size > low)
    here, q = size[y, x], np.pad(size, 1)
    sector = np.round(np.arctan2(gy[y, x], gx[y, x]) / (np.pi / 4)).astype(int) % 4
    dy, dx = np.array([0, 1, 1, 1])[sector], np.array([1, 1, 0, -1])[sector]
    peak = (here > q[y + 1 - dy, x + 1 - dx]) & (here >= q[y + 1 + dy, x + 1 + dx])
    at = y[peak] * image.shape[1] + x[peak]
    label = _labels(at, image.shape)
    strong = np.zeros(len(at), dtype=bool)
    strong[label[here[peak] > high]] = True
    found = np.zeros(image.shape, dtype=bool)
    found.ravel()[at[strong[label]]] = True
    return found


def _labels(at: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """For each place (ascending) of a mask the number of the last one of its 8-connected part."""
    h, w = shape
    place = np.full((h + 1, w + 2), -1, np.int32)
    y, x = at // w, at % w + 1
    place[y, x] = np.arange(len(at))
    pairs = [(np.flatnonzero(n >= 0), n[n >= 0]) for n in (place[y, x + 1], place[y + 1, x - 1], place[y + 1, x], place[y + 1, x + 1])]
    a, b = (np.concatenate(p) for p in zip(*pairs, strict=True))
    label = np.arange(len(at))
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low != high
        a, b = a[open_], b[open_]
        np.maximum.at(label, low[open_], high[open_])
        while (label[label] != label).any():
            label = label[label]
    return label


def components(mask: np.ndarray) -> np.ndarray:
    """Labels from 1 of the 8-connected parts of a mask, 0 outside: the place of a part's last pixel."""
    at = np.flatnonzero(mask)
    out = np.zeros(mask.size, dtype=np.int64)
    out[at] = at[_labels(at, mask.shape)] + 1
    return out.reshape(mask.shape)


def largest_component(mask: np.ndarray, least: int = 1) -> np.ndarray:
    """The largest part of a mask of at least ``least`` pixels (ties: the lowest); nothing if there is none."""
    found = components(mask)
    labels, sizes = np.unique(found[mask], return_counts=True)
    if not len(sizes) or sizes.max() < least:
        return np.zeros_like(mask)
    return found == labels[len(sizes) - 1 - sizes[::-1].argmax()]


def ransac_line(y: np.ndarray, x: np.ndarray, seed: int, residual: float = 1.0, trials: int = 500) -> tuple[float, float] | None:
    """Slope and intercept of the line most points are near to, refined over those; None for fewer than two x."""
    if len(np.unique(x)) < 2:
        return None
    rng = np.random.default_rng(seed)
    pairs = rng.integers(0, len(x), size=(trials, 2))
    pairs = pairs[x[pairs[:, 0]] != x[pairs[:, 1]]]
    if not len(pairs):
        pairs = np.array([[int(x.argmin()), int(x.argmax())]])
    slope = (y[pairs[:, 1]] - y[pairs[:, 0]]) / (x[pairs[:, 1]] - x[pairs[:, 0]])
    shift = y[pairs[:, 0]] - slope * x[pairs[:, 0]]
    # Some lines at a time, until a better one would have shown up all but surely.
    best, inside = -1, np.zeros(len(x), dtype=bool)
    for k in range(0, len(slope), 50):
        near = np.abs(y[None, :] - slope[k : k + 50, None] * x[None, :] - shift[k : k + 50, None]) <= residual
        count = near.sum(axis=1)
        if count.max() > best:
            best, inside = int(count.max()), near[count.argmax()]
        if (k + 50) * -np.log1p(-min(0.999999, (best / len(x)) ** 2)) > np.log(1e9):
            break
    if len(np.unique(x[inside])) < 2:
        return float(slope[0]), float(shift[0])
    fit = np.polyfit(x[inside], y[inside], 1)
    return float(fit[0]), float(fit[1])
