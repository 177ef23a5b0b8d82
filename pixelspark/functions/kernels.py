"""Array kernels for one tile: same shape in, same shape out."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

# Boundary names of image filters and their numpy equivalents.
PAD = {"symmetric": "symmetric", "reflect": "reflect", "nearest": "edge", "constant": "constant"}


def pad(a: np.ndarray, ry: int, rx: int, mode: str = "symmetric", cval: float = 0.0) -> np.ndarray:
    """Borders around the last two axes."""
    width = ((0, 0),) * (a.ndim - 2) + ((ry, ry), (rx, rx))
    if mode == "constant":
        return np.pad(a, width, mode="constant", constant_values=cval)
    return np.pad(a, width, mode=PAD[mode])


#: Bytes of window copies that a task holds at once.
WINDOW_BYTES = 16 << 20


def windows(a: np.ndarray, footprint: np.ndarray, mode: str) -> np.ndarray:
    """Values under the footprint at each pixel, on the last axis."""
    fy, fx = footprint.shape
    p = pad(a, fy // 2, fx // 2, mode)
    view = sliding_window_view(p, (fy, fx))[: a.shape[0], : a.shape[1]]
    return view[..., footprint]


def local(a: np.ndarray, footprint: np.ndarray, mode: str, stat: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``stat`` of the values under the footprint at each pixel of the last two axes. Windows are copied for a few rows (or arrays
    of a stack) at a time, so memory does not grow with the tile times the window."""
    fy, fx = footprint.shape
    p = pad(a, fy // 2, fx // 2, mode)
    view = sliding_window_view(p, (fy, fx), axis=(-2, -1))[..., : a.shape[-2], : a.shape[-1], :, :]
    step = max(1, WINDOW_BYTES // max(1, 8 * int(footprint.sum()) * (a[0].size if len(a) else 1)))
    return np.concatenate([stat(view[i:i + step][..., footprint]) for i in range(0, a.shape[0], step)])


LOCAL: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "mean": lambda w: w.mean(-1),
    "median": lambda w: np.median(w, axis=-1),
    "min": lambda w: w.min(-1),
    "max": lambda w: w.max(-1),
    "std": lambda w: w.std(-1),
    "sum": lambda w: w.sum(-1),
    "mean_over_std": lambda w: _ratio(w.mean(-1), w.std(-1)),
}


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(a.shape, np.nan), where=b > 0)


def correlate(a: np.ndarray, kernel: np.ndarray, mode: str = "symmetric", cval: float = 0.0) -> np.ndarray:
    """Weighted window sum over the last two axes; ``kernel[cy, cx]`` sits on the pixel."""
    ky, kx = kernel.shape
    p = pad(a, ky // 2, kx // 2, mode, cval)
    out = np.zeros(a.shape)
    for i, j in zip(*np.nonzero(kernel)):
        out += kernel[i, j] * p[..., i:i + a.shape[-2], j:j + a.shape[-1]]
    return out


def correlate_wide(a: np.ndarray, weights: np.ndarray, axis: int, mode: str = "symmetric") -> np.ndarray:
    """Weighted sum along one axis, for many weights: one matrix product per strip of the axis."""
    r, n = len(weights) // 2, a.shape[axis]
    p = pad(a, r if axis == 0 else 0, r if axis == 1 else 0, mode)
    p = p if axis == 0 else p.T
    step = 256
    band = np.zeros((step, step + 2 * r))
    for i in range(step):
        band[i, i:i + 2 * r + 1] = weights
    out = np.concatenate([band[:min(step, n - i), :min(step, n - i) + 2 * r] @ p[i:min(i + step, n) + 2 * r] for i in range(0, n, step)])
    return out if axis == 0 else out.T


def gaussian_weights(sigma: float, truncate: float = 4.0) -> np.ndarray:
    r = int(truncate * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2) if sigma > 0 else np.ones(1)
    return w / w.sum()


def gaussian(a: np.ndarray, sigma: float | tuple[float, float], mode: str = "symmetric",
             truncate: float = 4.0) -> np.ndarray:
    """Separable Gaussian; ``sigma`` may differ per axis."""
    sy, sx = sigma if isinstance(sigma, (tuple, list)) else (sigma, sigma)
    a = correlate(a, gaussian_weights(sy, truncate)[:, None], mode)
    return correlate(a, gaussian_weights(sx, truncate)[None, :], mode)


def gaussian_halo(sigma: float | tuple[float, float], truncate: float = 4.0) -> int:
    s = max(sigma) if isinstance(sigma, (tuple, list)) else sigma
    return int(truncate * s + 0.5)


def gradient(a: np.ndarray, axis: int) -> np.ndarray:
    """Central differences, one-sided at the array edge; zero on a single row or column."""
    return np.gradient(a, axis=axis) if a.shape[axis] > 1 else np.zeros(a.shape)


def eigen_2x2(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of [[a, b], [b, c]], larger first."""
    mid, root = (a + c) / 2, np.sqrt(((a - c) / 2) ** 2 + b ** 2)
    return mid + root, mid - root


def ball_background(a: np.ndarray, radius: int, core: tuple[slice, slice] | None = None) -> np.ndarray:
    """Height reached by a ball rolling under the surface, in the core; outside the array never limits it.

    The height is the minimum over offsets o of a[p+o] + r - sqrt(r^2 - |o|^2). Pixels are taken by cells. The lowest pixel of
    every cell gives a bound first; then a cell is looked at pixel by pixel only where its lowest value and the least rise
    between the cells could still lower that bound. For a radius of 200 that is a few of some 2,600 cells instead of
    125,000 offsets, with the same result.
    """
    core = core or (slice(0, a.shape[0]), slice(0, a.shape[1]))
    if np.isnan(a).any():
        a = np.where(np.isnan(a), np.inf, a)
    if radius < 12:  # few offsets: each one at once
        out, g = a.copy(), np.arange(-radius, radius + 1)
        d2 = g[:, None] ** 2 + g[None, :] ** 2
        p = pad(a, radius, radius, "constant", np.inf)
        for i, j in zip(*np.nonzero(d2 <= radius * radius)):
            np.minimum(out, p[i:i + a.shape[0], j:j + a.shape[1]] + (radius - np.sqrt(radius * radius - d2[i, j])), out=out)
        return out
    out = np.full(a.shape, np.nan)
    c = min(8, radius // 4)
    h, w = core[0].stop - core[0].start, core[1].stop - core[1].start
    k = radius // c + 1
    # the core at a corner of the cell grid, with whole cells and k more of them all around
    ny, nx = -(-h // c), -(-w // c)
    big = np.full(((ny + 2 * k) * c, (nx + 2 * k) * c), np.inf)
    top, left = core[0].start - k * c, core[1].start - k * c
    y0, x0, y1, x1 = max(0, top), max(0, left), min(a.shape[0], top + big.shape[0]), min(a.shape[1], left + big.shape[1])
    big[y0 - top:y1 - top, x0 - left:x1 - left] = a[y0:y1, x0:x1]
    cells = big.reshape(ny + 2 * k, c, nx + 2 * k, c).transpose(0, 2, 1, 3).reshape(ny + 2 * k, nx + 2 * k, c * c)
    lowest, low = cells.argmin(2), cells.min(2)
    low_y, low_x = lowest // c, lowest % c
    square = np.arange(radius * radius + 1)
    rise = np.concatenate([radius - np.sqrt(radius * radius - square), [np.inf]])
    inner = cells[k:k + ny, k:k + nx].copy()
    best = inner
    offsets = []
    for u in range(-k, k + 1):
        for v in range(-k, k + 1):
            near = max(0, abs(u) * c - c + 1) ** 2 + max(0, abs(v) * c - c + 1) ** 2
            if near <= radius * radius:
                offsets.append((rise[near], u, v))
    offsets.sort()
    py, px = np.divmod(np.arange(c * c), c)

    def open_cells(least: float, u: int, v: int) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(low[k + u:k + u + ny, k + v:k + v + nx] + least < best.max(2))

    for least, u, v in offsets:
        i, j = open_cells(least, u, v)
        if len(i):
            s, t = i + k + u, j + k + v
            d2 = (u * c + low_y[s, t][:, None] - py) ** 2 + (v * c + low_x[s, t][:, None] - px) ** 2
            best[i, j] = np.minimum(best[i, j], low[s, t][:, None] + rise[np.minimum(d2, radius * radius + 1)])
    for least, u, v in offsets:
        i, j = open_cells(least, u, v)
        if not len(i):
            continue
        d2 = (u * c + py[:, None] - py) ** 2 + (v * c + px[:, None] - px) ** 2  # from each pixel of the other cell to each of ours
        up = rise[np.minimum(d2, radius * radius + 1)]
        for a_ in range(0, len(i), 4096):
            m, n = i[a_:a_ + 4096], j[a_:a_ + 4096]
            src, now = cells[m + k + u, n + k + v], best[m, n]
            for q in range(c * c):
                np.minimum(now, src[:, q, None] + up[q], out=now)
            best[m, n] = now
    full = best.reshape(ny, nx, c, c).transpose(0, 2, 1, 3).reshape(ny * c, nx * c)
    out[core] = full[:h, :w]
    return out


def erode_min(a: np.ndarray, footprint: np.ndarray) -> np.ndarray:
    """Minimum under the footprint, over the last two axes; positions outside the array are ignored."""
    fy, fx = footprint.shape
    p = pad(a, fy // 2, fx // 2, "constant", np.inf)
    out = np.full(a.shape, np.inf)
    for i, j in zip(*np.nonzero(footprint)):
        np.minimum(out, p[..., i:i + a.shape[-2], j:j + a.shape[-1]], out=out)
    return out


def disk(radius: int) -> np.ndarray:
    g = np.arange(-radius, radius + 1)
    return g[:, None] ** 2 + g[None, :] ** 2 <= radius ** 2


def box_sum(a: np.ndarray, wy: int, wx: int) -> np.ndarray:
    """Sum over every full wy x wx window of the last two axes (valid positions only)."""
    c = np.zeros((*a.shape[:-2], a.shape[-2] + 1, a.shape[-1] + 1))
    c[..., 1:, 1:] = a.cumsum(-2).cumsum(-1)
    return c[..., wy:, wx:] - c[..., :-wy, wx:] - c[..., wy:, :-wx] + c[..., :-wy, :-wx]
