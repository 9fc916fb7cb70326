"""Tissue masks with numpy kernels: threshold, morphology, components, hulls."""

from __future__ import annotations

import numpy as np

# Fixed value: weights of the 5-tap smoothing.
SMOOTH = np.array([1, 4, 6, 4, 1], float) / 16
SMALL_KERNEL, LARGE_KERNEL = 7, 51


def area_resize(image: np.ndarray, factor: float) -> np.ndarray:
    """Mean over the source area of every target pixel."""
    for axis in (0, 1):
        n = image.shape[axis]
        m = max(1, round(n * factor))
        sums = np.concatenate([np.zeros_like(image.take([0], axis), float), np.cumsum(image, axis, dtype=float)], axis)
        edges = np.linspace(0, n, m + 1)
        low = np.floor(edges).astype(int)
        part = (edges - low).reshape([-1 if k == axis else 1 for k in (0, 1)])
        at = sums.take(low, axis) * (1 - part) + sums.take(np.minimum(low + 1, n), axis) * part
        image = np.diff(at, axis=axis) / (n / m)
    return image


def smooth(image: np.ndarray) -> np.ndarray:
    for axis in (0, 1):
        pad = [(2, 2) if k == axis else (0, 0) for k in (0, 1)]
        wide = np.pad(image, pad, mode="reflect" if image.shape[axis] > 2 else "edge")
        n = image.shape[axis]
        image = sum(w * wide.take(range(k, k + n), axis) for k, w in enumerate(SMOOTH))
    return image


def otsu(image: np.ndarray) -> int:
    """The threshold with the greatest variance between both sides."""
    counts = np.bincount(image.ravel(), minlength=256).astype(float)
    weight = np.cumsum(counts)
    mean = np.cumsum(counts * np.arange(256))
    other = weight[-1] - weight
    with np.errstate(divide="ignore", invalid="ignore"):
        between = np.nan_to_num((mean[-1] * weight / weight[-1] - mean) ** 2 / (weight * other))
    return int(np.argmax(between))


def half_widths(size: int) -> list[int]:
    """Half widths of the rows of an ellipse of odd size."""
    r = size // 2
    return [round(r * np.sqrt(1 - (dy / r) ** 2)) if r else 0 for dy in range(-r, r + 1)]


def dilate(mask: np.ndarray, size: int) -> np.ndarray:
    """Dilation by an ellipse, row by row with running sums; nothing is set outside the image."""
    height, width = mask.shape
    out = np.zeros_like(mask)
    sums = np.zeros((height, width + 1), np.int32)
    np.cumsum(mask, axis=1, out=sums[:, 1:])
    wide: dict[int, np.ndarray] = {}
    columns = np.arange(width)
    r = size // 2
    for dy, w in zip(range(-r, r + 1), half_widths(size)):
        if w not in wide:
            wide[w] = sums[:, np.minimum(columns + w + 1, width)] > sums[:, np.maximum(columns - w, 0)]
        a, b = max(0, dy), min(height, height + dy)
        if a < b:
            out[a:b] |= wide[w][a - dy : b - dy]
    return out


def erode(mask: np.ndarray, size: int) -> np.ndarray:
    """Erosion; outside the image counts as set."""
    return ~dilate(~mask, size)


def close(mask: np.ndarray, size: int) -> np.ndarray:
    """Closing within the bounding box of the set pixels and the kernel around it."""
    box = bounding_box(mask)
    if box is None:
        return mask
    top, left, bottom, right = box
    pad = size
    a, b = max(0, top - pad), min(mask.shape[0], bottom + pad + 1)
    c, d = max(0, left - pad), min(mask.shape[1], right + pad + 1)
    out = mask.copy()
    out[a:b, c:d] = erode(dilate(mask[a:b, c:d], size), size)
    return out


def open_(mask: np.ndarray, size: int) -> np.ndarray:
    return dilate(erode(mask, size), size)


def bounding_box(mask: np.ndarray) -> tuple[int, int, int, int] | None:
    """First and last row and column with set pixels (top, left, bottom, right), None if there are none."""
    rows, columns = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    return (int(rows[0]), int(columns[0]), int(rows[-1]), int(columns[-1])) if len(rows) else None


def runs(mask: np.ndarray) -> np.ndarray:
    """(row, start, end) of all horizontal runs of set pixels, end exclusive."""
    edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edges == 1)
    _, end = np.nonzero(edges == -1)
    return np.stack([row, start, end], axis=1)


def components(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of a mask and the component of each, 8-connected."""
    r = runs(mask)
    parent = list(range(len(r)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    begin = np.searchsorted(r[:, 0], np.arange(mask.shape[0] + 1))
    for y in range(1, mask.shape[0]):
        i, j = begin[y - 1], begin[y]
        while i < begin[y] and j < begin[y + 1]:
            if r[i, 1] <= r[j, 2] and r[j, 1] <= r[i, 2]:
                a, b = find(i), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if r[i, 2] < r[j, 2]:
                i += 1
            else:
                j += 1
    return r, np.array([find(i) for i in range(len(r))], int)


def paint(shape: tuple[int, int], r: np.ndarray) -> np.ndarray:
    edges = np.zeros((shape[0], shape[1] + 1), np.int32)
    np.add.at(edges, (r[:, 0], r[:, 1]), 1)
    np.add.at(edges, (r[:, 0], r[:, 2]), -1)
    return np.cumsum(edges, axis=1)[:, :-1] > 0


def drop_small(mask: np.ndarray, least: int) -> np.ndarray:
    """Without components of fewer than ``least`` pixels."""
    r, label = components(mask)
    if not len(r):
        return mask
    area = np.bincount(label, weights=r[:, 2] - r[:, 1], minlength=len(r))
    return paint(mask.shape, r[area[label] >= least])


def fill_holes(mask: np.ndarray) -> np.ndarray:
    """Unset regions (8-connected) that do not reach the border are set."""
    r, label = components(~mask)
    if not len(r):
        return mask
    border = (r[:, 0] == 0) | (r[:, 0] == mask.shape[0] - 1) | (r[:, 1] == 0) | (r[:, 2] == mask.shape[1])
    outside = np.zeros(len(r), bool)
    outside[label[border]] = True
    return mask | paint(mask.shape, r[~outside[label]])


def hull(points: np.ndarray) -> list[tuple[int, int]]:
    """Corners of the convex hull of (x, y) points in order."""
    ordered = sorted({(int(x), int(y)) for x, y in points})
    if len(ordered) < 3:
        return ordered

    def half(seq: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return half(ordered) + half(ordered[::-1])


def fill_hulls(mask: np.ndarray) -> np.ndarray:
    """Every component is replaced by its filled convex hull."""
    r, label = components(mask)
    spans = []
    for k in np.unique(label):
        own = r[label == k]
        corners = hull(np.concatenate([own[:, [1, 0]], np.stack([own[:, 2] - 1, own[:, 0]], axis=1)]))
        left: dict[int, float] = {}
        right: dict[int, float] = {}
        for (x0, y0), (x1, y1) in zip(corners, corners[1:] + corners[:1]):
            for y in range(min(y0, y1), max(y0, y1) + 1):
                xs = (x0, x1) if y0 == y1 else (x0 + (x1 - x0) * (y - y0) / (y1 - y0),) * 2
                left[y], right[y] = min(left.get(y, 1e9), *xs), max(right.get(y, -1.0), *xs)
        spans += [(y, int(np.ceil(left[y] - 1e-9)), int(np.floor(right[y] + 1e-9)) + 1) for y in left]
    return paint(mask.shape, np.array(spans, int)) if spans else mask


def tissue_mask(pixels: np.ndarray, downsample: float = 0.2, least_area: int = 1000) -> np.ndarray:
    """A 0/1 mask of the tissue on a bright slide; all 0 without tissue."""
    grey = pixels.max(axis=2) if pixels.ndim == 3 else pixels
    small = np.rint(smooth(np.rint(area_resize(grey, downsample)))).astype(np.uint8)
    if small.min() == small.max():
        return np.zeros(grey.shape, np.uint8)
    dark = small <= otsu(small)
    dark = drop_small(open_(close(dark, SMALL_KERNEL), SMALL_KERNEL), least_area)
    if not dark.any():
        return np.zeros(grey.shape, np.uint8)
    rows = np.minimum((np.arange(grey.shape[0]) * dark.shape[0] / grey.shape[0]).astype(int), dark.shape[0] - 1)
    columns = np.minimum((np.arange(grey.shape[1]) * dark.shape[1] / grey.shape[1]).astype(int), dark.shape[1] - 1)
    full = fill_hulls(fill_holes(dark[np.ix_(rows, columns)]))
    return close(full, LARGE_KERNEL).astype(np.uint8)


def crop(pixels: np.ndarray, mask: np.ndarray, padding: int = 5) -> np.ndarray | None:
    """The image within the mask's bounding box and a padding; None for an empty mask."""
    box = bounding_box(mask > 0)
    if box is None:
        return None
    top, left, bottom, right = box
    return pixels[max(0, top - padding) : min(mask.shape[0] - 1, bottom + padding) + 1, max(0, left - padding) : min(mask.shape[1] - 1, right + padding) + 1]
