"""Plain numpy versions of neighbourhood operators, for small images in tests."""

import numpy as np


def labelled(mask: np.ndarray) -> np.ndarray:
    """Connected components (eight neighbours), numbered from 1 in reading order."""
    h, w = mask.shape
    label = np.where(mask, np.arange(1, h * w + 1).reshape(h, w), 0)
    while True:
        low = np.where(label > 0, label, h * w + 1)
        padded = np.pad(low, 1, constant_values=h * w + 1)
        near = np.min([padded[1 + a : 1 + a + h, 1 + b : 1 + b + w] for a in (-1, 0, 1) for b in (-1, 0, 1)], axis=0)
        new = np.where(mask, near, 0)
        if np.array_equal(new, label):
            break
        label = new
    return np.unique(label, return_inverse=True)[1].reshape(h, w) + (0 if (label == 0).any() else 1)


def _around(image: np.ndarray, radius: int, outside: float) -> np.ndarray:
    padded = np.pad(image, radius, constant_values=outside)
    h, w = image.shape
    offsets = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if a * a + b * b <= radius * radius]
    return np.stack([padded[radius + a : radius + a + h, radius + b : radius + b + w] for a, b in offsets])


def eroded(image: np.ndarray, radius: int = 1) -> np.ndarray:
    """Grey erosion with a disk."""
    return _around(image, radius, np.inf if image.dtype.kind == "f" else np.iinfo(image.dtype).max if image.dtype.kind in "iu" else True).min(axis=0)


def dilated(image: np.ndarray, radius: int = 1) -> np.ndarray:
    return _around(image, radius, -np.inf if image.dtype.kind == "f" else np.iinfo(image.dtype).min if image.dtype.kind in "iu" else False).max(axis=0)


def propagated(seeds: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Grow seeds over the mask one pixel a round; ties go to the lower label."""
    big = np.iinfo(np.int64).max
    label = np.where(mask | (seeds > 0), seeds, 0).astype(np.int64)
    while True:
        p = np.pad(np.where(label > 0, label, big), 1, constant_values=big)
        near = np.minimum.reduce([p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:]])
        new = np.where((label == 0) & mask & (near < big), near, label)
        if np.array_equal(new, label):
            return label
        label = new


def distance_to_background(mask: np.ndarray) -> np.ndarray:
    """City-block distance to the nearest background pixel."""
    d, left = np.zeros(mask.shape, int), mask.copy()
    while left.any():
        d[left] += 1
        p = np.pad(left, 1)
        left = left & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    return d


def watershed(mask: np.ndarray) -> np.ndarray:
    """Split touching objects: flood from the peaks of the distance to the background."""
    d = distance_to_background(mask)
    peaks = (d > 0) & (d == dilated(d, 2))
    label = labelled(peaks)
    for level in range(int(d.max(initial=0)), 0, -1):
        label = propagated(label, mask & (d >= level))
    return label


def granularity(image: np.ndarray, steps: int = 8, radius: int = 1) -> list[float]:
    """Percent of the signal that each larger opening removes."""
    total = float(image.sum()) or 1.0
    before, out, current = float(image.sum()), [], image.astype(float)
    for _ in range(steps):
        current = eroded(current, radius)
        grown_, last = current, None
        while last is None or not np.array_equal(grown_, last):  # reconstruction under the image
            last, grown_ = grown_, np.minimum(dilated(grown_, radius), image)
        now = float(grown_.sum())
        out.append((before - now) / total * 100)
        before = now
    return out
