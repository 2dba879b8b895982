"""Shifts of small images by fractions of a pixel: phase correlation, and cubic splines, in numpy.

Images have any number of axes; an axis of length 1 does not move.
"""

from __future__ import annotations

import itertools

import numpy as np

TINY = 1e-12


def _largest(score: np.ndarray, shifts: list[np.ndarray]) -> tuple[float, ...]:
    """The shift with the largest score (to nine digits), the nearest to none on ties, then the smallest."""
    score = np.round(score, 9)
    tied = [tuple(float(s[i]) for s, i in zip(shifts, at)) for at in np.argwhere(score == score.max())]
    return min(tied, key=lambda t: (round(sum(map(abs, t)), 9), t))


def _at(spectrum: np.ndarray, shifts: list[np.ndarray]) -> np.ndarray:
    """The inverse transform of a spectrum at any shifts, an axis at a time."""
    for axis, s in enumerate(shifts):
        n = spectrum.shape[axis]
        turns = np.exp(2j * np.pi * np.outer(s, np.fft.fftfreq(n)))
        spectrum = np.moveaxis(np.tensordot(turns, spectrum, (1, axis)), 0, axis)
    return spectrum


def fractional_shift(reference: np.ndarray, moving: np.ndarray, upsample: int = 5) -> tuple[tuple[float, ...], float]:
    """(shift, error): what moves ``moving`` onto ``reference``, to 1/``upsample`` of a pixel.

    Phase correlation gives the nearest whole shift (images repeat at their edges); around it
    the correlation is taken again in steps of 1/``upsample`` up to three quarters of a pixel
    away.  ``error`` is sqrt(1 - c²) of the images' own correlation c at that shift: 0 where
    one is a multiple of the other; an image of zeros has the error 1.
    """
    a, b = np.fft.fftn(reference), np.fft.fftn(moving)
    product = a * b.conj()
    phases = product / np.maximum(np.abs(product), TINY)
    whole = [np.rint(np.fft.fftfreq(n) * n) for n in reference.shape]
    best = _largest(np.abs(np.fft.ifftn(phases)), whole)
    reach = -(-3 * upsample // 4)
    steps = np.arange(-reach, reach + 1) / upsample
    fine = [np.array([0.0]) if n == 1 else s + steps for n, s in zip(reference.shape, best)]
    best = _largest(np.abs(_at(phases, fine)) / phases.size, fine)
    power = (np.abs(a) ** 2).sum() * (np.abs(b) ** 2).sum()
    c = np.abs(_at(product, [np.array([s]) for s in best])).item() if power > 0 else 0.0
    return best, float(np.sqrt(max(0.0, 1.0 - c * c / power))) if power > 0 else 1.0


def _spline(n: int, shift: float) -> np.ndarray:
    """The matrix that takes n values to those of their cubic spline ``shift`` places earlier; 0 outside."""

    def weights(x: np.ndarray) -> np.ndarray:
        """Values at ``x`` of cubic B-splines at the places 0 to n - 1, coefficients mirrored at the ends."""
        out = np.zeros((len(x), n))
        first = np.floor(x).astype(int) - 1
        for k in range(4):
            d = np.abs(x - (first + k))
            w = np.where(d < 1, 2 / 3 - d * d + d**3 / 2, np.maximum(2 - d, 0) ** 3 / 6)
            at = np.abs(first + k) % max(1, 2 * n - 2)
            np.add.at(out, (np.arange(len(x)), np.where(at >= n, 2 * n - 2 - at, at)), w)
        return out

    if n == 1:
        return np.eye(1) if shift == 0 else np.zeros((1, 1))
    x = np.arange(n) - shift
    inside = (x >= 0) & (x <= n - 1)
    made = np.zeros((n, n))
    made[inside] = weights(x[inside]) @ np.linalg.inv(weights(np.arange(n, dtype=float)))
    return made


def shifted(image: np.ndarray, shift: tuple[float, ...]) -> np.ndarray:
    """The image moved by ``shift`` with cubic splines; what comes from outside is 0."""
    for axis, s in enumerate(shift):
        if s:
            image = np.moveaxis(np.tensordot(_spline(image.shape[axis], float(s)), image, (1, axis)), 0, axis)
    return image


def two_class_threshold(image: np.ndarray, bins: int = 256) -> float:
    """The bin centre with the largest variance between classes, first on ties; of one value, that value."""
    low, high = float(image.min()), float(image.max())
    if high <= low:
        return low
    n, edges = np.histogram(image, bins)
    centre = (edges[1:] + edges[:-1]) / 2
    below, moment = np.cumsum(n), np.cumsum(n * centre)
    w1, w2 = below[:-1], below[-1] - below[:-1]
    gap = moment[:-1] / np.maximum(w1, 1) - (moment[-1] - moment[:-1]) / np.maximum(w2, 1)
    return float(centre[np.argmax(np.round(w1 * w2 * gap * gap / below[-1] ** 2, 12))])


def centre_of_mass(image: np.ndarray) -> tuple[float, ...]:
    total = image.sum()
    return tuple(float((image.sum(axis=tuple(set(range(image.ndim)) - {a})) * np.arange(n)).sum() / total) for a, n in enumerate(image.shape))


def border_diagonal(image: np.ndarray) -> np.ndarray:
    """Voxels of all planes at (i, i), for i in the first and last tenth of the rows."""
    n = image.shape[-2]
    tenth = round(n * 0.1)
    at = np.array([i for i in itertools.chain(range(tenth), range(n - tenth, n)) if i < image.shape[-1]], int)
    return image[..., at, at]


def trimmed(image: np.ndarray, by: int) -> np.ndarray:
    """Without ``by`` places at both ends of every axis that is long enough to lose them."""
    return image[tuple(slice(by, n - by) if n > 2 * by else slice(None) for n in image.shape)]


def as_uint16(image: np.ndarray) -> np.ndarray:
    """The image over its largest value, spread over 16 unsigned bits, halves to even."""
    top = image.max()
    return np.clip(np.rint(image / (top if top > 0 else 1.0) * 65535), 0, 65535).astype(np.int32)
