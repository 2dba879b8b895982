"""What one image needs that pixel tables cannot express: transforms, spots and fits, in numpy."""

from __future__ import annotations

import numpy as np


def translation(reference: np.ndarray, moving: np.ndarray) -> tuple[int, int]:
    """(dy, dx) that moves ``moving`` onto ``reference``: the peak of the phase correlation."""
    cross = np.fft.fft2(reference) * np.conj(np.fft.fft2(moving))
    peak = np.unravel_index(np.argmax(np.abs(np.fft.ifft2(cross / np.maximum(np.abs(cross), 1e-12)))), reference.shape)
    return tuple(int(p - n if p > n // 2 else p) for p, n in zip(peak, reference.shape))


def gaussian(image: np.ndarray, sigma: float) -> np.ndarray:
    """Separable blur; edges repeat."""
    radius = max(1, int(4 * sigma + 0.5))
    k = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    k /= k.sum()
    out = image.astype(float)
    for axis in (0, 1):
        padded = np.pad(out, [(radius, radius) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        out = np.apply_along_axis(lambda v: np.convolve(v, k, "valid"), axis, padded)
    return out


def blobs(image: np.ndarray, sigmas: tuple[float, ...] = (1.0, 2.0, 3.0), threshold: float = 0.01, border: int = 1) -> list[tuple[int, int, float]]:
    """(y, x, sigma) of maxima of the scale-normalised negative Laplacian of Gaussians."""
    def laplacian(g: np.ndarray) -> np.ndarray:
        p = np.pad(g, 1, mode="edge")
        return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g

    cube = np.stack([-(s**2) * laplacian(gaussian(image, s)) for s in sigmas])
    padded = np.pad(cube, 1, constant_values=-np.inf)
    n, h, w = cube.shape
    near = np.max([padded[1 + a : 1 + a + n, 1 + b : 1 + b + h, 1 + c : 1 + c + w] for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)], axis=0)
    s, y, x = np.nonzero((cube == near) & (cube > threshold))
    return sorted((int(b), int(c), sigmas[a]) for a, b, c in zip(s, y, x) if border <= b < h - border and border <= c < w - border)


def gaussian_fwhm(profile: np.ndarray, rounds: int = 50) -> float:
    """Full width at half maximum of a least-squares Gaussian; NaN if the fit fails."""
    x = np.arange(len(profile), dtype=float)
    base, top = float(profile.min()), float(profile.max())
    if top <= base:
        return float("nan")
    p = np.array([top - base, float(np.argmax(profile)), max(1.0, ((profile - base) > (top - base) / 2).sum() / 2.355), base])
    damp = 1e-2

    def off(p):
        return p[0] * np.exp(-0.5 * ((x - p[1]) / p[2]) ** 2) + p[3] - profile

    for _ in range(rounds):
        e = np.exp(-0.5 * ((x - p[1]) / p[2]) ** 2)
        j = np.stack([e, p[0] * e * (x - p[1]) / p[2] ** 2, p[0] * e * (x - p[1]) ** 2 / p[2] ** 3, np.ones_like(x)], axis=1)
        g = j.T @ j
        step = np.linalg.lstsq(g + damp * np.diag(np.diag(g) + 1e-9), -j.T @ off(p), rcond=None)[0]
        if (off(p + step) ** 2).sum() < (off(p) ** 2).sum():
            p, damp = p + step, damp / 3
        else:
            damp *= 4
    return float(abs(p[2]) * 2 * np.sqrt(2 * np.log(2))) if np.isfinite(p).all() else float("nan")
