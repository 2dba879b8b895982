"""Sub-pixel shifts against direct sums, splines, and an assembled spread function against the planted one."""

import numpy as np
import pytest

from wellspan.functions import fractions
from wellspan.operators import beads, morphology


def direct(a, b, upsample=5):
    """The same search with whole exponentials, shift by shift."""
    h, w = a.shape
    u, v = (np.rint(np.fft.fftfreq(n) * n) for n in (h, w))
    grid = lambda f: np.array([[(f * np.exp(-2j * np.pi * (p * np.arange(h)[:, None] / h + q * np.arange(w) / w))).sum() for q in v] for p in u])
    product = grid(a) * grid(b).conj()
    phase = product / np.maximum(abs(product), 1e-12)
    score = lambda s, t: round(abs((phase * np.exp(2j * np.pi * (u[:, None] * s / h + v * t / w))).sum()) / (h * w), 9)
    best = lambda shifts: min(shifts, key=lambda p: (-score(*p), round(abs(p[0]) + abs(p[1]), 9), p))
    s, t = best([(p, q) for p in u for q in v])
    r = range(-(-(-3 * upsample // 4)), -(-3 * upsample // 4) + 1)
    return best([(s + i / upsample, t + j / upsample) for i in r for j in r])


def test_shift_is_that_of_a_direct_search():
    r = np.random.default_rng(3)
    for shape in ((8, 8), (7, 6), (5, 9)):
        a, b = r.random(shape), r.random(shape)
        assert fractions.fractional_shift(a, b)[0] == pytest.approx(direct(a, b))


def blob(shape, middle, width=1.6):
    at = np.meshgrid(*map(np.arange, shape), indexing="ij")
    return np.exp(-0.5 * sum(((a - m) / width) ** 2 for a, m in zip(at, middle)))


@pytest.mark.parametrize("planted", [(0.0, 0.0, 0.0), (0.4, -1.2, 2.6), (-2.0, 0.2, -0.6)])
def test_planted_fractions_are_found(planted):
    still = blob((17, 21, 21), (8, 10, 10))
    moving = blob(still.shape, [m - s for m, s in zip((8, 10, 10), planted)])
    shift, error = fractions.fractional_shift(still, moving)
    assert shift == pytest.approx(planted, abs=0.1001) and error < 0.1
    back = fractions.shifted(moving, planted)
    assert np.abs(back - still)[3:-3, 4:-4, 4:-4].max() < 0.01


def test_edges_of_shifts():
    assert fractions.fractional_shift(np.zeros((4, 4)), np.ones((4, 4))) == ((0.0, 0.0), 1.0)
    assert fractions.fractional_shift(np.ones((1, 6)), np.ones((1, 6)))[0] == (0.0, 0.0)
    image = np.arange(20.0).reshape(4, 5)
    assert np.allclose(fractions.shifted(image, (1.0, -2.0)), np.pad(image, ((1, 0), (0, 2)))[:4, 2:])
    line = np.random.default_rng(1).random(30)
    assert np.allclose(fractions.shifted(line, (0.0,)), line)
    smooth = np.sin(np.arange(60) / 4)
    assert np.allclose(fractions.shifted(smooth, (0.3,))[8:-8], np.sin((np.arange(60) - 0.3) / 4)[8:-8], atol=1e-4)


def test_spread_function_is_recovered(spark):
    """Beads at places off by fractions, brightness and noise of their own, in two groups; one is odd."""
    r = np.random.default_rng(8)
    shape, rows = (9, 17, 17), []
    for group, width in (("a", 1.4), ("b", 2.0)):
        for k in range(14):
            at = [4 + r.uniform(-0.8, 0.8), 8 + r.uniform(-1.5, 1.5), 8 + r.uniform(-1.5, 1.5)]
            image = r.uniform(200, 900) * (blob(shape, at, width) + r.normal(0, 0.01, shape) + 0.05)
            rows.append((group, k, [float(v) for v in image.ravel()]))
    rows += [("a", 98, [1.0] * int(np.prod(shape))), ("a", 99, None), ("a", 97, [0.0] * 3), ("lone", 1, rows[0][2])]
    df = spark.createDataFrame(rows, "channel string, bead int, pixels array<double>").repartition(5)
    found = {p.channel: p for p in beads.assembled(df, ["channel"], "bead", shape, morphology.kept).collect()}
    assert set(found) == {"a", "b"}
    for group, width in (("a", 1.4), ("b", 2.0)):
        p = found[group]
        assert 9 <= p.n_beads <= 13 and list(p.shape) == [5, 13, 13] and max(p.psf) == 65535 and min(p.psf_clear) == 0
        psf = np.array(p.psf).reshape(5, 13, 13) / 65535
        # The middle of 17 rows is row 8, that of 9 planes plane 4: 6 and 2 after trimming.
        planted = blob((5, 13, 13), (2, 6, 6), width)
        assert np.unravel_index(psf.argmax(), psf.shape) == (2, 6, 6)
        assert np.abs(psf - planted).max() < 0.12


def test_no_beads(spark):
    df = spark.createDataFrame([], "channel string, bead int, pixels array<double>")
    assert beads.assembled(df, ["channel"], "bead", (3, 5, 5), morphology.kept).count() == 0
