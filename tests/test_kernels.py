import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wellspan.functions import kernels as k
from wellspan.functions import numeric


@given(st.integers(-3, 3), st.integers(-3, 3))
@settings(max_examples=20, deadline=None)
def test_translation_is_found(dy, dx):
    image = np.random.default_rng(1).random((16, 16))
    assert k.translation(image, np.roll(image, (-dy, -dx), (0, 1))) == (dy, dx)


def test_blobs_and_blur():
    yy, xx = np.mgrid[:21, :21]
    spot = np.exp(-((yy - 10) ** 2 + (xx - 8) ** 2) / 8)
    assert (10, 8) in [b[:2] for b in k.blobs(spot)]
    assert k.gaussian(spot, 1.0).sum() == pytest.approx(spot.sum(), rel=1e-2)


@given(st.floats(1.5, 4.0))
@settings(max_examples=10, deadline=None)
def test_widths(sigma):
    profile = np.exp(-0.5 * ((np.arange(41) - 20) / sigma) ** 2)
    assert k.gaussian_fwhm(profile) == pytest.approx(2.3548 * sigma, rel=0.02)
    assert np.isnan(k.gaussian_fwhm(np.ones(5)))


def test_least_size():
    assert numeric.least_size(6, 2) == pytest.approx(np.pi) and numeric.least_size(6, 3, 5.0) == 5.0
