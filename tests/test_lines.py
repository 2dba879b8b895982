"""Operators along image axes against plain numpy."""

import numpy as np
import pytest

from wellspan.operators import lines

KINDS = "k long, y int, x int, v double"


@pytest.fixture(scope="module")
def made(spark):
    r = np.random.default_rng(0)
    images = {1: r.normal(size=(64, 64)), 2: r.normal(size=(33, 150)), 3: np.full((16, 16), 2.0), 4: r.normal(size=(1, 1))}
    rows = [(k, y, x, float(v)) for k, a in images.items() for (y, x), v in np.ndenumerate(a)]
    return images, spark.createDataFrame(rows, KINDS).repartition(4).cache()


def back(df, names, images):
    t = df.toPandas()
    out = {}
    for k, a in images.items():
        of = t[t.k == k]
        for n in names:
            out[k, n] = np.full(a.shape, np.nan)
            out[k, n][of.y, of.x] = of[n]
    return out


@pytest.mark.parametrize("radius", [1, 6])
def test_extremes_in_disks(made, radius):
    images, df = made
    got = {f: back(lines.extreme_in_disk(df, ["k"], radius, f is np.max), ["v"], images) for f in (np.max, np.min)}
    for k, a in images.items():
        ys, xs = np.indices(a.shape)
        for y, x in [(0, 0), (a.shape[0] // 2, a.shape[1] // 2), (a.shape[0] - 1, a.shape[1] - 1)]:
            near = a[(ys - y) ** 2 + (xs - x) ** 2 <= radius**2]
            for f, found in got.items():
                assert found[k, "v"][y, x] == f(near)


@pytest.mark.parametrize("width", [3, 51])
def test_local_threshold(made, width):
    images, df = made
    got = back(lines.local_threshold(df, ["k"], width), ["threshold"], images)
    for k, a in images.items():
        p = np.lib.stride_tricks.sliding_window_view(np.pad(a, width // 2, mode="reflect"), (width, width))
        want = p.mean((2, 3)) * (1 + 0.2 * (p.std((2, 3)) - 1))
        assert np.allclose(got[k, "threshold"], want, atol=1e-7)


@pytest.mark.parametrize("sigma", [1.0, 12.0, 500.0])
def test_blur(made, sigma):
    images, df = made
    got = back(lines.blurred(df, ["k"], sigma), ["v"], images)
    for k, a in images.items():
        out = a
        for n in a.shape:
            d = np.arange(n)[:, None] - np.arange(n)
            w = np.where(abs(d) <= max(1, int(4 * sigma + 0.5)), np.exp(-0.5 * (d / sigma) ** 2), 0)
            out = ((w / w.sum(1, keepdims=True)) @ out).T
        assert np.allclose(got[k, "v"], out, atol=1e-12)


def test_blur_passes_over_missing_pixels(spark):
    rows = [(1, 0, 0, 1.0), (1, 0, 2, 3.0), (1, 5, 0, None), (1, None, 0, 9.0)]
    got = {(r.y, r.x): r.v for r in lines.blurred(spark.createDataFrame(rows, KINDS), ["k"], 1.0).collect()}
    w = np.exp(-2.0)
    assert got.keys() == {(0, 0), (0, 2)} and got[0, 0] == pytest.approx((1 + 3 * w) / (1 + w))


def test_wide_windows_have_no_explode(made):
    plan = lines.blurred(made[1], ["k"], 500.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_spectrum_and_power_slope(made):
    images, df = made
    got = back(lines.spectrum(df, ["k"]), ["re", "im"], images)
    slopes = {r.k: r.power_slope for r in lines.power_slope(df, ["k"]).collect()}
    for k, a in images.items():
        assert np.allclose(got[k, "re"] + 1j * got[k, "im"], np.fft.fft2(a))
        h, w = a.shape
        near = [np.minimum(np.arange(n), n - 1 - np.arange(n)) for n in (h, w)]
        ring = np.floor(np.hypot(near[0][:, None], near[1])).astype(int) + 1
        power, rings = abs(np.fft.fft2(a)) ** 2, np.arange(2, min(h, w) // 8)
        want = np.polyfit(np.log(rings), np.log([power[ring == i].sum() for i in rings]), 1)[0] if len(rings) > 1 and a.std() else 0.0
        assert slopes[k] == pytest.approx(want)


def test_no_pixels(made):
    none = made[1].where("false")
    assert lines.power_slope(none, ["k"]).count() == 0 and lines.blurred(none, ["k"], 2.0).count() == 0
