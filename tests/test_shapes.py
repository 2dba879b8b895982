"""Shapes of objects against plain geometry."""

import math

import numpy as np
import pytest

from wellspan.operators import shapes

KINDS = "k long, label int, y int, x int, v double"


def blobs():
    """Disks, bars, single pixels, hollow and scattered objects in one image."""
    r = np.random.default_rng(3)
    made = {}
    y, x = np.indices((80, 80))
    made[1] = (y - 40) ** 2 + (x - 35) ** 2 <= 30**2
    made[2] = (abs(y - 40) <= 2) & (abs(x - 40) <= 30)
    made[3] = (y == 7) & (x == 9)
    made[4] = abs(y - x) <= 0
    made[5] = ((y - 40) ** 2 + (x - 40) ** 2 <= 20**2) & ((y - 40) ** 2 + (x - 40) ** 2 >= 12**2)
    made[6] = r.random((80, 80)) < 0.01
    made[7] = (r.random((80, 80)) < 0.6) & ((y - 30) ** 2 / 4 + (x - 50) ** 2 <= 100)
    made[8] = (y == 3) & (x < 5)
    values = r.random((80, 80))
    return made, values


def frame(spark, made, values):
    rows = [(1, k, int(y), int(x), float(values[y, x])) for k, m in made.items() for y, x in zip(*np.nonzero(m))]
    return spark.createDataFrame(rows + [(1, 0, 0, 0, 1.0)], KINDS).repartition(4)


@pytest.fixture(scope="module")
def table(spark):
    made, values = blobs()
    return made, values, frame(spark, made, values).cache()


def hull(points):
    points = sorted(set(points))
    if len(points) < 3:
        return points
    out = []
    for some in (points, points[::-1]):
        chain = []
        for p in some:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]) <= 0:
                chain.pop()
            chain.append(p)
        out += chain[:-1]
    return out


def test_hull_measures(table):
    made, _, df = table
    got = {r.label: r for r in shapes.hull_measures(df, ["k"]).collect()}
    assert set(got) == set(made)
    for k, m in made.items():
        points = [(int(a), int(b)) for a, b in zip(*np.nonzero(m))]
        h = np.array(hull(points), float)
        far = max(math.dist(a, b) for a in h for b in h)
        widths = [max(abs((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])) for c in h) / math.dist(a, b) for a, b in zip(h, np.roll(h, -1, 0))] if len(h) > 2 else [0.0]
        wide = hull([(2 * y + a, 2 * x + b) for y, x in points for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))])
        inside = np.ones((80, 80), bool)
        ys, xs = np.indices((80, 80)) * 2
        for a, b in zip(wide, [*wide[1:], wide[0]]):
            inside &= (b[0] - a[0]) * (xs - a[1]) - (b[1] - a[1]) * (ys - a[0]) >= 0
        r = got[k]
        assert (r.area, r.convex_area) == (len(points), inside.sum()) and r.corners == len(h)
        assert r.max_feret == pytest.approx(far) and r.min_feret == pytest.approx(min(widths)) and r.solidity == pytest.approx(len(points) / inside.sum())


def test_radii(table):
    made, _, df = table
    got = {r.label: r for r in shapes.radii(df, ["k"]).collect()}
    for k, m in made.items():
        wide = np.pad(m, 1)
        out = np.argwhere(~wide)
        d = np.sqrt([((out - p) ** 2).sum(1).min() for p in np.argwhere(wide)])
        assert (got[k].max_radius, got[k].mean_radius, got[k].median_radius) == pytest.approx((d.max(), d.mean(), np.median(d)))


def test_smallest_circle():
    r = np.random.default_rng(5)
    for n in (1, 2, 3, 10, 60):
        p = [tuple(map(float, q)) for q in r.integers(0, 30, (n, 2))]
        cy, cx, radius = shapes.smallest_circle(p)
        assert max(math.dist((cy, cx), q) for q in p) <= radius + 1e-9
        # No smaller circle: the points on it are not within a half plane.
        on = [math.atan2(q[0] - cy, q[1] - cx) for q in p if abs(math.dist((cy, cx), q) - radius) < 1e-7]
        if radius > 0:
            on = sorted(set(on))
            gaps = np.diff([*on, on[0] + 2 * math.pi])
            assert max(gaps) <= math.pi + 1e-6


def test_zernike(table):
    made, values, df = table
    circles = {r.label: r for r in shapes.enclosing_circles(df, ["k"]).collect()}
    shape, light = ({r.label: r for r in shapes.zernike(df, ["k"], 9, w).collect()} for w in (False, True))
    assert 3 not in shape and 3 not in light and len(shape) == len(made) - 1
    for k in shape:
        ys, xs = np.nonzero(made[k])
        c = circles[k]
        z = ((ys - c.circle_y) + 1j * (xs - c.circle_x)) / c.circle_r
        for n, m in shapes.degrees(9):
            radial = sum((-1) ** s * math.factorial(n - s) / (math.factorial(s) * math.factorial((n + m) // 2 - s) * math.factorial((n - m) // 2 - s)) * abs(z) ** (n - 2 * s) for s in range((n - m) // 2 + 1))
            poly = radial * np.exp(1j * m * np.angle(z))
            assert shape[k][f"magnitude_{n}_{m}"] == pytest.approx(abs(poly.sum()) / (math.pi * c.circle_r**2), abs=1e-8)
            total = (poly * values[ys, xs]).sum()
            assert light[k][f"magnitude_{n}_{m}"] == pytest.approx(abs(total) / len(ys), abs=1e-8)
            if abs(total) > 1e-6:
                assert math.cos(light[k][f"phase_{n}_{m}"] - math.atan2(total.real, total.imag)) == pytest.approx(1)


def test_magnitudes_do_not_turn(spark):
    """A quarter turn of an object leaves its magnitudes and its hull's measures."""
    made, values = blobs()
    turned = {k: np.rot90(m) for k, m in made.items()}
    a, b = ({r.label: r for r in shapes.zernike(frame(spark, m, v), ["k"], 6, True).collect()} for m, v in ((made, values), (turned, np.rot90(values))))
    for k in a:
        for n, m in shapes.degrees(6):
            assert a[k][f"magnitude_{n}_{m}"] == pytest.approx(b[k][f"magnitude_{n}_{m}"], abs=1e-9)


def test_no_objects(spark):
    none = spark.createDataFrame([(1, 0, 0, 0, 1.0)], KINDS)
    for f in (shapes.hull_measures, shapes.radii, shapes.enclosing_circles, shapes.zernike):
        assert f(none, ["k"]).count() == 0
