"""Masked registration against a direct search over all shifts; warps by a matrix."""

import math

import numpy as np
import pytest

from wellspan.operators import alignment, morphology

KINDS = "k int, y int, x int, a double, ma double, b double, mb double"


def direct(a, ma, b, mb, overlap=0.3):
    h, w = a.shape
    found = {}
    for dy in range(1 - h, h):
        for dx in range(1 - w, w):
            here = (slice(max(0, dy), min(h, h + dy)), slice(max(0, dx), min(w, w + dx)))
            there = (slice(max(0, -dy), min(h, h - dy)), slice(max(0, -dx), min(w, w - dx)))
            both = (ma[here] * mb[there]) > 0
            p, q = a[here][both], b[there][both]
            r = np.corrcoef(p, q)[0, 1] if both.sum() > 1 and p.std() > 1e-6 and q.std() > 1e-6 else -np.inf
            found[dy, dx] = both.sum(), r
    most = max(n for n, _ in found.values())
    best = max(round(r, 9) for n, r in found.values() if n >= overlap * most)
    at = [s for s, (n, r) in found.items() if n >= overlap * most and round(r, 9) == best]
    return tuple(np.mean(at, axis=0)), best


def test_masked_shift(spark):
    r = np.random.default_rng(11)
    base = r.random((40, 40))
    images = {}
    for k, (dy, dx) in enumerate([(3, -2), (-4, 1), (0, 0)]):
        a, b = base[10:27, 10:31], base[10 + dy : 27 + dy, 10 + dx : 31 + dx] + r.normal(0, 0.02, (17, 21))
        images[k] = a, (r.random(a.shape) < 0.8) * 1.0, b, (r.random(a.shape) < 0.7) * 1.0, (dy, dx)
    rows = [(k, y + 5, x - 3, float(a[y, x]), float(ma[y, x]), float(b[y, x]), float(mb[y, x])) for k, (a, ma, b, mb, _) in images.items() for y in range(17) for x in range(21)]
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    got = {s.k: s for s in alignment.masked_shift(df, ["k"], morphology.kept).collect()}
    for k, (a, ma, b, mb, planted) in images.items():
        shift, best = direct(a, ma, b, mb)
        assert (got[k].dy, got[k].dx) == shift == planted and got[k].r == pytest.approx(best, abs=1e-6)


def test_nothing_in_common(spark):
    df = spark.createDataFrame([(1, y, x, 1.0, 1.0, 0.0, 0.0) for y in range(4) for x in range(4)], KINDS)
    assert alignment.masked_shift(df, ["k"], morphology.kept).count() == 0


def test_alignment_is_undone_by_its_matrix(spark):
    """A bright pattern, moved by three rows and five columns, comes back to its place."""
    r = np.random.default_rng(2)
    still = np.zeros((30, 30))
    still[8:20, 6:18] = 1 + r.random((12, 12))
    moved = np.zeros_like(still)
    moved[3:, 5:] = still[:-3, :-5]
    frame = lambda a: spark.createDataFrame([(1, y, x, float(v)) for (y, x), v in np.ndenumerate(a)], "k int, y int, x int, v double")
    for offset in ((0, 0), (-2, -4)):
        found = alignment.alignment(frame(still), frame(moved), ["k"], morphology.kept, offset)
        (m,) = found.collect()
        assert (m.matrix[2], m.matrix[5]) == (5.0, 3.0) and (m.dy, m.dx) == (-3.0 - offset[0], -5.0 - offset[1])
        back = {(p.y, p.x): p.v for p in alignment.warped(frame(moved), found, ["k"]).collect()}
        assert all(back[y, x] == still[y, x] for y in range(27) for x in range(25))


def test_warp_turns_and_scales(spark):
    r = np.random.default_rng(4)
    image = r.random((2, 21, 21))
    c, s = math.cos(0.3), math.sin(0.3)
    m = np.array([[c * 1.2, -s, 4.0], [s, c * 0.9, -2.5], [0, 0, 1]])
    rows = [(1, z, y, x, float(v)) for (z, y, x), v in np.ndenumerate(image)]
    df = spark.createDataFrame(rows, "k int, z int, y int, x int, v double")
    table = spark.createDataFrame([(1, [float(v) for v in m.ravel()])], "k int, matrix array<double>")
    got = {(p.z, p.y, p.x): p.v for p in alignment.warped(df, table, ["k"], ["z"]).collect()}
    assert len(got) == image.size
    for (z, y, x), v in got.items():
        sx, sy = (int(np.rint(t)) for t in (m @ [x, y, 1])[:2])
        assert v == (image[z, sy, sx] if 0 <= sy < 21 and 0 <= sx < 21 else 0.0)
