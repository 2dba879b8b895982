"""Cross-validated surfaces and thresholds along a regression line against plain versions."""

import numpy as np
import pytest

from wellspan.functions.numeric import SURFACE_TERMS
from wellspan.operators import costes, flatfield


def plain_ridge(image):
    h, w = image.shape
    ys, xs = np.nonzero(image)
    x, y, v = xs / (w - 1), ys / (w - 1), image[ys, xs]
    a = np.column_stack([x**i * y**j for i, j in SURFACE_TERMS])
    solve = lambda m, t, p: np.linalg.solve(m.T @ m + p * np.eye(15), m.T @ t)
    scores = []
    for p in flatfield.PENALTIES:
        r = []
        for out in np.array_split(np.arange(len(v)), 10):
            rest = np.setdiff1d(np.arange(len(v)), out)
            left = v[out] - a[out] @ solve(a[rest], v[rest], p)
            r.append(1 - (left**2).sum() / ((v[out] - v[out].mean()) ** 2).sum())
        scores.append(np.mean(r))
    best = int(np.argmax(scores))
    return flatfield.PENALTIES[best], scores[best], solve(a, v, flatfield.PENALTIES[best])


def test_ridge_is_a_plain_fit(spark):
    r = np.random.default_rng(3)
    y, x = np.indices((21, 21)) / 20
    images = {1: 5 + 2 * x - y * y + r.normal(0, 0.05, (21, 21)), 2: 3 + r.normal(0, 1.0, (21, 21)), 3: np.where(r.random((21, 21)) < 0.2, 0, 1 + x * y + r.normal(0, 0.3, (21, 21)))}
    rows = [(k, i, j, float(v)) for k, a in images.items() for (i, j), v in np.ndenumerate(a)]
    df = spark.createDataFrame(rows, "plate int, y int, x int, v double").repartition(4)
    got = {f.plate: f for f in flatfield.ridge_fits(df, ["plate"], 21).collect()}
    for k, a in images.items():
        penalty, score, fit = plain_ridge(a)
        assert got[k].penalty == penalty and got[k].score == pytest.approx(score, abs=1e-6) and np.allclose(got[k].fit_, fit, atol=1e-4)
    flat = flatfield.fitted_field(df, ["plate"], 21, validated=True)
    assert flat.count() == 3 * 441 and all(abs(v.flat - 1) < 1e-9 for v in flat.groupBy("plate").agg({"flat": "avg"}).withColumnRenamed("avg(flat)", "flat").collect())


def plain_costes(a, b, scale):
    on = (a > 0) | (b > 0)
    va, vb, c = a[on].var(ddof=1), b[on].var(ddof=1), np.cov(a[on], b[on])[0, 1]
    s = ((vb - va) + np.sqrt((vb - va) ** 2 + 4 * c * c)) / (2 * c)
    o = b[on].mean() - s * a[on].mean()
    k = int(max(a.max(), b.max()) * scale) + 1
    while k > 1 and k / scale > a.max() and s * k / scale + o > b.max():
        k -= 1
    while k > 2:
        below = (a < k / scale) | (b < s * k / scale + o)
        if below.sum() < 2 or (a[below].std() > 1e-9 and b[below].std() > 1e-9 and np.corrcoef(a[below], b[below])[0, 1] <= 1e-12):
            break
        k -= 1
    return k / scale, s * k / scale + o


def test_costes_thresholds(spark):
    r = np.random.default_rng(7)
    pairs = {}
    for k in range(12):
        noise = r.random(300) * 0.3, r.random(300) * 0.3
        signal = np.where(r.random(300) < 0.3, r.random(300) * 0.6, 0)
        pairs[k] = noise[0] + signal, noise[1] + signal * (-0.3 if k % 4 == 3 else 0.8) + (0.2 if k % 4 == 3 else 0)
    rows = [(k, float(x), float(y)) for k, (a, b) in pairs.items() for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "k int, a double, b double").repartition(3)
    got = {t.k: t for t in costes.thresholds(df, ["k"], 255).collect()}
    for k, (a, b) in pairs.items():
        assert (got[k].threshold_a, got[k].threshold_b) == pytest.approx(plain_costes(a, b, 255))
