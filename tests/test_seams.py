"""Operators within tiles: what crosses seams, odd frames and nulls, against plain versions."""

import numpy as np
import plain_images as plain
import pytest
from test_morphology import table

from wellspan.operators import morphology, tiles


@pytest.mark.parametrize("radius", [1, 2])
def test_granularity_grows_back_over_seams(spark, radius):
    rng = np.random.default_rng(radius)
    snake = np.zeros((18, 26))
    snake[2:17, 2:5] = snake[14:17, 2:25] = 5.0  # rebuilt from one end, through several tiles
    snake[1:9, 1:9] = 9.0
    arrays = [rng.random((13, 17)), snake, rng.random((7, 5)), np.full((1, 1), 2.0)]
    p = table(spark, arrays).withColumnRenamed("image", "k").selectExpr("k", "y - 11 as y", "x - 3 as x", "v")
    made = tiles.rebuilt_erosions(p, ["k"], 3, morphology.disk(radius), radius, morphology.kept, 4)
    got = {(r["k"], r["step"]): r["left_"] for r in made.collect()}
    for i, a in enumerate(arrays):
        left = a.sum() * (1 - np.cumsum(plain.granularity(a, 3, radius)) / 100)
        assert [got[i, s] for s in (1, 2, 3)] == pytest.approx(list(left), abs=1e-9)


def test_granularity_needs_few_jobs(spark, monkeypatch):
    """A long way back to what was eroded is gone inside of a tile, not by a job a pixel."""
    calls = []
    monkeypatch.setattr(morphology, "kept", lambda df, own=morphology.kept: calls.append(1) or own(df))
    a = np.zeros((9, 120))
    a[3:6] = 1.0
    a[1:8, :8] = 3.0
    got = [r["removed"] for r in morphology.granularity(table(spark, [a]), ["image"], 3).orderBy("step").collect()]
    assert got == pytest.approx(plain.granularity(a, 3)) and len(calls) < 8


def test_image_math_meets_pixels_once(spark):
    from wellspan.operators import pixels

    p = table(spark, [np.arange(12.0).reshape(3, 4) / 20]).withColumnRenamed("image", "k")
    other = p.selectExpr("k", "y", "3 - x as x", "v")
    hows = ["add", "subtract", "multiply", "maximum"]
    all_ = pixels.several_math(p, other, ["k"], hows)
    assert all_._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
    got = sorted(map(tuple, all_.select("how", "y", "x", "v").collect()))
    assert got == sorted((h, r["y"], r["x"], r["v"]) for h in hows for r in pixels.math(p, other, ["k"], h).collect()) and len(got) == 48


@pytest.mark.parametrize("around", [64, 4])
def test_deconvolution_over_seams(spark, monkeypatch, around):
    monkeypatch.setattr(morphology, "MOST_AROUND", around)
    monkeypatch.setattr(tiles.local, "__defaults__", (8,))
    calls = []
    monkeypatch.setattr(morphology, "kept", lambda df, own=morphology.kept: calls.append(1) or own(df))
    rng = np.random.default_rng(6)
    a = rng.random((11, 19))
    psf = {(0, 0): 4.0, (0, 1): 2.0, (1, 0): 1.0, (-1, 0): 0.5}
    norm = sum(psf.values())

    def at(c, dy, dx):
        padded = np.pad(c, 1)
        return padded[1 + dy : 12 + dy, 1 + dx : 20 + dx]

    now = np.full(a.shape, a.mean())
    for _ in range(3):
        ratio = a / sum(w / norm * at(now, *d) for d, w in psf.items())
        now = now * sum(w / norm * at(ratio, -d[0], -d[1]) for d, w in psf.items())
    got = morphology.deconvolved(table(spark, [a]), ["image"], psf, 3).collect()
    assert len(got) == a.size and all(r["v"] == pytest.approx(now[r["y"], r["x"]]) for r in got)
    assert len(calls) == (0 if around == 64 else 1)  # a checkpoint a round before


def test_best_shift_and_closing_over_seams(spark, monkeypatch):
    monkeypatch.setattr(tiles.shift_products, "__defaults__", (4,))
    monkeypatch.setattr(tiles.local, "__defaults__", (4,))
    rng = np.random.default_rng(7)
    a = rng.random((13, 17))
    p = table(spark, [a]).selectExpr("image", "y - 5 as y", "x", "v")
    moved = p.selectExpr("image", "y - 2 as y", "x + 1 as x", "if(y = x, null, v) as v").where("(y + x) % 7 <> 0")
    assert [tuple(r) for r in morphology.best_shift(p, moved, ["image"], 3).collect()] == [(0, 2, -1)]
    assert morphology.best_shift(p, moved.where("false"), ["image"], 3).count() == 0
    m = (a > 0.7).astype(float)
    view = lambda c, g, out: g.reduce([np.pad(c, 1, constant_values=out)[1 + i : 14 + i, 1 + j : 18 + j] for i in (-1, 0, 1) for j in (-1, 0, 1)])
    want = view(view(m, np.maximum, -1), np.minimum, 9)
    got = morphology.closed_square(table(spark, [m]), ["image"]).collect()
    assert len(got) == m.size and all(r["v"] == want[r["y"], r["x"]] for r in got)


def test_objects_are_found_once(spark):
    """What every measure reads is made once: no plan of a measure labels the mask again."""
    from wellspan.plans.modules import compiled

    image = table(spark, [np.eye(6)])
    steps = [{"module": "IdentifyPrimary", "input": "a", "output": "o", "least": 3}, {"module": "MeasureGeometry", "objects": "o", "output": "g"}]
    made = compiled(steps, {"a": image})
    assert "Window" not in made["o"]._jdf.queryExecution().optimizedPlan().toString()
    assert [r["area"] for r in made["g"].collect()] == [6]
