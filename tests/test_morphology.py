"""Neighbourhood operators on pixel tables against plain versions of single images."""

import numpy as np
import plain_images as plain
import pytest

from wellspan.operators import measures, morphology


def table(spark, arrays, value="v"):
    rows = [(i, y, x, float(a[y, x])) for i, a in enumerate(arrays) for y in range(a.shape[0]) for x in range(a.shape[1])]
    return spark.createDataFrame(rows, f"image int, y int, x int, {value} double")


def image_of(rows, i, shape, value):
    out = np.zeros(shape)
    for r in rows:
        if r["image"] == i:
            out[r["y"], r["x"]] = r[value]
    return out


@pytest.fixture(scope="module")
def masks():
    rng = np.random.default_rng(3)
    return [rng.random((9, 13)) > 0.45, np.ones((5, 5), bool), np.eye(7, dtype=bool)]


def test_components_and_watershed(spark, masks):
    p = table(spark, masks).where("v > 0").select("image", "y", "x")
    found, split = morphology.components(p, ["image"]).collect(), morphology.watershed(p, ["image"]).collect()
    for i, m in enumerate(masks):
        assert (image_of(found, i, m.shape, "label") == plain.labelled(m)).all()
        assert (image_of(split, i, m.shape, "label") == plain.watershed(m)).all()
    assert morphology.components(p.where("false"), ["image"]).count() == 0 and morphology.watershed(p.where("false"), ["image"]).count() == 0


def test_granularity(spark):
    rng = np.random.default_rng(4)
    arrays = [rng.random((8, 8)), np.zeros((8, 8)), np.ones((6, 6))]
    got = {(r["image"], r["step"]): r["removed"] for r in morphology.granularity(table(spark, arrays), ["image"], 3).collect()}
    for i, a in enumerate(arrays):
        if a.sum():
            assert [got[i, s] for s in (1, 2, 3)] == pytest.approx(plain.granularity(a, 3))
        else:
            assert got[i, 1] is None


def test_holes_borders_growth(spark):
    ring = np.zeros((7, 7))
    ring[1:6, 1:6] = 1
    ring[3, 3] = 0
    filled = image_of(morphology.holes_filled(table(spark, [ring]), ["image"]).collect(), 0, ring.shape, "v")
    assert filled[3, 3] == 1 and filled.sum() == 25
    label = np.zeros((5, 5))
    label[0, 0], label[2, 2] = 1, 2
    df = table(spark, [label], "label").selectExpr("image", "y", "x", "cast(label as int) as label")
    assert [r["label"] for r in morphology.border_cleared(df, ["image"]).collect()] == [2]
    grown = image_of(morphology.propagated(df, ["image"]).collect(), 0, label.shape, "label")
    assert (grown == plain.propagated(label.astype(int), np.ones((5, 5), bool))).all()
    block = np.pad(np.ones((5, 5)), 1)
    assert morphology.shrunk(table(spark, [block], "label"), ["image"], 1).count() == 9


def test_deconvolution_sharpens(spark):
    psf = {(a, b): float(np.exp(-(a * a + b * b) / 2)) for a in range(-2, 3) for b in range(-2, 3)}
    point = np.zeros((13, 13))
    for (a, b), w in psf.items():
        point[6 + a, 6 + b] = w / sum(psf.values())
    sharp = image_of(morphology.deconvolved(table(spark, [point]), ["image"], psf, 8).collect(), 0, point.shape, "v")
    assert sharp.argmax() == 6 * 13 + 6 and sharp.max() > 2 * point.max()


def test_geometry_of_known_shapes(spark):
    square, ring = np.zeros((6, 6)), np.zeros((7, 7))
    square[1:5, 1:5] = 1
    ring[1:6, 1:6] = 1
    ring[3, 3] = 0
    df = table(spark, [square, ring], "label").selectExpr("image", "y", "x", "cast(label as int) as label")
    got = {r["image"]: r for r in measures.geometry(df, ["image"]).collect()}
    assert got[0]["area"] == 16 and got[0]["perimeter"] == 12 and got[0]["euler"] == 1 and got[1]["euler"] == 0
    assert got[0]["form_factor"] == pytest.approx(4 * np.pi * 16 / 144)
