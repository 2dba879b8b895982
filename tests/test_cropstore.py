"""Crops with mask channels against slices of whole arrays."""

import tempfile

import numpy as np
import pytest

from wellspan.operators import cropstore

C, Z, H, W = 2, 2, 150, 140


def tables(spark, image, cells, nuclei, field):
    pixels = [(field, c, z, y, x, float(v)) for (c, z, y, x), v in np.ndenumerate(image)]
    masks = [(field, z, y, x, int(v), int(nuclei[z, y, x])) for (z, y, x), v in np.ndenumerate(cells)]
    return spark.createDataFrame(pixels, "field string, channel int, plane int, y int, x int, v double"), spark.createDataFrame(masks, "field string, plane int, y int, x int, cell int, nucleus int")


@pytest.fixture(scope="module")
def made(spark):
    r = np.random.default_rng(4)
    image, cells = r.integers(0, 60000, (C, Z, H, W)), np.zeros((Z, H, W), int)
    cells[:, 50:90, 55:80] = 1  # over a border of tiles
    cells[0, 20:24, 100:131] = 2
    cells[:, 0:9, 0:13] = 3  # above the frame
    cells[1, 120:121, 60:70] = 4  # one row
    cells[:, 100:103, 3:60] = 5  # to the left edge
    cells[:, 140:149, 100:139] = 6  # below the frame
    nuclei = np.where(r.random(cells.shape) < 0.5, cells, 0)
    pixels, masks = tables(spark, image, cells, nuclei, "f")
    return image, cells, nuclei, pixels.repartition(3), masks


def test_crops(made):
    image, cells, nuclei, pixels, masks = made
    crops = cropstore.cropped(pixels, masks, ["field"], C, Z, (H, W), 0, [1])
    got = {c.label: c for c in crops.collect()}
    assert set(got) == {1, 2, 5}
    for label, c in got.items():
        z, y, x = np.nonzero(cells == label)
        d = max(np.ptp(y), np.ptp(x), np.ptp(z))
        assert (c.W, c.H, c.diameter) == (np.ptp(y), np.ptp(x), d)
        cy, cx = round(y.mean()), round(x.mean())
        part = (slice(None), slice(cy - d // 2, cy + d // 2), slice(cx - d // 2, cx + d // 2))
        whole = np.concatenate([image[(slice(None), *part)], (cells[part] == label)[None], (nuclei[part] == label)[None]])
        assert list(c.shape) == list(whole.shape) and np.array_equal(np.array(c.pixels).reshape(whole.shape), whole)
        assert c.most == [whole[k].max() for k in range(C)]
        same = whole[2] == whole[3]
        assert c.correlations[0] == pytest.approx(np.corrcoef(whole[0][same], whole[1][same])[0, 1])


def test_without_nuclei_and_with_gaps(made):
    """Background rows of the masks may be missing, and so may pixels, which are 0."""
    image, cells, _, pixels, masks = made
    crops = cropstore.cropped(pixels.where("not (channel = 1 and y = 60)"), masks.where("cell > 0").drop("nucleus"), ["field"], C, Z, (H, W), 0, [1])
    c = {c.label: c for c in crops.collect()}[1]
    a = np.array(c.pixels).reshape(c.shape)
    assert a.shape[0] == 3 and not a[1, :, 60 - (c.centroid_y - c.diameter // 2)].any() and a[0].any()
    assert a[2].sum() == (cells[:, c.centroid_y - 19 : c.centroid_y + 19, c.centroid_x - 19 : c.centroid_x + 19] == 1).sum()
    assert c.correlations[0] is not None


def test_store_and_index(spark, made):
    *_, pixels, masks = made
    crops = cropstore.cropped(pixels, masks, ["field"], C, Z, (H, W), 0, [1])
    path = tempfile.mkdtemp(prefix="crops-", dir="/tmp")
    cropstore.stored(crops, path, ["field"], ["dna", "actin", "cell_mask", "nucl_mask"])
    back = spark.read.parquet(path)
    assert back.count() == 3 and back.first()["channels"] == ["dna", "actin", "cell_mask", "nucl_mask"]
    table = cropstore.index(back, ["field"], C, 0, [1])
    assert table.columns == ["field", "cell_index", "W", "H", "centroid_z", "centroid_y", "centroid_x", "diameter", "corr_0_1", "max0", "max1"]
    assert {r.cell_index for r in table.collect()} == {"0001", "0002", "0005"}


def test_no_cells(made):
    *_, pixels, masks = made
    assert cropstore.cropped(pixels, masks.where("cell > 99"), ["field"], C, Z, (H, W)).count() == 0
