"""Image files that a filter rules out are never opened: here they hold no image at all."""

import numpy as np
import pytest

from wellspan.sources import plane_source


@pytest.fixture
def folder(tmp_path):
    for plate in ("p1", "p2"):
        for row, col in (("A", "01"), ("A", "02"), ("B", "01")):
            well = tmp_path / plate / row / col
            well.mkdir(parents=True)
            for field in (1, 2):
                np.save(well / f"{field}.npy", np.arange(2 * 3 * 4 * 5).reshape(2, 3, 4, 5) + field)
    return tmp_path


def test_all_planes(spark, folder):
    rows = plane_source.planes(spark, str(folder)).collect()
    assert len(rows) == 2 * 3 * 2 * 2 * 3
    one = next(r for r in rows if (r.plate, r.row, r.col, r.field, r.channel, r.plane) == ("p2", "B", "01", 2, 1, 2))
    assert (one.height, one.width) == (4, 5) and one.pixels == list(range(5 * 20 + 2, 6 * 20 + 2))


def test_ruled_out_files_are_not_opened(spark, folder):
    for path in [*folder.glob("p1/*/*/*.npy"), *folder.glob("p2/A/02/*.npy"), *folder.glob("p2/*/*/1.npy")]:
        path.write_bytes(b"no image")
    with pytest.raises(Exception):
        plane_source.planes(spark, str(folder)).count()
    read = plane_source.planes(spark, str(folder), [("p2", "A", "02")])
    some = read.where("plate = 'p2' and field in (2, 7) and channel = 1").collect()
    assert {(r.plate, r.row, r.col, r.field, r.channel) for r in some} == {("p2", "A", "01", 2, 1), ("p2", "B", "01", 2, 1)} and len(some) == 6


def test_an_empty_folder(spark, tmp_path):
    assert plane_source.planes(spark, str(tmp_path)).count() == 0
    assert plane_source.planes(spark, str(tmp_path)).where("plate = 'x' and plate = 'y'").count() == 0
