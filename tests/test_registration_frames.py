"""Registration evaluation: images in the frame of one tile against the same images met pixel by pixel."""

import numpy as np
import pytest

from wellspan.operators import morphology, registration


def test_evaluation_in_frames_and_over_tiles(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(morphology, "kept", lambda df, own=morphology.kept: calls.append(1) or own(df))
    rng, rows = np.random.default_rng(4), []

    def add(k, images, y0=0, x0=0):
        for (y, x), _ in np.ndenumerate(images[0]):
            rows.append((k, y0 + y, x0 + x, *(None if v is None or np.isnan(v) else float(v) for v in (i[y, x] for i in images))))

    spots = np.zeros((13, 22))
    spots[2:5, 2:6] = spots[7:11, 9:15] = spots[3:6, 17:20] = 50.0
    spots[10:, :4] = 60.0  # at the border
    add(0, [spots + rng.random(spots.shape), np.roll(spots, 1, 1) + rng.random(spots.shape), np.roll(spots, 4, 0)])
    holes = spots + rng.random(spots.shape)
    holes[3, 3] = holes[8, 10] = np.nan
    add(1, [holes, spots, np.roll(holes, 2, 1)], 5, 3)
    for k in range(2, 12):
        add(k, [np.round(rng.random((12, 18)) ** 20 * 100) for _ in range(3)], k, 2 * k)
    add(12, [np.full((6, 7), 9.0), spots[:6, :7], np.full((6, 7), np.nan)])  # constant, and nothing but nulls
    add(13, [np.full((6, 7), 0.1)] * 3)  # none bright enough
    add(14, [np.full((1, 1), 5.0)] * 3)
    p = spark.createDataFrame(rows, "k int, y int, x int, a double, b double, c double")
    plain = lambda df: {r["k"]: r.asDict() for r in df.collect()}
    whole = plain(registration.full_evaluation(p, ["k"], 0.5))
    assert not calls  # 4 checkpoints before, and sorts of all pixels between them
    cut = plain(registration.full_evaluation(p, ["k"], 0.5, 4))
    assert calls and set(whole) == set(cut) == set(range(15))
    assert whole[0]["nobj_ref"] == 3 and sum(whole[k]["nobj_ref"] for k in range(2, 12)) > 5
    for k, r in whole.items():
        for n, v in r.items():
            assert (v is None and cut[k][n] is None) or v == pytest.approx(cut[k][n], abs=1e-9), (k, n, v, cut[k][n])
