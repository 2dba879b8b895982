"""Objects and paths that cross tiles, against plain searches over whole images."""

import heapq

import numpy as np
import pytest

from wellspan.operators import morphology, tiles


@pytest.mark.parametrize("size", [256, 16])
def test_connected(spark, size):
    r = np.random.default_rng(2)
    images = {1: r.random((50, 70)) < 0.45, 2: np.ones((9, 40), bool), 3: np.indices((33, 33)).sum(0) % 2 == 0}
    spiral = np.zeros((40, 40), bool)
    for k in range(0, 20, 4):
        spiral[k, k : 40 - k] = spiral[k : 40 - k, 39 - k] = spiral[39 - k, k : 40 - k] = spiral[k + 2 : 40 - k, k] = True
        spiral[k + 2, k : k + 4] = True
    images[4] = spiral
    df = spark.createDataFrame([(k, int(y) - 20, int(x)) for k, a in images.items() for y, x in np.argwhere(a)], "k long, y int, x int").repartition(3)
    got = {(p.k, p.y + 20, p.x): (p.first_.a + 20, p.first_.b) for p in tiles.connected(df, ["k"], morphology.kept, size).collect()}
    for k, a in images.items():
        seen = {}
        for p in map(tuple, np.argwhere(a).tolist()):
            todo = [] if p in seen else [p]
            seen.setdefault(p, p)
            while todo:
                y, x = todo.pop()
                for q in ((y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                    if 0 <= q[0] < a.shape[0] and 0 <= q[1] < a.shape[1] and a[q] and q not in seen:
                        seen[q] = p
                        todo.append(q)
        assert {p[1:]: v for p, v in got.items() if p[0] == k} == seen


@pytest.mark.parametrize("size", [256, 16])
@pytest.mark.parametrize("weight", [0.05, 3.0])
def test_propagated(spark, size, weight):
    r = np.random.default_rng(1)
    h, w = 30, 45
    image, inside, seed = r.random((h, w)), r.random((h, w)) < 0.8, np.zeros((h, w), int)
    for i, (y, x) in enumerate([(3, 3), (15, 30), (25, 40), (8, 40)], 1):
        seed[y : y + 2, x : x + 2] = i
    inside[:, 20] = False
    inside[5, 20] = True
    rows = [(1, y, x, float(image[y, x]), int(seed[y, x]), bool(inside[y, x])) for y in range(h) for x in range(w)]
    df = spark.createDataFrame(rows, "k long, y int, x int, v double, label int, inside boolean").repartition(3)
    cost = tiles.step_costs(np.pad(image, 2, mode="edge"), weight)
    best, todo = {}, [(0.0, int(seed[y, x]), y, x) for y in range(h) for x in range(w) if seed[y, x]]
    heapq.heapify(todo)
    while todo:
        d, label, y, x = heapq.heappop(todo)
        if (y, x) not in best:
            best[y, x] = label, d
            for (a, b), c in cost.items():
                q = y + a, x + b
                if 0 <= q[0] < h and 0 <= q[1] < w and inside[q] and not seed[q] and q not in best:
                    heapq.heappush(todo, (d + c[y, x], label, *q))
    got = {(p.y, p.x): p for p in tiles.propagated(df, ["k"], weight, morphology.kept, size).collect()}
    assert set(got) == {(y, x) for y in range(h) for x in range(w) if inside[y, x] or seed[y, x]}
    for at, p in got.items():
        assert p.label == best.get(at, (0,))[0] and (p.distance is None if at not in best else p.distance == pytest.approx(best[at][1]))


def test_equal_ways_go_to_the_lower_label(spark):
    rows = [(1, 0, x, 0.0, {0: 2, 4: 1}.get(x, 0), True) for x in range(5)]
    df = spark.createDataFrame(rows, "k long, y int, x int, v double, label int, inside boolean")
    for size in (256, 2):
        got = {p.x: p.label for p in tiles.propagated(df, ["k"], 1.0, morphology.kept, size).collect()}
        assert got == {0: 2, 1: 2, 2: 1, 3: 1, 4: 1}


def test_no_pixels(spark):
    none = spark.createDataFrame([], "k long, y int, x int, v double, label int, inside boolean")
    assert tiles.connected(none, ["k"], morphology.kept).count() == 0 and tiles.propagated(none, ["k"], 1.0, morphology.kept).count() == 0
