"""Images cut into tiles: what grows over many pixels grows inside a task, and only seams meet.

A pixel is shuffled once, to its tile (a few border pixels to the neighbouring tiles as well).
Numpy follows paths within a tile; rounds of Spark jobs are over what crosses a seam, so their
number grows with the tiles that a thing spans, not with its pixels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Side of a tile.
SIZE = 256

EIGHT = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]


def kinds(df: DataFrame, names: list[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in names)


def _tile(c: Column, size: int) -> Column:
    return F.floor(c / size).cast("int")


def tiled(pixels: DataFrame, key: list[str], values: list[str], size: int, halo: int = 0) -> DataFrame:
    """(key, ty_, tx_, p_): a row for each tile, with its pixels and those up to ``halo`` around it."""
    p = pixels.where("y is not null and x is not null").select(*key, F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), *values)
    near = lambda c: F.sequence(_tile(F.col(c) - halo, size), _tile(F.col(c) + halo, size))
    sent = p.withColumn("ty_", F.explode(near("y"))).withColumn("tx_", F.explode(near("x"))) if halo else p.withColumns({"ty_": _tile(F.col("y"), size), "tx_": _tile(F.col("x"), size)})
    return spread(sent, [*key, "ty_", "tx_"]).groupBy(*key, "ty_", "tx_").agg(F.collect_list(F.struct("y", "x", *values)).alias("p_"))


def spread(df: DataFrame, by: list[str]) -> DataFrame:
    """Dealt by key to as many tasks as a shuffle has partitions.

    Pixels compress to a hundredth of what a task needs to sort them, so partitions must not
    be put together by their size on the wire, as adaptive execution would.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


#: Most pixels of frames that are worked on at once.
AT_ONCE = 1 << 20


def frames(b: pa.RecordBatch, size: int, values: int) -> Iterator[tuple[np.ndarray, tuple[slice, slice], np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Tiles of one shape together: (rows of the batch, own part, first y, first x, here, values).

    ``here`` (tiles, height, width) tells where there are pixels, ``values`` are NaN elsewhere
    and where they are null; the own part lies among the pixels around it.
    """
    stops = b["p_"].offsets.to_numpy()
    if len(stops) < 2:
        return
    part, starts = slice(stops[0], stops[-1]), stops[:-1] - stops[0]
    fields = [b["p_"].values.field(k) for k in range(2 + values)]
    y, x = (c.to_numpy()[part].astype(np.int64) for c in fields[:2])
    v = [c.cast(pa.float64()).to_numpy(zero_copy_only=False)[part] for c in fields[2:]]
    tile = np.repeat(np.arange(b.num_rows), np.diff(stops))
    mine = (y // size == b["ty_"].to_numpy()[tile]) & (x // size == b["tx_"].to_numpy()[tile])
    big = np.iinfo(np.int64).max
    ends = []
    for c in (y, x):
        ends += [np.minimum.reduceat(c, starts), np.maximum.reduceat(c, starts), np.minimum.reduceat(np.where(mine, c, big), starts), np.maximum.reduceat(np.where(mine, c, -big), starts)]
    ya, yb, y0, y1, xa, xb, x0, x1 = ends
    has = np.flatnonzero(y0 < big)
    if not len(has):
        return
    shapes, which = np.unique(np.column_stack([yb - ya + 1, xb - xa + 1, y0 - ya, x0 - xa, y1 - y0 + 1, x1 - x0 + 1])[has], axis=0, return_inverse=True)
    order = np.argsort(which.ravel(), kind="stable")
    for (high, wide, dy, dx, h, w), rows in zip(shapes, np.split(has[order], np.cumsum(np.bincount(which.ravel()))[:-1]), strict=True):
        step = max(1, AT_ONCE // int(high * wide))
        for some in (rows[i : i + step] for i in range(0, len(rows), step)):
            n = np.diff(stops)[some]
            at = np.repeat(starts[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
            place = np.repeat(np.arange(len(some)), n), y[at] - np.repeat(ya[some], n), x[at] - np.repeat(xa[some], n)
            here = np.zeros((len(some), high, wide), bool)
            here[place] = True
            made = []
            for c in v:
                a = np.full(here.shape, np.nan)
                a[place] = c[at]
                made.append(a)
            yield some, (slice(dy, dy + h), slice(dx, dx + w)), ya[some], xa[some], here, made


def shifted(a: np.ndarray, offset: tuple[int, int], outside: float) -> np.ndarray:
    """What stands at (y + dy, x + dx) of each frame; ``outside`` beyond its edge."""
    out = np.full_like(a, outside)
    h, w = a.shape[-2:]
    to, fro = zip(*((slice(max(0, -d), min(n, n - d)), slice(max(0, d), min(n, n + d))) for d, n in zip(offset, (h, w))))
    if abs(offset[0]) < h and abs(offset[1]) < w:
        out[(..., *to)] = a[(..., *fro)]
    return out


def local(pixels: DataFrame, key: list[str], values: list[str], halo: int, f: Callable[[np.ndarray, list[np.ndarray]], np.ndarray], size: int = SIZE) -> DataFrame:
    """(key, y, x, v): ``f`` of frames of tiles, whose results depend on pixels up to ``halo`` away.

    ``f`` gets where pixels are and their values (NaN where null) and gives values of all of a
    frame (NaN: null); what its outer ``halo`` pixels come to is not used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, own, y0, x0, here, v in frames(b, size, len(values)):
                n, y, x = np.nonzero(here[(..., *own)])
                made = f(here, v)[(..., *own)][n, y, x]
                at = pa.array(rows[n])
                columns = [(y + own[0].start + y0[n]).astype(np.int32), (x + own[1].start + x0[n]).astype(np.int32)]
                yield pa.record_batch([*(b[c].take(at) for c in key), *map(pa.array, columns), pa.array(made, from_pandas=True)], names=[*key, "y", "x", "v"])

    return tiled(pixels, key, values, size, halo).mapInArrow(run, f"{kinds(pixels, key)}y int, x int, v double")


def shift_products(pixels: DataFrame, key: list[str], shifts: list[tuple[int, int]], reach: int, size: int = SIZE) -> DataFrame:
    """(key, s, p): for each tile the sum of ``w`` times ``v`` at the shift from it, where both are there.

    ``in_`` and ``moved_`` tell whether a pixel is one of ``v`` and of ``w``; products with
    nulls do not count, and a shift under which no pixels meet has no row.
    """
    steps = pa.array([{"dy": a, "dx": b} for a, b in shifts], pa.struct([("dy", pa.int32()), ("dx", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, own, _, _, _, (v, inside, w, moved) in frames(b, size, 4):
                w, moved = w[(..., *own)], moved[(..., *own)] == 1
                for k, d in enumerate(shifts):
                    there = lambda a: shifted(a, d, np.nan)[(..., *own)]  # noqa: B023, E731
                    met = ((there(inside) == 1) & moved).any(axis=(1, 2))
                    if not met.any():
                        continue
                    product = there(v) * w
                    sums = np.where(np.isnan(product).all(axis=(1, 2)), np.nan, np.nansum(product, axis=(1, 2)))[met]
                    at = pa.array(rows[met])
                    yield pa.record_batch([*(b[c].take(at) for c in key), steps.take(pa.array(np.full(len(sums), k))), pa.array(sums, from_pandas=True)], names=[*key, "s", "p"])

    return tiled(pixels, key, ["v", "in_", "w", "moved_"], size, reach).mapInArrow(run, f"{kinds(pixels, key)}s struct<dy:int,dx:int>, p double")


def first_pixels(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pixel of a mask, the first pixel in reading order that it is connected to (eight neighbours).

    Every pixel and every first pixel takes the least that is around, and then what that one
    has taken, so that long paths shorten by half each time.
    """
    y0, x0 = y.min(), x.min()
    h, w = int(y.max() - y0) + 3, int(x.max() - x0) + 3
    at = (y - y0 + 1).astype(np.int64) * w + (x - x0 + 1)
    out = h * w
    root = np.full(out + 1, out, np.int64)
    root[at] = at
    while True:
        before = root
        near = np.minimum.reduce([before[at + a * w + b] for a in (-1, 0, 1) for b in (-1, 0, 1)])
        root = before.copy()
        np.minimum.at(root, before[at], near)
        root[at] = np.minimum(root[at], near)
        root = root[root]
        if (root == before).all():
            return root[at] // w + y0 - 1, root[at] % w + x0 - 1


def _rooted(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stops = b["p_"].offsets.to_numpy()
            if len(stops) < 2:
                continue
            ys, xs = (b["p_"].values.field(k).to_numpy() for k in (0, 1))
            found = [first_pixels(ys[i:j], xs[i:j]) for i, j in zip(stops, stops[1:])]
            at, part = pa.array(np.repeat(np.arange(b.num_rows), np.diff(stops))), slice(stops[0], stops[-1])
            columns = [ys[part], xs[part], *(np.concatenate([f[k] for f in found]).astype(np.int32) for k in (0, 1))]
            yield pa.record_batch([*(b[c].take(at) for c in names), *map(pa.array, columns)], names=[*names, "y", "x", "ry_", "rx_"])

    return run


def _least_reachable(pairs: DataFrame, kept: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, least) over the undirected ``pairs`` (a, b): labels of neighbours, then labels of labels."""
    both = kept(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = kept(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("least")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "least"), "b").groupBy(F.col("a").alias("node")).agg(F.min("least").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("least").alias("was"), F.least("least", "near").alias("least"))
        further = labels.select(F.col("node").alias("least"), F.col("least").alias("next"))
        stepped = kept(hooked.join(further, "least", "left").select("node", "was", F.least("least", "next").alias("least")))
        labels = stepped.drop("was")
        if stepped.where("least <> was").isEmpty():
            return labels


def connected(mask: DataFrame, key: list[str], kept: Callable[[DataFrame], DataFrame], size: int = SIZE) -> DataFrame:
    """(key, y, x, first_): each pixel with the first pixel, in reading order, of its connected object."""
    tiles = tiled(mask, key, [], size)
    found = kept(tiles.mapInArrow(_rooted(key), f"{kinds(mask, key)}y int, x int, ry_ int, rx_ int"))
    first = F.struct(F.col("ry_").alias("a"), F.col("rx_").alias("b"))
    node = F.struct(*key, "ry_", "rx_")
    low = lambda c: F.pmod(F.col(c), F.lit(size))
    seam = found.where(low("y").isin(0, size - 1) | low("x").isin(0, size - 1)).withColumn("node", node)
    steps = F.array(*(F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in EIGHT if (a, b) > (0, 0)))
    sent = seam.select(*key, "y", "x", F.col("node").alias("a"), F.explode(steps).alias("d")).withColumns({"ny": F.col("y") + F.col("d.dy"), "nx": F.col("x") + F.col("d.dx")})
    across = sent.where((_tile(F.col("y"), size) != _tile(F.col("ny"), size)) | (_tile(F.col("x"), size) != _tile(F.col("nx"), size)))
    there = seam.select(*key, F.col("y").alias("ny"), F.col("x").alias("nx"), F.col("node").alias("b"))
    pairs = kept(across.join(there, [*key, "ny", "nx"]).select("a", "b").distinct())
    if pairs.isEmpty():
        return found.select(*key, "y", "x", first.alias("first_"))
    least = _least_reachable(pairs, kept).select("node", F.struct(F.col("least.ry_").alias("a"), F.col("least.rx_").alias("b")).alias("least_"))
    met = found.withColumn("node", node).join(least, "node", "left")
    return met.select(*key, "y", "x", F.coalesce("least_", first).alias("first_"))


def step_costs(image: np.ndarray, weight: float) -> dict[tuple[int, int], np.ndarray]:
    """Cost of a step from each pixel to each of its eight neighbours.

    The root of (summed absolute differences of the two 3 x 3 surroundings) squared plus
    ``weight`` squared for each axis that the step goes along.  ``image`` has a margin of two.
    """
    out = {}
    for a, b in EIGHT:
        gap = np.abs(image[1:-1, 1:-1] - image[1 + a : image.shape[0] - 1 + a, 1 + b : image.shape[1] - 1 + b])
        around = sum(gap[i : gap.shape[0] - 2 + i, j : gap.shape[1] - 2 + j] for i in range(3) for j in range(3))
        out[a, b] = np.sqrt(around * around + (abs(a) + abs(b)) * weight * weight)
    return out


def relaxed(cost: dict[tuple[int, int], np.ndarray], free: np.ndarray, far: np.ndarray, label: np.ndarray) -> None:
    """Shortest paths from what is known into ``free`` pixels, in place; equal ways go to the lower label.

    ``far`` and ``label`` have a margin of one; only what changed goes on to its neighbours.
    """
    inner = (slice(1, -1), slice(1, -1))
    h, w = free.shape
    moving = np.isfinite(far)
    while moving.any():
        changed = np.zeros_like(moving)
        for (a, b), c in cost.items():
            # From the neighbour at (a, b) to here; a step costs the same in both directions.
            there = (slice(1 + a, 1 + a + h), slice(1 + b, 1 + b + w))
            if not moving[there].any():
                continue
            way = np.where(moving[there], far[there] + c, np.inf)
            better = free & ((way < far[inner]) | ((way == far[inner]) & np.isfinite(way) & (label[there] < label[inner])))
            far[inner][better] = way[better]
            label[inner][better] = label[there][better]
            changed[inner] |= better
        moving = changed


_STATE = ("y0_ int, x0_ int, h_ int, w_ int, image_ binary, free_ binary, far_ binary, label_ binary, "
          "edge_ array<struct<y:int,x:int,far:double,label:bigint>>")


def _frame(r: dict) -> tuple[np.ndarray, ...]:
    h, w = r["h_"], r["w_"]
    image = np.frombuffer(r["image_"]).reshape(h + 4, w + 4)
    free = np.frombuffer(r["free_"], bool).reshape(h, w)
    return image, free, np.frombuffer(r["far_"]).reshape(h + 2, w + 2).copy(), np.frombuffer(r["label_"], np.int64).reshape(h + 2, w + 2).copy()


def _packed(own: dict, y0: int, x0: int, image: np.ndarray, free: np.ndarray, far: np.ndarray, label: np.ndarray, before: tuple[np.ndarray, np.ndarray]) -> dict:
    """A tile's state, and the pixels on its border that have changed, for its neighbours."""
    h, w = free.shape
    rim = np.zeros((h, w), bool)
    rim[[0, -1]] = rim[:, [0, -1]] = True
    y, x = np.nonzero(rim & ((far < before[0]) | (label != before[1]))[1:-1, 1:-1])
    edge = [{"y": int(y0 + i), "x": int(x0 + j), "far": float(far[i + 1, j + 1]), "label": int(label[i + 1, j + 1])} for i, j in zip(y, x)]
    return own | {"y0_": y0, "x0_": x0, "h_": h, "w_": w, "image_": image.tobytes(), "free_": free.tobytes(), "far_": far.tobytes(), "label_": label.tobytes(), "edge_": edge}


def _batch(row: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([row], schema=schema)


def _state_schema(own: pa.Schema, names: list[str]) -> pa.Schema:
    edge = pa.list_(pa.struct([("y", pa.int32()), ("x", pa.int32()), ("far", pa.float64()), ("label", pa.int64())]))
    numbers = [(c, pa.int32()) for c in ("y0_", "x0_", "h_", "w_")]
    blobs = [(c, pa.binary()) for c in ("image_", "free_", "far_", "label_")]
    return pa.schema([own.field(c) for c in names] + [pa.field(*x) for x in [*numbers, *blobs]] + [pa.field("edge_", edge)])


def _started(names: list[str], weight: float, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            schema = _state_schema(b.schema, names)
            for i in range(b.num_rows):
                p = b["p_"].slice(i, 1).flatten()
                y, x, v, seed, free_to = (p.field(k).to_numpy(zero_copy_only=False) for k in range(5))
                own = {c: b[c][i].as_py() for c in names}
                mine = (y // size == own["ty_"]) & (x // size == own["tx_"])
                if not mine.any():
                    continue
                y0, y1, x0, x1 = int(y[mine].min()), int(y[mine].max()), int(x[mine].min()), int(x[mine].max())
                h, w = y1 - y0 + 1, x1 - x0 + 1
                # Beyond the image's edge its last row or column goes on.
                ya, xa = max(y0 - 2, int(y.min())), max(x0 - 2, int(x.min()))
                yb, xb = min(y1 + 2, int(y.max())), min(x1 + 2, int(x.max()))
                near = (y >= ya) & (y <= yb) & (x >= xa) & (x <= xb)
                image = np.zeros((yb - ya + 1, xb - xa + 1))
                image[y[near] - ya, x[near] - xa] = v[near]
                image = np.pad(image, ((ya - y0 + 2, y1 + 2 - yb), (xa - x0 + 2, x1 + 2 - xb)), mode="edge")
                free = np.zeros((h, w), bool)
                free[y[mine] - y0, x[mine] - x0] = free_to[mine].astype(bool) & (seed[mine] == 0)
                far, label = np.full((h + 2, w + 2), np.inf), np.zeros((h + 2, w + 2), np.int64)
                ring = (seed > 0) & (y >= y0 - 1) & (y <= y1 + 1) & (x >= x0 - 1) & (x <= x1 + 1)
                far[y[ring] - y0 + 1, x[ring] - x0 + 1] = 0.0
                label[y[ring] - y0 + 1, x[ring] - x0 + 1] = seed[ring]
                before = far.copy(), label.copy()
                relaxed(step_costs(image, weight), free, far, label)
                yield _batch(_packed(own, y0, x0, image, free, far, label, before), schema)

    return run


def _continued(names: list[str], weight: float):
    """Tiles take what neighbours tell about the pixels just outside and go on from there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            schema = _state_schema(b.schema, names)
            for r in b.to_pylist():
                own = {c: r[c] for c in names}
                told = r.pop("told_")
                image, free, far, label = _frame(r)
                before, news = (far.copy(), label.copy()), False
                for e in told or ():
                    i, j = e["y"] - r["y0_"] + 1, e["x"] - r["x0_"] + 1
                    if 0 <= i < far.shape[0] and 0 <= j < far.shape[1] and (e["far"], e["label"]) < (far[i, j], label[i, j] or np.inf):
                        far[i, j], label[i, j], news = e["far"], e["label"], True
                if news:
                    relaxed(step_costs(image, weight), free, far, label)
                yield _batch(_packed(own, r["y0_"], r["x0_"], image, free, far, label, before), schema)

    return run


def _taken(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, r in enumerate(b.to_pylist()):
                _, free, far, label = _frame(r)
                y, x = np.nonzero((free | np.isfinite(far[1:-1, 1:-1])))
                far, label = far[1:-1, 1:-1][y, x], label[1:-1, 1:-1][y, x]
                own = [b[c].take(pa.array(np.full(len(y), i))) for c in names]
                columns = [pa.array((y + r["y0_"]).astype(np.int32)), pa.array((x + r["x0_"]).astype(np.int32)), pa.array(label.astype(np.int32)), pa.array(far, mask=~np.isfinite(far))]
                yield pa.record_batch([*own, *columns], names=[*names, "y", "x", "label", "distance"])

    return run


def propagated(pixels: DataFrame, key: list[str], weight: float, kept: Callable[[DataFrame], DataFrame], size: int = SIZE) -> DataFrame:
    """(key, y, x, label, distance): seeds grown over a mask along the cheapest paths through the image.

    ``pixels`` has ``v``, ``label`` (a seed's number, or 0) and ``inside`` (may be taken).  A
    step to one of eight neighbours costs the root of the squared difference between the two
    3 x 3 surroundings (absolute differences summed; the image's edge goes on beyond it) plus
    ``weight`` squared for each axis; so with a small weight objects meet where the image
    changes, with a large one half way.  Equal ways go to the lower label.  Mask that no seed
    reaches has label 0 and no distance; seeds keep their pixels.

    Each tile relaxes its paths inside a task; what changed on its border is told to its
    neighbours, and rounds go on while anything is told.
    """
    tiles = tiled(pixels.withColumns({"v": F.col("v").cast("double"), "label": F.col("label").cast("long"), "inside": F.col("inside").cast("int")}), key, ["v", "label", "inside"], size, 2)
    at = [*key, "ty_", "tx_"]
    schema = f"{kinds(pixels, key)}ty_ int, tx_ int, {_STATE}"
    now = kept(tiles.mapInArrow(_started(at, weight, size), schema))
    steps = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in EIGHT))
    while True:
        edge = now.select(*key, "ty_", "tx_", F.explode("edge_").alias("e")).select("*", F.explode(steps).alias("s"))
        there = edge.select(*key, _tile(F.col("e.y") + F.col("s.a"), size).alias("ny_"), _tile(F.col("e.x") + F.col("s.b"), size).alias("nx_"), "ty_", "tx_", "e")
        sent = there.where("ny_ <> ty_ or nx_ <> tx_").select(*key, F.col("ny_").alias("ty_"), F.col("nx_").alias("tx_"), "e").distinct()
        told = kept(sent.groupBy(*at).agg(F.collect_list("e").alias("told_")))
        if told.isEmpty():
            return now.mapInArrow(_taken(key), f"{kinds(pixels, key)}y int, x int, label int, distance double")
        now = kept(now.drop("edge_").join(told, at, "left").mapInArrow(_continued(at, weight), schema))


def _spectra(names: list[str], steps: int, offsets: list[tuple[int, int]], radius: int, size: int):
    """Tiles to all their erosions, rebuilt under the image as far as a tile can tell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, own, y0, x0, here, (v,) in frames(b, size, 1):
                ring = ((0, 0), *((max(0, radius - o.start), max(0, radius - n + o.stop)) for o, n in zip(own, here.shape[1:])))
                inner = tuple(slice(o.start - radius + p[0], o.stop + radius + p[0]) for o, p in zip(own, ring[1:]))
                crop = lambda a: np.pad(a, ring, constant_values=-np.inf)[(..., *inner)]
                now, grown = np.where(np.isnan(v), np.inf, v), []
                for _ in range(steps):
                    now = np.where(here, np.minimum.reduce([shifted(now, d, np.inf) for d in offsets]), np.inf)
                    grown.append(crop(np.where(here & (now < np.inf), now, -np.inf)))
                grown, cap = np.stack(grown, 1), crop(np.where(here, np.where(np.isnan(v), np.inf, v), -np.inf))
                _rebuilt(grown, cap, offsets, radius)
                # All that lies beside another tile is told at first: neighbours began with less.
                yield _spectrum_batch(b, rows, names, y0 + own[0].start, x0 + own[1].start, cap, grown, radius, np.ones_like(grown, bool))

    return run


def _rebuilt(grown: np.ndarray, cap: np.ndarray, offsets: list[tuple[int, int]], radius: int) -> None:
    """Dilations of (tiles, steps, height, width) under ``cap`` until nothing grows, in place; the ring stays."""
    inner = (..., slice(radius, -radius), slice(radius, -radius))
    moving = np.arange(len(grown))
    while len(moving):
        g = grown[moving]
        new = np.minimum(np.maximum.reduce([shifted(g, d, -np.inf)[inner] for d in offsets]), cap[moving][:, None][inner])
        changed = (new != g[inner]).any(axis=(1, 2, 3))
        g[inner] = new
        grown[moving] = g
        moving = moving[changed]


_SPECTRUM = "y0_ int, x0_ int, h_ int, w_ int, cap_ binary, grown_ binary, edge_ array<struct<y:int,x:int,v:array<double>>>, left_ array<double>"


def _spectrum_batch(b: pa.RecordBatch, rows: np.ndarray, names: list[str], y0: np.ndarray, x0: np.ndarray, cap: np.ndarray, grown: np.ndarray, radius: int, changed: np.ndarray) -> pa.RecordBatch:
    """State of tiles, pixels beside other tiles that have changed, and each step's sum."""
    inner = (..., slice(radius, -radius), slice(radius, -radius))
    ring = cap > -np.inf
    ring[inner] = False
    beside = np.logical_or.reduce([shifted(ring, (dy, dx), False) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1)])[inner] if ring.any() else np.zeros(cap[inner].shape, bool)
    news = beside & changed[inner].any(axis=1)
    own = grown[inner]
    left = np.where(own > -np.inf, own, 0.0).sum(axis=(2, 3))
    edges = []
    for i in range(len(rows)):
        y, x = np.nonzero(news[i])
        edges.append([{"y": int(p + y0[i]), "x": int(q + x0[i]), "v": own[i, :, p, q].tolist()} for p, q in zip(y, x)])
    kind = pa.list_(pa.struct([("y", pa.int32()), ("x", pa.int32()), ("v", pa.list_(pa.float64()))]))
    number = lambda a: pa.array(np.asarray(a).astype(np.int32))
    h, w = cap.shape[1:]
    columns = [number(y0), number(x0), number(np.full(len(rows), h)), number(np.full(len(rows), w)), pa.array([a.tobytes() for a in cap]), pa.array([a.tobytes() for a in grown]), pa.array(edges, kind), pa.array(left.tolist(), pa.list_(pa.float64()))]
    return pa.record_batch([*(b[c].take(pa.array(rows)) for c in names), *columns], names=[*names, *(c.split()[0] for c in ("y0_", "x0_", "h_", "w_", "cap_", "grown_", "edge_", "left_"))])


def _spectra_continued(names: list[str], steps: int, offsets: list[tuple[int, int]], radius: int):
    """Tiles take what neighbours tell about the pixels in their ring and go on from there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                y0, x0, h, w = (b[c][i].as_py() for c in ("y0_", "x0_", "h_", "w_"))
                cap = np.frombuffer(b["cap_"][i].as_py()).reshape(1, h, w)
                grown = np.frombuffer(b["grown_"][i].as_py()).reshape(1, steps, h, w).copy()
                before = grown.copy()
                for e in b["told_"][i].as_py() or ():
                    p, q = e["y"] - y0 + radius, e["x"] - x0 + radius
                    if 0 <= p < h and 0 <= q < w:
                        grown[0, :, p, q] = np.maximum(grown[0, :, p, q], e["v"])
                if (grown != before).any():
                    _rebuilt(grown, cap, offsets, radius)
                yield _spectrum_batch(b, np.array([i]), names, np.array([y0]), np.array([x0]), cap, grown, radius, grown != before)

    return run


def rebuilt_erosions(pixels: DataFrame, key: list[str], steps: int, offsets: list[tuple[int, int]], radius: int, kept: Callable[[DataFrame], DataFrame], size: int = SIZE) -> DataFrame:
    """(key, step, left_): sums of 1 to ``steps`` erosions, each rebuilt under the image, tile by tile.

    A tile sees as far around as all erosions reach, so these need no rounds; what grows back
    over a seam is told to the neighbours, for all steps together, while anything is told.
    """
    halo = (steps + 1) * radius
    size = max(size, halo)
    at = [*key, "ty_", "tx_"]
    schema = f"{kinds(pixels, key)}ty_ int, tx_ int, {_SPECTRUM}"
    now = kept(tiled(pixels, key, ["v"], size, halo).mapInArrow(_spectra(at, steps, offsets, radius, size), schema))
    around = F.array(*(F.struct(F.lit(a * radius).alias("a"), F.lit(b * radius).alias("b")) for a, b in EIGHT))
    while True:
        edge = now.select(*at, F.explode("edge_").alias("e")).select("*", F.explode(around).alias("s"))
        there = edge.select(*key, _tile(F.col("e.y") + F.col("s.a"), size).alias("ny_"), _tile(F.col("e.x") + F.col("s.b"), size).alias("nx_"), "ty_", "tx_", "e")
        sent = there.where("ny_ <> ty_ or nx_ <> tx_").select(*key, F.col("ny_").alias("ty_"), F.col("nx_").alias("tx_"), "e").distinct()
        told = kept(sent.groupBy(*at).agg(F.collect_list("e").alias("told_")))
        if told.isEmpty():
            return now.select(*key, F.posexplode("left_").alias("step", "left_")).groupBy(*key, (F.col("step") + 1).cast("int").alias("step")).agg(F.sum("left_").alias("left_"))
        now = kept(spread(now.drop("edge_", "left_"), at).join(told, at, "left").mapInArrow(_spectra_continued(at, steps, offsets, radius), schema))
