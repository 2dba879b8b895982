"""Neighbourhood operators on pixel tables: morphology, filters, components and growth.

Pixels are sent to the places around them and met there by one grouping, so images of any
number and size are spread over all tasks by (key, y, x).  What grows step by step is
checkpointed in the shared folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import lines, tiles

Offsets = list[tuple[int, int]]


def kept(df: DataFrame) -> DataFrame:
    """Cut lineage through the cluster's shared folder; a local one will do in local mode only."""
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="wellspan-"))
    return df.checkpoint(eager=True)


def disk(radius: int) -> Offsets:
    reach = range(-radius, radius + 1)
    return [(a, b) for a in reach for b in reach if a * a + b * b <= radius * radius]


def square(radius: int) -> Offsets:
    reach = range(-radius, radius + 1)
    return [(a, b) for a in reach for b in reach]


def gathered(pixels: DataFrame, key: list[str], offsets: Offsets, made: dict[str, Column], value: str = "v") -> DataFrame:
    """(key, y, x, value, made...): aggregates over ``from_``, the values around each pixel.

    ``dy_`` and ``dx_`` tell where a value stands from the pixel.  Places outside the table
    give and get nothing.
    """
    steps = F.array(*(F.struct(F.lit(-a).alias("dy"), F.lit(-b).alias("dx")) for a, b in sorted({(0, 0), *offsets})))
    wanted = F.array(*(F.struct(F.lit(-a).alias("dy"), F.lit(-b).alias("dx")) for a, b in offsets))
    sent = pixels.select(*key, "y", "x", value, F.explode(steps).alias("step_"))
    own = (F.col("step_.dy") == 0) & (F.col("step_.dx") == 0)
    moved = sent.select(*key, (F.col("y") + F.col("step_.dy")).alias("y"), (F.col("x") + F.col("step_.dx")).alias("x"), (-F.col("step_.dy")).alias("dy_"), (-F.col("step_.dx")).alias("dx_"), F.when(own, F.col(value)).alias("own_"), F.when(F.array_contains(wanted, F.col("step_")), F.col(value)).alias("from_"), own.alias("here_"))
    met = moved.groupBy(*key, "y", "x").agg(F.max("here_").alias("here_"), F.max("own_").alias(value), *(c.alias(n) for n, c in made.items()))
    return met.where("here_").drop("here_")


def _replaced(pixels: DataFrame, key: list[str], offsets: Offsets, made: Column, value: str) -> DataFrame:
    return gathered(pixels, key, offsets, {"made_": made}, value).drop(value).withColumnRenamed("made_", value)


def eroded(pixels: DataFrame, key: list[str], radius: int = 1, value: str = "v") -> DataFrame:
    """Smallest value within a disk; the outside of the image does not count."""
    return _extreme(pixels, key, radius, False, value)


def dilated(pixels: DataFrame, key: list[str], radius: int = 1, value: str = "v") -> DataFrame:
    return _extreme(pixels, key, radius, True, value)


def _extreme(pixels: DataFrame, key: list[str], radius: int, largest: bool, value: str) -> DataFrame:
    """Disks of five pixels are met by pixel, larger ones by running extremes of their rows."""
    if radius < 2:
        return _replaced(pixels, key, disk(radius), (F.max if largest else F.min)("from_"), value)
    found = lines.extreme_in_disk(pixels, key, radius, largest, value)
    return found.withColumn(value, F.col(value).cast(pixels.schema[value].dataType))


def opened(pixels: DataFrame, key: list[str], radius: int = 1) -> DataFrame:
    return dilated(eroded(pixels, key, radius), key, radius)


def closed(pixels: DataFrame, key: list[str], radius: int = 1) -> DataFrame:
    return eroded(dilated(pixels, key, radius), key, radius)


def closing(radius: int) -> Callable[[np.ndarray, list[np.ndarray]], np.ndarray]:
    """Largest and then smallest value within a square, for the frames of ``tiles.local``."""

    def f(here: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
        now = values[0]
        for largest in (True, False):
            out, g = (-np.inf, np.maximum) if largest else (np.inf, np.minimum)
            now = np.where(np.isnan(now), out, now)
            for axis in (0, 1):
                now = g.reduce([tiles.shifted(now, (d, 0) if axis == 0 else (0, d), out) for d in range(-radius, radius + 1)])
            now = np.where(here & np.isfinite(now), now, np.nan)
        return now

    return f


def closed_square(pixels: DataFrame, key: list[str], radius: int = 1) -> DataFrame:
    """Largest and then smallest value within a square, both in one frame of a tile; nulls do not count."""
    return tiles.local(pixels, key, ["v"], 2 * radius, closing(radius))


def suppressed(pixels: DataFrame, key: list[str], radius: int, enhance: bool = False) -> DataFrame:
    """Without features smaller than the disk, or (``enhance``) only these."""
    flat = opened(pixels, key, radius)
    if not enhance:
        return flat
    return pixels.join(flat.withColumnRenamed("v", "flat_"), [*key, "y", "x"]).withColumn("v", F.col("v") - F.col("flat_")).drop("flat_")


def median_filtered(pixels: DataFrame, key: list[str], radius: int = 1) -> DataFrame:
    """Median within a disk, over the pixels that the image has there."""
    return _replaced(pixels, key, disk(radius), F.percentile("from_", 0.5), "v")


def averaged(pixels: DataFrame, key: list[str], radius: int = 1) -> DataFrame:
    """Circular average filter, over the pixels that the image has there."""
    return _replaced(pixels, key, disk(radius), F.avg("from_"), "v")


def weighted(pixels: DataFrame, key: list[str], weights: dict[tuple[int, int], float], normed: bool = True) -> DataFrame:
    """Weighted sum of the values around each pixel; ``normed`` divides by the weights that met one."""
    high, wide = (max(abs(k[i]) for k in weights) for i in (0, 1))
    table = F.array(*(F.lit(float(weights.get((a, b), 0.0))) for a in range(-high, high + 1) for b in range(-wide, wide + 1)))
    weight = F.get(table, (F.col("dy_") + high) * (2 * wide + 1) + F.col("dx_") + wide)
    found = F.col("from_").isNotNull()
    total = F.sum(F.when(found, F.col("from_") * weight))
    return _replaced(pixels, key, list(weights), total / F.sum(F.when(found, weight)) if normed else total, "v")


def gaussian(pixels: DataFrame, key: list[str], sigma: float, truncate: float = 4.0) -> DataFrame:
    """Gaussian blur in two passes of one axis each; at edges the weights inside are normed."""
    return lines.blurred(pixels, key, sigma, truncate)


def components(mask: DataFrame, key: list[str]) -> DataFrame:
    """(key, y, x, label): connected pixels (eight neighbours) of ``mask``, numbered in reading order.

    Objects are found within tiles; only what meets at seams is joined by rounds.
    """
    return numbered_objects(kept(tiles.connected(mask, key, kept)), key)


def numbered_objects(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Labels from 1 within each image, in order of the objects' ``first_`` pixels."""
    objects = pixels.select(*key, "first_").distinct()
    objects = objects.withColumn("label", F.row_number().over(Window.partitionBy(*key).orderBy("first_")))
    return pixels.join(objects, [*key, "first_"]).drop("first_")


def propagated(seeds: DataFrame, key: list[str], most: int | None = None) -> DataFrame:
    """Grow labels over the mask one pixel (four neighbours) a round; ties go to the lower label.

    ``seeds`` has (key, y, x, label): label 0 is mask not yet taken.  ``most`` bounds the
    rounds, which expands objects by that many pixels; without it growth ends by itself.
    """
    four = [(0, 1), (0, -1), (1, 0), (-1, 0)]
    pixels, rounds = kept(seeds.select(*key, "y", "x", "label")), 0
    while most is None or rounds < most:
        rounds += 1
        grown = gathered(pixels, key, four, {"near_": F.min(F.when(F.col("from_") > 0, F.col("from_")))}, "label")
        taken = F.when(F.col("label") == 0, F.coalesce("near_", F.lit(0))).otherwise(F.col("label"))
        step = kept(grown.select(*key, "y", "x", F.col("label").alias("was_"), taken.alias("label")))
        done = step.where("was_ <> label").isEmpty()
        pixels = step.drop("was_")
        if done:
            break
    return pixels


def secondary(pixels: DataFrame, key: list[str], weight: float) -> DataFrame:
    """Objects grown from seeds along the cheapest paths through an image: see ``tiles.propagated``."""
    return tiles.propagated(pixels, key, weight, kept)


def shrunk(objects: DataFrame, key: list[str], radius: int) -> DataFrame:
    """Object pixels whose whole disk lies in their object; the outside of the image is not."""
    offsets = disk(radius)
    inside = objects.where("label > 0").select(*key, "y", "x", "label")
    steps = F.array(*(F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in offsets))
    moved = inside.select(*key, "label", "y", "x", F.explode(steps).alias("d")).select(*key, "label", (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x"))
    return moved.groupBy(*key, "label", "y", "x").agg(F.count(F.lit(1)).alias("n_")).where(F.col("n_") == len(offsets)).drop("n_")


def holes_filled(mask: DataFrame, key: list[str]) -> DataFrame:
    """``v`` 0 or 1: background that does not reach the border (four neighbours) becomes 1."""
    span = mask.groupBy(*key).agg(F.max("y").alias("y1_"), F.max("x").alias("x1_"), F.min("y").alias("y0_"), F.min("x").alias("x0_"))
    border = (F.col("y") == F.col("y0_")) | (F.col("y") == F.col("y1_")) | (F.col("x") == F.col("x0_")) | (F.col("x") == F.col("x1_"))
    seeds = mask.where("v = 0").join(span, key).select(*key, "y", "x", F.when(border, 1).otherwise(0).alias("label"))
    outside = propagated(seeds, key).where("label = 1").withColumnRenamed("label", "out_")
    return mask.join(outside, [*key, "y", "x"], "left").withColumn("v", F.when(F.col("out_").isNull(), 1.0).otherwise(0.0)).drop("out_")


def border_cleared(objects: DataFrame, key: list[str]) -> DataFrame:
    """Without the objects that touch the border of their image (label 0 is background)."""
    span = objects.groupBy(*key).agg(F.max("y").alias("y1_"), F.max("x").alias("x1_"), F.min("y").alias("y0_"), F.min("x").alias("x0_"))
    border = (F.col("y") == F.col("y0_")) | (F.col("y") == F.col("y1_")) | (F.col("x") == F.col("x0_")) | (F.col("x") == F.col("x1_"))
    gone = objects.where("label > 0").join(span, key).where(border).select(*key, "label").distinct()
    return objects.where("label > 0").join(gone, [*key, "label"], "left_anti")


def granularity(pixels: DataFrame, key: list[str], steps: int, radius: int = 1) -> DataFrame:
    """(key, step, removed): percent of the signal that each larger opening removes.

    Each step erodes once more and then rebuilds under the image until nothing grows, all
    within tiles: see ``tiles.rebuilt_erosions``.
    """
    total = pixels.groupBy(*key).agg(F.sum("v").alias("total_"))
    rebuilt = tiles.rebuilt_erosions(pixels, key, steps, disk(radius), radius, kept)
    table = rebuilt.unionByName(total.select(*key, F.lit(0).alias("step"), F.col("total_").alias("left_")))
    w = Window.partitionBy(*key).orderBy("step")
    found = table.withColumns({"before_": F.lag("left_").over(w), "total_": F.first("left_").over(w)}).where("step > 0")
    return found.select(*key, "step", ((F.col("before_") - F.col("left_")) / F.nullif("total_", F.lit(0.0)) * 100).alias("removed"))


#: Most pixels around a tile that rounds of one frame may need.
MOST_AROUND = 64


def deconvolved(pixels: DataFrame, key: list[str], psf: dict[tuple[int, int], float], rounds: int) -> DataFrame:
    """Richardson-Lucy: multiplicative updates with a small point spread function.

    Outside the image there is no light.  As many rounds as a border of MOST_AROUND pixels
    allows are worked within one frame of each tile; then pixels meet again.
    """
    at, norm = [*key, "y", "x"], sum(psf.values())
    forward = {k: w / norm for k, w in psf.items()}
    backward = {(-a, -b): w for (a, b), w in forward.items()}
    reach = max(1, 2 * max(max(abs(a), abs(b)) for a, b in psf))
    mean = pixels.groupBy(*key).agg(F.avg("v").alias("now_"))
    now, left = pixels.select(*at, F.col("v").alias("seen_")).join(mean, key), rounds

    def summed(a: np.ndarray, weights: dict[tuple[int, int], float]) -> tuple[np.ndarray, np.ndarray]:
        known = ~np.isnan(a)
        light = np.where(known, a, 0.0)
        return sum(w * tiles.shifted(light, d, 0.0) for d, w in weights.items()), np.logical_or.reduce([tiles.shifted(known, d, False) for d in weights])

    def several(n: int) -> Callable[[np.ndarray, list[np.ndarray]], np.ndarray]:
        def f(here: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
            seen, v = values
            for _ in range(n):
                blurred, _ = summed(v, forward)
                factor, known = summed(np.where(here, seen / np.maximum(blurred, 1e-12), np.nan), backward)
                v = np.where(here & known, v * factor, np.nan)
            return v

        return f

    while left:
        n = min(left, max(1, MOST_AROUND // reach))
        made = tiles.local(now, key, ["seen_", "now_"], n * reach, several(n))
        left -= n
        if left:
            now = kept(made.withColumnRenamed("v", "now_").join(pixels.select(*at, F.col("v").alias("seen_")), at))
    return made if rounds else now.select(*at, F.col("now_").alias("v"))


def crops(pixels: DataFrame, key: list[str], size: int) -> DataFrame:
    """(key, label, cy, cx, y, x, v): a square of ``size`` pixels around every object's centre.

    Coordinates are those of the crop; pixels of other objects and of background are left
    out, which stands for 0.  Centres round half to even.
    """
    inside = pixels.where("label > 0")
    centre = inside.groupBy(*key, "label").agg(F.rint(F.avg("y")).cast("int").alias("cy"), F.rint(F.avg("x")).cast("int").alias("cx"))
    p = inside.join(centre, [*key, "label"]).withColumns({"y": F.col("y") - F.col("cy") + size // 2, "x": F.col("x") - F.col("cx") + size // 2})
    return p.where(F.col("y").between(0, size - 1) & F.col("x").between(0, size - 1)).select(*key, "label", "cy", "cx", "y", "x", "v")


def best_shift(reference: DataFrame, moving: DataFrame, key: list[str], reach: int) -> DataFrame:
    """(key, dy, dx): the shift of up to ``reach`` pixels under which ``moving`` agrees best.

    Products are summed over all shifts within tiles; ties go to the shortest shift.
    """
    both = tiles.spread(reference.select(*key, "y", "x", F.col("v").cast("double").alias("v"), F.lit(True).alias("in_"), F.lit(None).cast("double").alias("w"), F.lit(False).alias("moved_")).unionByName(
        moving.select(*key, "y", "x", F.lit(None).cast("double").alias("v"), F.lit(False).alias("in_"), F.col("v").cast("double").alias("w"), F.lit(True).alias("moved_"))), [*key, "y", "x"])
    pixels = both.groupBy(*key, "y", "x").agg(F.max("v").alias("v"), F.max("in_").cast("double").alias("in_"), F.max("w").alias("w"), F.max("moved_").cast("double").alias("moved_"))
    sums = tiles.shift_products(pixels, key, square(reach), reach).groupBy(*key, "s").agg(F.round(F.sum("p"), 9).alias("p"))
    far = -(F.abs("s.dy") + F.abs("s.dx"))
    best = sums.groupBy(*key).agg(F.max(F.struct("p", far.alias("far"), (-F.col("s.dy")).alias("a"), (-F.col("s.dx")).alias("b"))).alias("m"))
    return best.select(*key, (-F.col("m.a")).alias("dy"), (-F.col("m.b")).alias("dx"))


def watershed(mask: DataFrame, key: list[str]) -> DataFrame:
    """(key, y, x, label): touching objects of ``mask`` split where they are narrow.

    Peaks of the city-block distance to the background are the seeds; labels flood down from
    them level by level.
    """
    at, four = [*key, "y", "x"], [(0, 1), (0, -1), (1, 0), (-1, 0)]
    left = kept(mask.select(*at))
    depth, level = left.select(*at, F.lit(1).alias("d")), 1
    while True:
        met = gathered(left.withColumn("v", F.lit(1)), key, four, {"n_": F.count("from_")})
        left = kept(met.where("n_ = 4").select(*at))
        if left.isEmpty():
            break
        level += 1
        depth = depth.join(left.withColumn("in_", F.lit(level)), at, "left").select(*at, F.coalesce("in_", "d").alias("d"))
    depth = kept(depth)
    high = gathered(depth, key, disk(2), {"top_": F.max("from_")}, "d")
    seeds = components(high.where("d = top_").select(*at), key)
    labels = kept(depth.join(seeds, at, "left").fillna(0, ["label"]))
    for low in range(level, 0, -1):
        part = propagated(labels.where(F.col("d") >= low).select(*at, "label"), key)
        labels = kept(labels.withColumnRenamed("label", "was_").join(part, at, "left").select(*at, "d", F.coalesce("label", "was_").alias("label")))
    return labels.drop("d")
