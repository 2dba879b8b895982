"""Registration evaluation on pixel tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import correlation
from . import morphology, tiles
from .pixels import otsu


def evaluation(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Correlation before and after, and shares of overlap in percent.

    ``pixels`` has a (reference), b (query after), c (query before) and their 0/1 masks
    ma, mb; products with the mask keep zeros, over all pixels.
    """
    a, b, c, ma, mb = (F.col(x) for x in ("a", "b", "c", "ma", "mb"))
    return pixels.groupBy(*key).agg(
        correlation(a * ma, c * ma).alias("r_b"),
        correlation(a * ma, b * ma).alias("r_a"),
        (F.sum(ma * mb) / F.sum(ma) * 100).alias("ppix_ba"),
        (F.sum(ma * mb) / F.sum(mb) * 100).alias("ppix_ab"),
    )


def objects_of(pixels: DataFrame, key: list[str], least: float) -> DataFrame:
    """(key, y, x, label): objects above each image's threshold, closed, none at the border.

    An image whose largest value is below ``least`` has no objects.
    """
    bright = pixels.groupBy(*key).agg(F.max("v").alias("top_")).where(F.col("top_") >= least).drop("top_")
    level = pixels.join(bright, key, "left_semi").join(otsu(pixels, key, "v"), key)
    mask = morphology.kept(morphology.closed_square(level.select(*key, "y", "x", F.when(F.col("v") > F.col("threshold"), 1.0).otherwise(0.0).alias("v")), key))
    found = morphology.components(mask.where("v > 0").select(*key, "y", "x"), key)
    framed = morphology.kept(mask.select(*key, "y", "x").join(found, [*key, "y", "x"], "left").fillna(0, ["label"]))
    return morphology.kept(morphology.border_cleared(framed, key))


def full_evaluation(pixels: DataFrame, key: list[str], least: float, size: int = tiles.SIZE) -> DataFrame:
    """(key, r_b, r_a, nobj_ref, nobj_qry, nobj_qry_a, pobj_ba, ppix_ba, ppix_ab) of a registration.

    ``pixels`` has a (reference), b (query after) and c (query before).  Correlations keep
    zeros outside the reference's mask; without an object, shares of it are null.  Images
    within one tile of ``size`` are worked in its frame, so that their pixels are dealt and
    sorted once; pixels of larger ones meet one by one.
    """
    p = pixels.where("y is not null and x is not null").select(*key, "y", "x", *(F.col(n).cast("double").alias(n) for n in "abc"))
    seams = lambda n: F.floor(F.min(n) / size) < F.floor(F.max(n) / size)
    large = p.groupBy(*key).agg((seams("y") | seams("x")).alias("large_")).where("large_").drop("large_")
    if large.isEmpty():
        out = _within_tiles(p, key, least, size)
    else:
        large = morphology.kept(large)
        out = _within_tiles(p.join(large, key, "left_anti"), key, least, size).unionByName(_over_tiles(p.join(large, key, "left_semi"), key, least))
    return out.withColumn("pobj_ba", F.col("nobj_qry_a") / F.nullif(F.col("nobj_ref"), F.lit(0)) * 100)


def _thresholds(v: np.ndarray, bins: int = 256) -> np.ndarray:
    """``pixels.otsu`` of each frame (a row of ``v``; NaN does not count)."""
    lo, hi = np.nanmin(v, axis=1, keepdims=True), np.nanmax(v, axis=1, keepdims=True)
    wide = (hi > lo)[:, 0]
    bin_ = np.minimum(np.nan_to_num(np.floor((v - lo) / np.where(hi > lo, hi - lo, 1.0) * bins)), bins - 1).astype(np.int64)
    at = (np.arange(len(v))[:, None] * bins + bin_)[~np.isnan(v)]
    n = np.bincount(at, minlength=len(v) * bins).reshape(len(v), bins).astype(np.float64)
    centre = lo + (np.arange(bins) + 0.5) * (hi - lo) / bins
    w1, m1 = np.cumsum(n, axis=1), np.cumsum(n * centre, axis=1)
    w, m = w1[:, -1:], m1[:, -1:]
    w2 = w - w1
    cut = (n > 0) & (w2 > 0)
    gap = np.where(cut, m1, 0.0) / np.where(cut, w1, 1.0) - (m - m1) / np.where(cut, w2, 1.0)
    between = w1 * w2 * gap * gap / w / w
    between = np.where(between < 4e6, np.floor(between * 1e9 + 0.5) / 1e9, between)  # nine digits, as far as doubles have them
    best = np.argmax(np.where(cut, between, -1.0), axis=1)
    return np.where(wide, np.take_along_axis(centre, best[:, None], 1)[:, 0], lo[:, 0])


def _objects(here: np.ndarray, v: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """``objects_of`` whole images, one a frame: (their pixels, how many a frame)."""
    n, h, w = v.shape
    found, count = np.zeros(v.shape, bool), np.zeros(n, np.int32)
    flat = v.reshape(n, -1)
    bright = np.flatnonzero(np.where(np.isnan(flat), -np.inf, flat).max(axis=1) >= least)
    if not len(bright):
        return found, count
    level = _thresholds(flat[bright])[:, None, None]
    mask = morphology.closing(1)(here[bright], [np.where(here[bright], v[bright] > level, np.nan)]) > 0
    k, y, x = np.nonzero(mask)
    if not len(k):
        return found, count
    below = k * (h + 1) + y  # frames below each other with a row between them
    ry, rx = tiles.first_pixels(below, x)
    root = ry * w + rx
    border = (y == 0) | (y == h - 1) | (x == 0) | (x == w - 1)
    inner = ~np.isin(root, root[border])
    found[bright[k[inner]], y[inner], x[inner]] = True
    first = inner & (root == below * w + x)
    np.add.at(count, bright[k[first]], 1)
    return found, count


def _correlations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pearson's correlation of each frame over pairs without NaN; NaN where either side is constant."""
    known = ~(np.isnan(x) | np.isnan(y))
    n = np.maximum(known.sum(axis=1), 1)
    spread = lambda a: np.where(known, a, -np.inf).max(axis=1) > np.where(known, a, np.inf).min(axis=1)
    centred = lambda a: np.where(known, a - (np.where(known, a, 0.0).sum(axis=1) / n)[:, None], 0.0)
    sound, u, w = spread(x) & spread(y), centred(x), centred(y)
    below = np.sqrt((u * u).sum(axis=1) * (w * w).sum(axis=1))
    return np.where(sound, (u * w).sum(axis=1) / np.where(sound, below, 1.0), np.nan)


def _within_tiles(pixels: DataFrame, key: list[str], least: float, size: int) -> DataFrame:
    names = ["r_b", "r_a", "nobj_ref", "nobj_qry", "nobj_qry_a", "ppix_ba", "ppix_ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, _, _, here, images in tiles.frames(batch, size, 3):
                (on_a, n_a), (on_b, n_b), (on_c, n_c) = (_objects(here, v, least) for v in images)
                a, b, c = ((v * on_a).reshape(len(rows), -1) for v in images)
                met, of_a, of_b = ((on.reshape(len(rows), -1)).sum(axis=1) for on in (on_a & on_b, on_a, on_b))
                share = lambda of: np.where(of > 0, met / np.maximum(of, 1) * 100, np.nan)  # noqa: B023, E731
                with np.errstate(invalid="ignore"):
                    made = [_correlations(a, d) for d in (c, b)] + [n_a, n_c, n_b, share(of_a), share(of_b)]
                at = pa.array(rows)
                yield pa.record_batch([*(batch[k].take(at) for k in key), *(pa.array(m, from_pandas=True) for m in made)], names=[*key, *names])

    kinds = ", ".join(f"{n} {'int' if n.startswith('nobj') else 'double'}" for n in names)
    return tiles.tiled(pixels, key, ["a", "b", "c"], size).mapInArrow(run, f"{tiles.kinds(pixels, key)}{kinds}")


def _over_tiles(pixels: DataFrame, key: list[str], least: float) -> DataFrame:
    at, names = [*key, "y", "x"], "abc"
    stacked = None
    for n in names:
        one = pixels.select(F.lit(n).alias("which_"), *at, F.col(n).alias("v"))
        stacked = one if stacked is None else stacked.unionByName(one)
    labels = objects_of(stacked, ["which_", *key], least)
    pick = lambda c, n: F.max(F.when(F.col("which_") == n, F.col(c)))
    p = stacked.join(labels, ["which_", *at], "left").groupBy(*at).agg(*(pick("v", n).alias(n) for n in names), *(pick("label", n).alias(f"l{n}") for n in names))
    on = lambda n: F.when(F.col(f"l{n}") > 0, 1.0).otherwise(0.0)
    a, b, c = (F.col(n) for n in names)
    count = lambda n: F.size(F.collect_set(F.when(F.col(f"l{n}") > 0, F.col(f"l{n}"))))
    return p.groupBy(*key).agg(
        correlation(a * on("a"), c * on("a")).alias("r_b"), correlation(a * on("a"), b * on("a")).alias("r_a"),
        count("a").alias("nobj_ref"), count("c").alias("nobj_qry"), count("b").alias("nobj_qry_a"),
        (F.sum(on("a") * on("b")) / F.nullif(F.sum(on("a")), F.lit(0.0)) * 100).alias("ppix_ba"),
        (F.sum(on("a") * on("b")) / F.nullif(F.sum(on("b")), F.lit(0.0)) * 100).alias("ppix_ab"),
    )
