"""Illumination correction: a polynomial surface fitted by distributed normal equations."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions.numeric import SURFACE_TERMS, surface_term


#: Ridge penalties that are tried, and folds that judge them.
PENALTIES, FOLDS = [10.0**k for k in range(-6, 7)], 10


def gram_sums(pixels: DataFrame, key: list[str], size: int, more: Sequence[Column] = ()) -> DataFrame:
    """All products that least squares needs: g_i_j = sum t_i t_j and b_i = sum t_i v.

    Coordinates are scaled to [0, 1] by size - 1; zero pixels take no part.  One aggregate
    with map-side sums: the data are read once and only 135 numbers a group are shuffled.
    """
    x, y = F.col("x") / F.lit(float(size - 1)), F.col("y") / F.lit(float(size - 1))
    terms = [surface_term(x, y, t) for t in SURFACE_TERMS]
    sums = [F.sum(terms[i] * terms[j]).alias(f"g_{i}_{j}") for i in range(15) for j in range(i + 1)]
    return pixels.where("v <> 0").groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *sums, *[F.sum(t * F.col("v")).alias(f"b_{i}") for i, t in enumerate(terms)], *more)


def solved(row: dict, ridge: float = 0.0) -> np.ndarray:
    """Coefficients from one row of sums."""
    g = np.array([[row[f"g_{max(i, j)}_{min(i, j)}"] for j in range(15)] for i in range(15)])
    return np.linalg.lstsq(g + ridge * np.eye(15), np.array([row[f"b_{i}"] for i in range(15)]), rcond=None)[0]


def with_folds(pixels: DataFrame, key: list[str], folds: int = FOLDS) -> DataFrame:
    """``pixels`` without zeros and with ``fold``: equal stretches of them in reading order.

    A pixel's place is that of its row, from running counts of rows, and its place there; so
    no task orders more than one row of a key's images.  Of a key with many images, those of
    one row follow each other by value.
    """
    lit = pixels.where("v <> 0")
    rows = lit.groupBy(*key, "y").agg(F.count(F.lit(1)).alias("n_"))
    own = Window.partitionBy(*key)
    before = F.sum("n_").over(own.orderBy("y").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(*key, "y", F.coalesce(before, F.lit(0)).alias("before_"), F.sum("n_").over(own).alias("all_"))
    place = F.col("before_") + F.row_number().over(Window.partitionBy(*key, "y").orderBy("x", "v")) - 1
    # The first folds have one more where the count does not divide.
    small, extra = F.floor(F.col("all_") / folds), F.col("all_") % folds
    wide = extra * (small + 1)
    p = lit.join(rows, [*key, "y"]).withColumn("place_", place)
    fold = F.when(F.col("place_") < wide, F.floor(F.col("place_") / (small + 1))).otherwise(extra + F.floor((F.col("place_") - wide) / F.greatest(small, F.lit(1))))
    return p.withColumn("fold", fold.cast("int")).drop("before_", "all_", "place_")


def _chosen(sums: pd.DataFrame, key: list[str]) -> pd.DataFrame:
    """The penalty with the best mean R squared over folds, and its fit to all of them."""
    n = len(SURFACE_TERMS)
    rows = [r._asdict() for r in sums.sort_values("fold").itertuples(index=False)]
    g = np.array([[[r[f"g_{max(i, j)}_{min(i, j)}"] for j in range(n)] for i in range(n)] for r in rows])
    b = np.array([[r[f"b_{i}"] for i in range(n)] for r in rows])
    square, count = (np.array([r[c] for r in rows], float) for c in ("vv", "n"))
    # A fold is left out by taking its sums from those of all.
    fits = [[np.linalg.solve(g.sum(0) - g[k] + a * np.eye(n), b.sum(0) - b[k]) for k in range(len(rows))] for a in PENALTIES]
    error = np.array([[square[k] - 2 * c @ b[k] + c @ g[k] @ c for k, c in enumerate(f)] for f in fits])
    spread = square - b[:, 0] ** 2 / count
    score = (1 - error / np.where(spread > 0, spread, np.nan)).mean(axis=1)
    best = int(np.nanargmax(score)) if np.isfinite(score).any() else len(PENALTIES) - 1
    fit = np.linalg.solve(g.sum(0) + PENALTIES[best] * np.eye(n), b.sum(0))
    return pd.DataFrame({**{c: [rows[0][c]] for c in key}, "penalty": [PENALTIES[best]], "score": [float(score[best])], "fit_": [fit.tolist()]})


def ridge_fits(pixels: DataFrame, key: list[str], size: int) -> DataFrame:
    """(key, penalty, score, fit_): ridge surfaces whose penalty ten-fold cross-validation chose.

    Sums of each fold are all that the fits need: pixels are summed map-side, 138 numbers a
    fold come together by key, and 13 penalties times 10 folds are solved there.  Folds are
    stretches in reading order; the score is the mean of R squared over the left-out folds,
    and of equal ones the smallest penalty is taken.
    """
    v = F.col("v").cast("double")
    sums = gram_sums(with_folds(pixels.withColumn("v", v), key), [*key, "fold"], size, [F.sum(v * v).alias("vv")])
    kinds = ", ".join(f"`{c}` {pixels.schema[c].dataType.simpleString()}" for c in key)
    return sums.groupBy(*key).applyInPandas(lambda s: _chosen(s, key), f"{kinds}, penalty double, score double, fit_ array<double>")


def surface(pixels: DataFrame, coefficients: np.ndarray, size: int) -> DataFrame:
    """``flat``: the fitted surface over its mean, for (y, x) rows."""
    x, y = F.col("x") / F.lit(float(size - 1)), F.col("y") / F.lit(float(size - 1))
    fit = sum((F.lit(float(c)) * surface_term(x, y, t) for c, t in zip(coefficients, SURFACE_TERMS)), F.lit(0.0))
    mean = np.mean([sum(c * (i / (size - 1)) ** t[0] * (j / (size - 1)) ** t[1] for c, t in zip(coefficients, SURFACE_TERMS)) for i in range(size) for j in range(size)])
    return pixels.withColumn("flat", fit / F.lit(float(mean)))


def evaluation(pixels: DataFrame, key: list[str], bins: int, size: int) -> DataFrame:
    """Means over bins x bins tiles of the mean image, nulls and NaN passed over."""
    image = pixels.groupBy(*key, "y", "x").agg(F.avg(F.when(~F.isnan("v"), F.col("v"))).alias("v"))
    step = size // bins
    return image.groupBy(*key, F.floor(F.col("y") / step).cast("int").alias("bin_y"), F.floor(F.col("x") / step).cast("int").alias("bin_x")).agg(F.avg("v").alias("mean"))


def mean_field(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, y, x, flat): the mean image over its own mean; nulls and NaN are passed over."""
    image = pixels.groupBy(*key, "y", "x").agg(F.avg(F.when(~F.isnan("v"), F.col("v"))).alias("v"))
    level = image.groupBy(*key).agg(F.avg("v").alias("level_"))
    return image.join(level, key).select(*key, "y", "x", (F.col("v") / F.nullif("level_", F.lit(0.0))).alias("flat"))


def fitted_field(pixels: DataFrame, key: list[str], size: int, ridge: float = 0.0, validated: bool = False) -> DataFrame:
    """(key, y, x, flat): the fitted polynomial surface over its mean, one fit a key.

    A key is a plate and channel: their sums, 135 numbers each, are collected to be solved.
    ``validated`` takes a ridge penalty by cross-validation instead, without the driver.
    """
    if validated:
        fitted = ridge_fits(pixels, key, size).select(*key, "fit_")
    else:
        rows = gram_sums(pixels, key, size).collect()
        fits = [(*(r[c] for c in key), [float(x) for x in solved(r.asDict(), ridge)]) for r in rows]
        fitted = pixels.sparkSession.createDataFrame(fits, pixels.select(*key).schema.add("fit_", ArrayType(DoubleType())))
    frame = pixels.select(*key, "y", "x").distinct().join(fitted, key)
    x, y = F.col("x") / F.lit(float(size - 1)), F.col("y") / F.lit(float(size - 1))
    value = sum((F.col("fit_")[i] * surface_term(x, y, t) for i, t in enumerate(SURFACE_TERMS)), F.lit(0.0))
    image = frame.select(*key, "y", "x", value.alias("f_"))
    return image.join(image.groupBy(*key).agg(F.avg("f_").alias("level_")), key).select(*key, "y", "x", (F.col("f_") / F.col("level_")).alias("flat"))
