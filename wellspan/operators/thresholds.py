"""Thresholds of images from histograms: minimum cross-entropy, two and three classes, and their quality.

Values fall into equal bins between a group's extremes; bins, not values, go through windows
and joins, so a group may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(values: DataFrame, key: list[str], value: str, bins: int) -> DataFrame:
    """(key, lo_, hi_, bin, n, centre) of every bin that holds a value; groups of one value have one bin."""
    span = values.where(F.col(value).isNotNull()).groupBy(*key).agg(F.min(value).alias("lo_"), F.max(value).alias("hi_"))
    at = F.when(F.col("hi_") > F.col("lo_"), F.least(F.floor((F.col(value) - F.col("lo_")) / (F.col("hi_") - F.col("lo_")) * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = values.where(F.col(value).isNotNull()).join(span, key).withColumn("bin", at.cast("int")).groupBy(*key, "lo_", "hi_", "bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("centre", F.col("lo_") + (F.col("bin") + 0.5) * (F.col("hi_") - F.col("lo_")) / bins)


def _cumulated(counts: DataFrame, key: list[str]) -> DataFrame:
    """Weights and moments up to each bin (w1, m1) and in all (w, m)."""
    upto, whole = Window.partitionBy(*key).orderBy("bin"), Window.partitionBy(*key)
    moment = F.col("n") * F.col("centre")
    return counts.withColumns({"w1": F.sum("n").over(upto), "m1": F.sum(moment).over(upto), "w": F.sum("n").over(whole), "m": F.sum(moment).over(whole)})


def _best(table: DataFrame, key: list[str], score: Column, *found: str) -> DataFrame:
    """The bin with the largest score, rounded to nine digits so that ties go to the lowest bin."""
    order = F.struct(F.round(score, 9).alias("s"), (-F.col("bin")).alias("b"), *found)
    return table.groupBy(*key).agg(F.max(order).alias("best_")).select(*key, *(F.col(f"best_.{c}").alias(c) for c in found))


def minimum_cross_entropy(values: DataFrame, key: list[str], value: str, bins: int = 256) -> DataFrame:
    """(key, threshold): the centre of the bin after which both classes are closest to their means.

    Values must not be negative; a group of one value gets that value.
    """
    counts = histogram(values, key, value, bins)
    c = _cumulated(counts, key).where("w1 < w")
    m2 = F.col("m") - F.col("m1")
    part = lambda m, w: F.when(m > 0, m * F.log(m / w)).otherwise(0.0)
    best = _best(c, key, part(F.col("m1"), F.col("w1")) + part(m2, F.col("w") - F.col("w1")), "centre")
    return counts.select(*key, "lo_").distinct().join(best, key, "left").select(*key, F.coalesce("centre", "lo_").alias("threshold"))


def three_class_otsu(values: DataFrame, key: list[str], value: str, bins: int = 64) -> DataFrame:
    """(key, low, high): the two thresholds with the largest variance between three classes.

    Every two bins of a group are tried: ``bins`` bounds the join, not the number of values.
    Null where a group has fewer than three filled bins.
    """
    counts = histogram(values, key, value, bins)
    c = _cumulated(counts, key)
    a = c.select(*key, "bin", "w1", "m1", F.col("centre").alias("low"))
    b = c.where("w1 < w").select(*key, F.col("bin").alias("bin_"), F.col("w1").alias("w2"), F.col("m1").alias("m2"), F.col("centre").alias("high"), "w", "m")
    pairs = a.join(b, key).where("bin < bin_")
    share = lambda m, w: m * m / w
    score = (share(F.col("m1"), F.col("w1")) + share(F.col("m2") - F.col("m1"), F.col("w2") - F.col("w1")) + share(F.col("m") - F.col("m2"), F.col("w") - F.col("w2"))) / F.col("w")
    order = F.struct(F.round(score, 9).alias("s"), (-F.col("bin")).alias("b"), (-F.col("bin_")).alias("c"), "low", "high")
    best = pairs.groupBy(*key).agg(F.max(order).alias("best_")).select(*key, F.col("best_.low").alias("low"), F.col("best_.high").alias("high"))
    return counts.select(*key).distinct().join(best, key, "left")


def quality(values: DataFrame, key: list[str], value: str, threshold: str, bins: int = 64) -> DataFrame:
    """(key, weighted_variance, sum_of_entropies) of the two classes that ``threshold`` makes.

    Entropies, in bits, are those of each class's histogram over the group's bins.
    """
    on = F.col(value) >= F.col(threshold)
    sides = values.withColumn("side_", on.cast("int"))
    parts = sides.groupBy(*key, "side_").agg(F.count(F.lit(1)).alias("n_"), F.var_pop(value).alias("v_"))
    variance = parts.groupBy(*key).agg((F.sum(F.col("n_") * F.col("v_")) / F.sum("n_")).alias("weighted_variance"))
    span = values.groupBy(*key).agg(F.min(value).alias("lo_"), F.max(value).alias("hi_"))
    at = F.when(F.col("hi_") > F.col("lo_"), F.least(F.floor((F.col(value) - F.col("lo_")) / (F.col("hi_") - F.col("lo_")) * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    cells = sides.join(span, key).groupBy(*key, "side_", at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.col("n_")
    entropy = cells.join(parts.select(*key, "side_", "n_"), [*key, "side_"]).groupBy(*key).agg((-F.sum(share * F.log2(share))).alias("sum_of_entropies"))
    return variance.join(entropy, key)


def corrected(threshold: Column, factor: float = 1.0, low: float = 0.0, high: float = 1.0) -> Column:
    """A threshold times its correction factor, within bounds."""
    return F.least(F.greatest(threshold * factor, F.lit(float(low))), F.lit(float(high)))
