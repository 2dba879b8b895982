"""Line profiles and image quality from pixel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def half_width(profile: DataFrame, key: list[str], at: str, value: str) -> DataFrame:
    """(key, width): distance between the interpolated crossings of half the maximum.

    The outermost samples at or above half count; at the end of a profile its last sample is
    the crossing.  A profile whose maximum is not positive has no width.
    """
    w = Window.partitionBy(*key).orderBy(at)
    v, half = F.col(value), F.col("half_")
    p = profile.withColumns({"half_": F.max(value).over(Window.partitionBy(*key)) / 2, "before_": F.lag(value).over(w), "after_": F.lead(value).over(w)})
    p = p.where((half > 0) & (v >= half))
    left = F.col(at) - F.coalesce((v - half) / (v - F.col("before_")), F.lit(0.0))
    right = F.col(at) + F.coalesce((v - half) / (v - F.col("after_")), F.lit(0.0))
    ends = p.groupBy(*key).agg(F.min_by(left, F.col(at)).alias("l_"), F.max_by(right, F.col(at)).alias("r_"))
    return ends.select(*key, (F.col("r_") - F.col("l_")).alias("width"))


def quality(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Mean, spread and the percentage of pixels at the image's own extremes."""
    most = pixels.groupBy(*key).agg(F.max("v").alias("hi_"), F.min("v").alias("lo_"))
    share = lambda c: F.sum(F.when(F.col("v") == F.col(c), 1.0).otherwise(0.0)) / F.count(F.lit(1)) * 100
    return pixels.join(most, key).groupBy(*key).agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), share("hi_").alias("percent_max"), share("lo_").alias("percent_min"))


def background(pixels: DataFrame, key: list[str], size: int, rim: int, percent: float) -> DataFrame:
    """(key, background): a percentile of the pixels in the outer rim of a crop."""
    outer = (F.col("y") < rim) | (F.col("y") >= size - rim) | (F.col("x") < rim) | (F.col("x") >= size - rim)
    return pixels.where(outer).groupBy(*key).agg(F.percentile("v", percent / 100).alias("background"))
