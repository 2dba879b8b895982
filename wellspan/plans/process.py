"""A run's processed images, planned from its configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric
from ..operators import filters, flatfield, pixels, scaling
from .config import RunConfig


def processed(config: RunConfig, planes: DataFrame, denied: DataFrame | None = None, factors: DataFrame | None = None, size: int | None = None) -> DataFrame:
    """(plate, well, field, channel, y, x, v): deny list, projection, flatfield, scaling, 16 bits.

    ``planes`` has also the column plane.  ``denied`` lists (plate, well); ``factors`` has
    (plate, channel, factor) and is used with a manual scale, while ``autoscale`` takes a
    quantile of each image and then, by (plate, channel), a quantile of these.  Every step is there or not as the configuration says; parameters of
    other steps (registration, segmentation, features, control wells) must have been left
    alone.  A flatfield is of degree four and takes all images.
    """
    config.only("blacklist", "max_project", "flatfield", "flatfield_mode", "flatfield_global", "manual_scale", "scale_slope", "scale_bias", "autoscale", "autoscale_q1", "autoscale_q2", "clip_max")
    p = planes
    if config.blacklist is not None:
        if denied is None:
            raise ValueError("the configuration names a blacklist, and none is given")
        p = filters.without_listed(p, denied, ["plate", "well"])
    image = ["plate", "well", "field", "channel"]
    p = pixels.projected(p, image) if config.max_project else p.select(*image, *(["plane"] if "plane" in p.columns else []), "y", "x", "v")
    if config.flatfield:
        key = ["channel"] if config.flatfield_global else ["plate", "channel"]
        if config.flatfield_mode == "MEAN":
            field = flatfield.mean_field(p, key)
        else:
            field = flatfield.fitted_field(p, key, size or p.agg(F.max("x")).first()[0] + 1)
        p = pixels.with_flatfield(p, field.withColumn("dark", F.lit(0.0)), key)
    if config.autoscale:
        within = F.percentile(F.col("v").cast("double"), float(config.autoscale_q1.removeprefix("q")) / 100)
        factors = scaling.scale_factors(p.groupBy(*image).agg(within.alias("top_")), ["plate", "channel"], "top_", config.autoscale_q2)
    if config.autoscale or config.manual_scale:
        if factors is None:
            raise ValueError("a manual scale needs factors")
        p = scaling.must_match(p, factors.select("plate", "channel", "factor"), ["plate", "channel"])
        if config.scale_slope is not None:
            p = p.withColumn("v", numeric.sigmoid_scaled(F.col("v"), F.col("factor"), F.lit(float(config.scale_slope)), F.lit(float(config.scale_bias))))
        else:
            p = p.withColumn("v", F.col("v") / F.col("factor"))
        p = p.drop("factor")
    return p.withColumn("v", numeric.clipped_to_uint16(F.greatest(F.col("v"), F.lit(0.0)), config.clip_max))
