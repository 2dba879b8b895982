"""Acquisition timing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report(images: DataFrame, plate: str, ts: str, well: str, channel: str, field: str) -> DataFrame:
    """Start, end and seconds per plate, well, image and field.

    Both the number of images and the product of distinct counts are given, as plates with
    gaps make them differ.
    """
    seconds = (F.unix_micros(F.max(F.col(ts).cast("timestamp"))) - F.unix_micros(F.min(F.col(ts).cast("timestamp")))) / F.lit(1e6)
    r = images.groupBy(plate).agg(
        F.min(ts).alias("started"), F.max(ts).alias("ended"), seconds.alias("seconds"),
        F.countDistinct(well).alias("n_wells"), F.count(F.lit(1)).alias("n_images"),
        F.countDistinct(channel).alias("n_channels"), F.countDistinct(field).alias("n_fields"),
    )
    per_image = F.col("seconds") / F.col("n_images")
    return r.withColumns(
        {
            "per_well": F.col("seconds") / F.col("n_wells"),
            "per_image": per_image,
            "per_field": per_image * F.col("n_channels"),
            "images_by_product": F.col("n_channels") * F.col("n_fields"),
        }
    )
