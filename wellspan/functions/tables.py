"""Table functions: one image in, many rows out."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="y int, x int, sigma double")
class ImageBlobs:
    """Bright spots of an image: ``LATERAL image_blobs(pixels, width, threshold)``."""

    def eval(self, pixels: list, width: int, threshold: float) -> Iterator[tuple[int, int, float]]:
        import numpy as np

        from wellspan.functions.kernels import blobs

        yield from blobs(np.asarray(pixels, float).reshape(-1, width), (1.0, 1.5), float(threshold), 0)


def register(spark: SparkSession) -> None:
    spark.udtf.register("image_blobs", ImageBlobs)
