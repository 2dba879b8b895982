"""Square crops around cells: all channels and planes, the masks as last channels, and an index.

Objects meet pixels by the tiles that their crops touch, so it is an equal join whose rows are
the crops' own pixels; an image is never gathered.  What is gathered is one crop.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import same_key

TILE = 64


def eligible(masks: DataFrame, key: list[str], height: int, width: int) -> DataFrame:
    """(key, label, W, H, centroid_z, centroid_y, centroid_x, diameter) of cells that get a crop.

    ``W`` and ``H`` are largest less smallest row and column, ``diameter`` the largest of these
    and of the planes'.  Cells of one row or one column, and such whose crop would leave the
    frame, get none.  Centres round half to even.
    """
    span = lambda c: (F.max(c) - F.min(c)).cast("int")
    middle = lambda c: F.rint(F.avg(c)).cast("int").alias(f"centroid_{c[0] if c != 'plane' else 'z'}")
    cells = masks.where("cell > 0").groupBy(*key, F.col("cell").alias("label")).agg(span("y").alias("W"), span("x").alias("H"), span("plane").alias("D_"), middle("plane"), middle("y"), middle("x"))
    r = F.floor(F.col("diameter") / 2)
    inside = lambda c, n: (F.col(c) - r >= 0) & (F.col(c) + r <= F.lit(n))
    sized = cells.where("W > 0 and H > 0").withColumn("diameter", F.greatest("W", "H", "D_")).drop("D_")
    return sized.where(inside("centroid_y", height) & inside("centroid_x", width))


def _filled(names: list[str], channels: int, planes: int, nuclei: bool, pairs: list[tuple[int, int]]):
    """Gathered (place, value) of a crop to its array, largest values and correlations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shapes, images, most, agree = [], [], [], []
            for i, diameter in enumerate(b["diameter"].to_pylist()):
                side = 2 * (diameter // 2)
                shape = (channels + 1 + nuclei, planes, side, side)
                found = b["held_"].slice(i, 1).flatten()
                a = np.zeros(int(np.prod(shape)))
                a[found.field(0).to_numpy(zero_copy_only=False)] = found.field(1).to_numpy(zero_copy_only=False)
                a = a.reshape(shape)
                where = a[channels] == a[channels + 1] if nuclei else a[channels] > 0
                shapes.append(list(shape))
                images.append(a.ravel())
                most.append(a[:channels].max(axis=(1, 2, 3)).tolist() if side else [None] * channels)
                agree.append([_correlation(a[p][where], a[q][where]) for p, q in pairs])
            columns = [pa.array(shapes, pa.list_(pa.int32())), pa.array(images, pa.list_(pa.float64())), pa.array(most, pa.list_(pa.float64())), pa.array(agree, pa.list_(pa.float64()))]
            yield pa.record_batch([*(b[c] for c in names), *columns], names=[*names, "shape", "pixels", "most", "correlations"])

    return run


def _correlation(a: np.ndarray, b: np.ndarray) -> float | None:
    if len(a) < 2 or a.min() == a.max() or b.min() == b.max():
        return None
    return float(np.corrcoef(a, b)[0, 1])


def cropped(pixels: DataFrame, masks: DataFrame, key: list[str], channels: int, planes: int, frame: tuple[int, int], reference: int | None = None, queries: Sequence[int] = ()) -> DataFrame:
    """(key, label, W, H, centroids, diameter, shape, pixels, most, correlations) of all ``eligible`` cells.

    ``pixels`` is (key, channel, plane, y, x, v) and ``masks`` (key, plane, y, x, cell) and, if
    there is one, ``nucleus``; all count from 0, and ``frame`` is (height, width).  A crop is
    2 * (diameter // 2) pixels wide and high and holds raw values, other cells' too; its last
    channels are 1 where the cell's and where its nucleus' mask is.  ``pixels`` is the crop
    by channel, plane, row and column; what the tables lack, or is null, is 0.  ``most``
    holds each channel's largest value, ``correlations`` those of channel ``reference`` with
    ``queries`` where cell and nucleus masks agree (without nuclei: within the cell); null
    where either channel is constant there.  A pixel that comes twice counts once.
    """
    nuclei = "nucleus" in masks.columns
    place = [*key, "channel", "plane", "y", "x", "v"]
    as_channel = lambda c, n: masks.select(*key, F.lit(n).alias("channel"), "plane", "y", "x", F.col(c).cast("double").alias("v"))
    every = pixels.where(F.col("channel").between(0, channels - 1)).withColumn("v", F.col("v").cast("double")).select(*place).unionByName(as_channel("cell", channels))
    every = every.unionByName(as_channel("nucleus", channels + 1)) if nuclei else every
    r = F.floor(F.col("diameter") / 2).cast("int")
    tiles = lambda c: F.explode(F.sequence(F.floor((F.col(f"centroid_{c}") - r) / TILE), F.floor((F.col(f"centroid_{c}") + r) / TILE)))
    cells = eligible(masks, key, *frame).withColumn("ty_", tiles("y")).withColumn("tx_", tiles("x"))
    at = lambda c: (F.col(c) - F.col(f"centroid_{c}") + r)
    met = same_key(every.withColumns({"ty_": F.floor(F.col("y") / TILE), "tx_": F.floor(F.col("x") / TILE)}), cells, [*key, "ty_", "tx_"])
    within: Column = at("y").between(0, 2 * r - 1) & at("x").between(0, 2 * r - 1) & F.col("plane").between(0, planes - 1) & F.col("v").isNotNull()
    index = (((F.col("channel") * planes + F.col("plane")) * 2 * r + at("y")) * 2 * r + at("x")).cast("long")
    value = F.when(F.col("channel") < channels, F.col("v")).otherwise((F.col("v") == F.col("label")).cast("double"))
    own = [*key, "label", "W", "H", "centroid_z", "centroid_y", "centroid_x", "diameter"]
    held = met.where(within).groupBy(*own).agg(F.collect_list(F.struct(index.alias("at"), value.alias("v"))).alias("held_"))
    kinds = "".join(f"`{c}` {held.schema[c].dataType.simpleString()}, " for c in own)
    return held.mapInArrow(_filled(own, channels, planes, nuclei, [(reference, q) for q in queries] if reference is not None else []), f"{kinds}shape array<int>, pixels array<double>, most array<double>, correlations array<double>")


def stored(crops: DataFrame, path: str, by: list[str], names: Sequence[str]) -> None:
    """The crops as parquet by ``by`` (plate, row, column), each with the ``names`` of its channels.

    Only the partitions written to are replaced.
    """
    named = crops.withColumn("channels", F.array(*map(F.lit, names)))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def index(crops: DataFrame, key: list[str], channels: int, reference: int | None = None, queries: Sequence[int] = ()) -> DataFrame:
    """The stores' table of cells: zero-padded ``cell_index``, measures, ``corr_*`` and ``max*`` columns."""
    measures = ["W", "H", "centroid_z", "centroid_y", "centroid_x", "diameter"]
    digits = F.greatest(F.lit(4), F.length(F.col("label").cast("string")))
    return crops.select(
        *key, F.lpad(F.col("label").cast("string"), digits, F.lit("0")).alias("cell_index"), *measures,
        *(F.col("correlations")[i].alias(f"corr_{reference}_{q}") for i, q in enumerate(queries)), *(F.col("most")[c].alias(f"max{c}") for c in range(channels)),
    )
