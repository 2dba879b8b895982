"""Joins and choices of a run: plates, cycles, channels, fields and their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import counted, percentiles, same_key


def one_each(df: DataFrame, on: list[str]) -> DataFrame:
    """``df``, which raises when it is read if a key comes twice."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n_"))
    sound = F.assert_true(F.col("n_") == 1, F.concat_ws(" ", F.lit("not unique:"), *(F.col(c).cast("string") for c in on)))
    return df.join(counts.where(sound.isNull()).drop("n_"), on)


def images_with_masks(images: DataFrame, masks: DataFrame) -> DataFrame:
    """Images and masks of the same place (plate, row, col, field); either without the other goes."""
    return images.join(masks, ["plate", "row", "col", "field"])


def with_channel_map(registered: DataFrame, channel_index: DataFrame) -> DataFrame:
    """(plate, orig_channel) of a registration to the merged channel's number and name."""
    return registered.join(channel_index.select("plate", "orig_channel", "channel", "name"), ["plate", "orig_channel"])


def cycle_flatfields(cycled: DataFrame, manifest: DataFrame, fields: DataFrame, shared: bool) -> DataFrame:
    """(plate, cycle, channel, field file): flatfields by plate, or one by (cycle, channel) for all."""
    wanted = cycled.join(manifest, "plate")
    return wanted.join(fields, ["cycle", "channel"]) if shared else wanted.join(fields, ["plate", "channel"])


def merged_cycles(images: DataFrame, cycled: DataFrame, channels_each: DataFrame) -> DataFrame:
    """Pixels of a position's cycles as one image: channels run on over the cycles of its reference."""
    before = Window.partitionBy("ref_plate").orderBy("cycle").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cycled.join(channels_each, "plate").withColumn("offset_", F.coalesce(F.sum("n_channels").over(before), F.lit(0))).drop("n_channels")
    return images.join(offsets, "plate").withColumn("channel", (F.col("channel") + F.col("offset_")).cast("int")).drop("offset_", "plate")


def relabelled_by(inner: DataFrame, outer: DataFrame, key: list[str]) -> DataFrame:
    """Inner object pixels (nuclei) with the label of the outer object (cell) they lie in."""
    cells = outer.where("label > 0").select(*key, "y", "x", F.col("label").alias("cell_"))
    return inner.where("label > 0").join(cells, [*key, "y", "x"]).withColumn("label", F.col("cell_")).drop("cell_")


def within_cap(objects: DataFrame, by: list[str], most: int, least: int = 0) -> DataFrame:
    """Objects of fields that have from ``least`` to ``most`` of them; fuller fields are skipped."""
    counts = objects.groupBy(*by).agg(F.count(F.lit(1)).alias("n_")).where(F.col("n_").between(least, most)).drop("n_")
    return objects.join(counts, by, "left_semi")


def trimmed(pixels: DataFrame, by: list[str], value: str, share: float) -> DataFrame:
    """Pixels that are not 0 and below a quantile of what is not 0."""
    found = pixels.where(F.col(value) != 0)
    top = percentiles(found, by, value, [share], "top_")
    return same_key(found, counted(top) if by else top, by).where(F.col(value) < F.col("top_")[0]).drop("top_")


def unsaturated(x: Column, most: float, floor: float = 0.0) -> Column:
    """Saturated values and values below a floor become 0."""
    return F.when((x >= most) | (x < floor), F.lit(0.0)).otherwise(x)


def stepped_planes(planes: DataFrame, plane: str, centre: int, step: int, reach: int) -> DataFrame:
    """The centre plane and every ``step``-th plane on either side, up to ``reach`` steps."""
    off = F.abs(F.col(plane) - centre)
    return planes.where((off % step == 0) & (off <= step * reach))


def top_classes(long: DataFrame, key: list[str], k: int = 3) -> DataFrame:
    """(key, classes): the k likeliest classes, likeliest first, ties by name."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("probability")).alias("p"), "class")))
    return long.groupBy(*key).agg(F.transform(F.slice(ranked, 1, k), lambda c: c["class"]).alias("classes"))


def masked_mean(pixels: DataFrame, key: list[str], mask: Column) -> DataFrame:
    """(key, mean): sum over the mask by its size, null without a mask."""
    on = F.when(mask, 1).otherwise(0)
    return pixels.groupBy(*key).agg((F.sum(F.col("v") * on) / F.nullif(F.sum(on), F.lit(0))).alias("mean"))


def extents(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, label, width, height, diameter, cy, cx): sizes of the bounding box and rounded centre."""
    box = pixels.where("label > 0").groupBy(*key, "label").agg(
        (F.max("x") - F.min("x")).alias("width"), (F.max("y") - F.min("y")).alias("height"), F.rint(F.avg("y")).cast("int").alias("cy"), F.rint(F.avg("x")).cast("int").alias("cx")
    )
    return box.withColumn("diameter", F.greatest("width", "height"))


def image_statistics(pixels: DataFrame, key: list[str], shares: list[float]) -> DataFrame:
    """Quantiles and mean of each image: what the statistics writer keeps beside the planes."""
    found = pixels.groupBy(*key).agg(F.percentile("v", shares).alias("p_"), F.avg("v").alias("mean"))
    return found.select(*key, *(F.col("p_")[i].alias(f"q{100 * q:g}".replace(".", "_")) for i, q in enumerate(shares)), "mean")


def experiment_thresholds(thresholds: DataFrame) -> DataFrame:
    """One row: mean, median and spread of the images' thresholds."""
    middle = percentiles(thresholds, [], "threshold", [0.5], "m_")
    rest = thresholds.agg(F.avg("threshold").alias("threshold_mean"), F.stddev_samp("threshold").alias("threshold_std"))
    return rest.crossJoin(F.broadcast(middle)).select("threshold_mean", F.col("m_")[0].alias("threshold_median"), "threshold_std")
