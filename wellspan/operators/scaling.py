"""Intensity scaling: quantiles of quantiles, plate offsets from controls, final factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import percentiles

#: Quantiles of the summary of image statistics.
SUMMARY = (0.0, 0.0001, 0.001, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999, 0.9999, 0.99999, 0.999999, 1.0)


def scale_factors(stats: DataFrame, by: list[str], value: str, q: float, full: float = 65_535.0) -> DataFrame:
    """Factor that maps the q-th (0 to 100) quantile of ``value`` over images to full range."""
    return percentiles(stats, by, value, [q / 100]).select(*by, (F.col("percentiles")[0] / F.lit(full)).alias("factor"))


def both_grains(stats: DataFrame, cycle: str, plate: str, channel: str, value: str, q: float, full: float = 65_535.0) -> DataFrame:
    """Factors by (cycle, channel) and by (plate, channel), null where a grain has no such key."""
    of_cycle = scale_factors(stats, [cycle, channel], value, q, full).withColumn("of_plate", F.lit(0))
    of_plate = scale_factors(stats, [plate, channel], value, q, full).withColumn("of_plate", F.lit(1))
    return of_cycle.unionByName(of_plate, allowMissingColumns=True).select(cycle, plate, channel, "factor", "of_plate")


def summary(stats: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Long table of thirteen quantiles and the mean of each measure."""
    each = stats.select(*by, *(F.col(m).cast("double").alias(m) for m in measures)).unpivot(by, measures, "measure", "x_")
    key = [*by, "measure"]
    names = F.array(*[F.lit(f"q{100 * q:g}") for q in SUMMARY])
    zipped = F.explode(F.arrays_zip(names.alias("statistic"), F.col("percentiles").alias("value"))).alias("s")
    quantiles = percentiles(each, key, "x_", list(SUMMARY)).select(*key, zipped).select(*key, "s.statistic", "s.value")
    return quantiles.unionByName(each.groupBy(*key).agg(F.lit("mean").alias("statistic"), F.avg("x_").alias("value")))


def plate_offsets(controls: DataFrame, channel: str, intensity: str) -> DataFrame:
    """Intensity of each plate's controls over the dimmest plate's, channel by channel."""
    dimmest = F.min(intensity).over(Window.partitionBy(channel))
    return controls.withColumn("plate_offset", F.col(intensity) / dimmest)


def final_factors(plates: DataFrame, offsets: DataFrame) -> DataFrame:
    """``plates`` (plate, channel, plate_scale) and ``offsets`` (plate, channel, plate_offset).

    A full outer join; a missing offset is 1.  The base of a channel is its largest scale
    over offset, and a plate's factor is base times offset, or 1 where that is unknown.
    """
    joined = plates.join(offsets, ["plate", "channel"], "full_outer").withColumn("plate_offset", F.coalesce("plate_offset", F.lit(1.0)))
    base = F.max(F.col("plate_scale") / F.col("plate_offset")).over(Window.partitionBy("channel"))
    return joined.withColumn("base_scale", base).withColumn("factor", F.coalesce(F.col("base_scale") * F.col("plate_offset"), F.lit(1.0)))


def control_summary(objects: DataFrame) -> DataFrame:
    """One row per plate and channel of the full product, also where there are no objects.

    ``objects``: plate, channel, well, field, label, name, area, threshold and the mean,
    raw mean and largest intensity of each control object.
    """
    parts = ["threshold", "intensity_mean", "integrated", "intensity_max"]
    rows = objects.withColumn("integrated", F.col("area") * F.col("intensity_mean"))
    totals = [f"{x}_{p}" for p in parts for x in ("s", "n")]
    # Level by level, so that distinct counts are plain counts of ever smaller tables.
    one = rows.groupBy("plate", "channel", "well", "field", "label").agg(
        F.collect_set("name").alias("names"), *(c for p in parts for c in (F.sum(p).alias(f"s_{p}"), F.count(p).alias(f"n_{p}")))
    )
    merged = lambda: [F.array_distinct(F.flatten(F.collect_set("names"))).alias("names"), *(F.sum(x).alias(x) for x in totals)]
    fields = one.groupBy("plate", "channel", "well", "field").agg(F.count(F.lit(1)).alias("nobjects"), *merged())
    wells = fields.groupBy("plate", "channel", "well").agg(F.sum("nobjects").alias("nobjects"), F.collect_set("field").alias("fields"), *merged())
    found = wells.groupBy("plate", "channel").agg(
        F.sum("nobjects").alias("nobjects"),
        F.size(F.array_distinct(F.flatten(F.collect_set("fields")))).cast("long").alias("nfields"),
        F.sum(F.when(F.col("well").isNotNull(), F.size("fields")).otherwise(0)).alias("nfields_total"),
        F.count("well").alias("nwells"),
        *merged(),
    )
    mean = lambda p: F.col(f"s_{p}") / F.nullif(F.col(f"n_{p}"), F.lit(0))
    found = found.select(
        "plate", "channel", "nobjects", "nfields", "nfields_total", "nwells",
        F.array_join(F.array_sort("names"), ",").alias("name"),
        mean("threshold").alias("mean_threshold"),
        mean("intensity_mean").alias("mean_mean_object_intensity"),
        mean("integrated").alias("mean_integrated_object_intensity"),
        mean("intensity_max").alias("mean_max_object_intensity"),
    )
    # All channels are one row, and one row only is broadcast.
    every = objects.select("plate").distinct().crossJoin(F.broadcast(objects.agg(F.collect_set("channel").alias("channels"))))
    counts = ["nobjects", "nfields", "nfields_total", "nwells"]
    return every.select("plate", F.explode("channels").alias("channel")).join(found, ["plate", "channel"], "left").fillna(0, counts)


def must_match(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which every left row has a partner; one without raises when it is read."""
    marked = left.join(right.withColumn("partner_", F.lit(True)), on, "left")
    missing: Column = F.assert_true(F.col("partner_").isNotNull(), F.lit("a key has no partner"))
    return marked.where(missing.isNull()).drop("partner_")
