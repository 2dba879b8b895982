"""Plates, cycles and channels: merging cycles and numbering merged channels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cycles(registration: DataFrame) -> DataFrame:
    """(ref_plate, plate, cycle): the reference is cycle 1, its query plates follow.

    ``registration`` has ref_plate and the array qry_plates; groups may differ in length.
    """
    plates = F.concat(F.array("ref_plate"), F.coalesce("qry_plates", F.expr("array()")))
    return registration.select("ref_plate", F.posexplode(plates).alias("at", "plate")).select("ref_plate", "plate", (F.col("at") + 1).alias("cycle"))


def channel_index(cycled: DataFrame, channels: DataFrame, masked: DataFrame | None = None) -> DataFrame:
    """(ref_plate, plate, cycle, channel, name, orig_channel, orig_name).

    Channels run on from 0 over (cycle, original channel) within a reference plate.  For each
    masked channel, in order, an inclusive and an exclusive copy are appended; their original
    channel is the merged number of the channel that is masked.
    """
    order = Window.partitionBy("ref_plate").orderBy("cycle", "orig_channel")
    merged = cycled.join(channels, "plate").withColumn("channel", F.row_number().over(order) - 1)
    merged = merged.withColumn("name", F.concat_ws(" - ", F.concat(F.lit("ch"), F.col("channel").cast("string")), "orig_name"))
    columns = ["ref_plate", "plate", "cycle", "channel", "name", "orig_channel", "orig_name"]
    merged = merged.select(*columns)
    if masked is None:
        return merged
    last = merged.groupBy("ref_plate").agg(F.max("channel").alias("last"))
    kinds = F.array(F.lit("mask inclusive"), F.lit("mask exclusive"))
    hit = merged.join(masked, ["plate", "orig_channel"]).select("ref_plate", "plate", "cycle", F.col("channel").alias("orig_channel"), F.col("name").alias("orig_name"), F.posexplode(kinds).alias("which", "kind"))
    place = F.row_number().over(Window.partitionBy("ref_plate").orderBy("orig_channel", "which"))
    extra = hit.join(last, "ref_plate").withColumn("channel", F.col("last") + place).withColumn("name", F.concat_ws(" - ", F.concat(F.lit("ch"), F.col("channel").cast("string")), "orig_name", "kind"))
    return merged.unionByName(extra.select(*columns))


def in_all_cycles(images: DataFrame, cycled: DataFrame) -> DataFrame:
    """Positions (ref_plate, row, col, field) that every cycle of the reference has."""
    expected = cycled.groupBy("ref_plate").agg(F.countDistinct("plate").alias("expected"))
    seen = images.join(cycled, "plate").groupBy("ref_plate", "row", "col", "field").agg(F.countDistinct("plate").alias("seen"))
    return seen.join(expected, "ref_plate").where("seen = expected").drop("seen", "expected")
