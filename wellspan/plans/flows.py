"""Queries of streams, module pipelines and transforms of whole images."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grouped
from ..registry import Tables, query
from ..streaming import groups
from . import imaging, modules


def shared_folder(spark: SparkSession) -> str:
    """A new folder where all executors see it: below the cluster's checkpoint folder, which has to be set there."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{base.rstrip('/')}/wellspan-{uuid.uuid4().hex}" if base else tempfile.mkdtemp(prefix="wellspan-")


def streamed(t: Tables, name: str, *columns: str) -> DataFrame:
    """A stream of a table's ``columns`` (all, if none are named).

    Streams read folders: a table that is one file is first written as a folder.
    """
    folder, table = f"{shared_folder(t.spark)}/{name}", getattr(t, name).select(*(columns or "*"))
    table.write.parquet(folder)
    return t.spark.readStream.schema(table.schema).option("pathGlobFilter", "*.parquet").parquet(folder)


def run(t: Tables, stream: DataFrame, mode: str = "append") -> DataFrame:
    out = shared_folder(t.spark)
    groups.available_now(stream, f"{out}/rows", f"{out}/state", mode)
    return t.spark.read.parquet(f"{out}/rows")


@query("select distinct user_id, event_type from events")
def stream_first_seen(t: Tables) -> DataFrame:
    return run(t, groups.first_seen(streamed(t, "events").select("user_id", "event_type"), ["user_id", "event_type"]))


@query("select conv_id, string_agg(distinct cast(turn as varchar), ',' order by cast(turn as varchar)) as members from conversations group by conv_id having count(distinct turn) >= max(turn) + 1 and max(turn) + 1 >= 4")
def stream_sized_groups(t: Tables) -> DataFrame:
    sizes = t.conversations.groupBy("conv_id").agg((F.max("turn") + 1).cast("int").alias("size")).where("size >= 4")
    stream = streamed(t, "conversations").join(sizes, "conv_id").select("conv_id", "size", "turn")
    return run(t, groups.sized_groups(stream, "conv_id", "size", "turn"))


@query("""with q as (select vec_id as image, y, x, v, case when v > 0 then cast(1 + y // 4 * 2 + x // 4 as integer) else 0 end as label from (select vec_id, cast((i - 1) // 8 as integer) as y, cast((i - 1) % 8 as integer) as x, cast(embedding[i] as double) as v from (select vec_id, embedding, unnest(range(1, 65)) as i from embeddings))),
m as (select image, label, count(*) as area, round(avg(v), 6) as intensity_mean from q where label > 0 group by image, label), f as (select image from m where area between 6 and 12 group by image having count(*) >= 3)
select image, label, area, intensity_mean from m where area between 6 and 12 and image in (select image from f)""")
def module_pipeline(t: Tables) -> DataFrame:
    """Measure, filter by area, skip images with few objects left, measure again, export."""
    p = imaging.quadrants(imaging.images(t)).withColumnRenamed("vec_id", "image")
    steps = [
        {"module": "Invert", "input": "dna", "output": "unused", "enabled": False},
        {"module": "MeasureIntensity", "input": "dna", "objects": "cells", "output": "first"},
        {"module": "FilterObjects", "objects": "cells", "measures": "first", "by": "area", "low": 6, "high": 12, "output": "sound", "removed": "odd"},
        {"module": "FlagImage", "objects": "sound", "least": 3, "tables": ["sound"]},
        {"module": "MeasureIntensity", "input": "dna", "objects": "sound", "output": "second"},
        {"module": "Export", "input": "second", "columns": ["image", "label", "area", "intensity_mean"], "output": "table"},
    ]
    made = modules.compiled(steps, {"dna": p.drop("label"), "cells": p.drop("v")})
    return made["table"].withColumn("intensity_mean", F.round("intensity_mean", 6))


def arrays(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("pixels"))


@query("select vec_id, 1 as dy, 2 as dx from embeddings")
def kernel_registration(t: Tables) -> DataFrame:
    """The translation put into every image is found again."""
    import numpy as np

    moved = grouped.per_image(arrays(t), ["vec_id"], lambda a: np.roll(a, (-1, -2), (0, 1)), imaging.SIDE).withColumnRenamed("pixels", "moving")
    pairs = arrays(t).withColumnRenamed("pixels", "reference").join(moved, "vec_id")
    return grouped.registered(pairs, ["vec_id"], imaging.SIDE)


@query("select vec_id, round((1 + vec_id % 5 * 0.5) * 2 * sqrt(2 * ln(2)), 4) as width from embeddings")
def gaussian_width_fit(t: Tables) -> DataFrame:
    """Profiles of known spread, fitted: the width is that of the spread which was put in."""
    spread = F.lit(1.0) + F.col("vec_id") % 5 * 0.5
    profile = F.transform(F.sequence(F.lit(0), F.lit(40)), lambda i: F.exp(-0.5 * F.pow((i - 20) / spread, F.lit(2.0))))
    return grouped.gaussian_widths(t.embeddings.select("vec_id", profile.alias("profile")), ["vec_id"]).withColumn("width", F.round("width", 4))


@query("""with g as (select user_id, min(ts) as first, count(distinct event_type) as n, string_agg(distinct event_type, ',' order by event_type) as members from events where user_id is not null and ts is not null group by user_id), w as (select max(ts) - interval 1 day as mark from events)
select user_id, members, cast(n as integer) as n_members, cast(3 + user_id % 4 as integer) as size, n >= 3 + user_id % 4 as complete from g, w where n >= 3 + user_id % 4 or first + interval 7 days <= mark""")
def stream_timed_groups(t: Tables) -> DataFrame:
    """Users once their kinds of events are enough, or marked as not complete a week after their first one."""
    stream = streamed(t, "events", "user_id", "event_type", "ts").select("user_id", (F.col("user_id") % 4 + 3).alias("size"), "event_type", "ts")
    with groups.timed(t.spark):
        return run(t, groups.timed_groups(stream, "user_id", "size", "event_type", "ts", "7 days", "1 day"))


@query("select event_id, event_type from events")
def stream_batches(t: Tables) -> DataFrame:
    """Micro-batches of one file each to folders of their own; a second start finds nothing new."""
    folder, out = f"{shared_folder(t.spark)}/events", shared_folder(t.spark)
    t.events.repartition(3).write.parquet(folder)

    def write(batch: DataFrame, number: int) -> None:
        batch.select("event_id", "event_type").write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    for _ in range(2):
        stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        groups.each_batch(stream, write, f"{out}/state")
    return t.spark.read.parquet(f"{out}/rows").select("event_id", "event_type")


@query("select s_suppkey, n_name, n_regionkey from supplier join nation on s_nationkey = n_nationkey")
def stream_static_join(t: Tables) -> DataFrame:
    """A stream of wells meets the manifest of plates, which stands still."""
    wells = streamed(t, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    return run(t, wells.join(t.nation, "n_nationkey").select("s_suppkey", "n_name", "n_regionkey"))


@query("select event_type, count(distinct user_id) as users from events group by event_type")
def stream_then_batch(t: Tables) -> DataFrame:
    """A barrier: the stream runs out before a batch reads all that it wrote."""
    seen = run(t, groups.first_seen(streamed(t, "events").select("user_id", "event_type"), ["user_id", "event_type"]))
    return seen.groupBy("event_type").agg(F.count(F.lit(1)).alias("users"))
