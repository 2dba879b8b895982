"""Queries of thresholds, module pipelines and processed images, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import flatfield, morphology, pixels, thresholds
from ..registry import Tables, query
from . import modules
from .config import RunConfig
from .imaging import PX, images, rounded
from .morphologies import COMPONENTS
from .process import processed

ABS = f"{PX}, a as (select vec_id, plate, y, x, abs(v) as v from px)"
HIST = "s as (select vec_id, min(v) as lo, max(v) as hi from a group by 1), h as (select a.vec_id, lo, hi, cast(least(floor((v - lo) / (hi - lo) * 32), 31) as integer) as bin, count(*) as n from a join s on a.vec_id = s.vec_id group by 1, 2, 3, 4), c as (select *, lo + (bin + 0.5) * (hi - lo) / 32 as centre from h), d as (select *, sum(n) over w as w1, sum(n * centre) over w as m1, sum(n) over (partition by vec_id) as w, sum(n * centre) over (partition by vec_id) as m from c window w as (partition by vec_id order by bin))"


def bright(t: Tables) -> DataFrame:
    return images(t).withColumn("v", F.abs("v")).select("vec_id", "plate", "y", "x", "v")


@query(f"with {ABS}, {HIST}, e as (select vec_id, bin, centre, round(m1 * ln(m1 / w1) + (m - m1) * ln((m - m1) / (w - w1)), 9) as s from d where w1 < w) select vec_id, round(centre, 7) as threshold from (select *, row_number() over (partition by vec_id order by s desc, bin) as r from e) where r = 1")
def cross_entropy_threshold(t: Tables) -> DataFrame:
    return rounded(thresholds.minimum_cross_entropy(bright(t), ["vec_id"], "v", 32), ["threshold"], 7)


@query(f"with {ABS}, {HIST}, e as (select p.vec_id, p.bin as b1, q.bin as b2, p.centre as low, q.centre as high, round((p.m1 * p.m1 / p.w1 + pow(q.m1 - p.m1, 2) / (q.w1 - p.w1) + pow(q.m - q.m1, 2) / (q.w - q.w1)) / q.w, 9) as s from d p join d q on p.vec_id = q.vec_id and p.bin < q.bin and q.w1 < q.w) select vec_id, round(low, 7) as low, round(high, 7) as high from (select *, row_number() over (partition by vec_id order by s desc, b1, b2) as r from e) where r = 1")
def three_class_threshold(t: Tables) -> DataFrame:
    return rounded(thresholds.three_class_otsu(bright(t), ["vec_id"], "v", 32), ["low", "high"], 7)


@query(f"""with {ABS}, s as (select vec_id, min(v) as lo, max(v) as hi, 0.1::double as t from a group by 1), b as (select a.vec_id, v, v >= t as side, cast(least(floor((v - lo) / (hi - lo) * 32), 31) as integer) as bin from a join s on a.vec_id = s.vec_id),
p as (select vec_id, side, count(*) as n, var_pop(v) as v from b group by 1, 2), c as (select vec_id, side, bin, count(*) as k from b group by 1, 2, 3), e as (select c.vec_id, -sum(k / n * log2(k / n)) as en from c join p on c.vec_id = p.vec_id and c.side = p.side group by 1)
select p.vec_id, round(sum(n * v) / sum(n), 9) as weighted_variance, round(any_value(en), 6) as sum_of_entropies from p join e on p.vec_id = e.vec_id group by 1""")
def threshold_quality(t: Tables) -> DataFrame:
    q = thresholds.quality(bright(t).withColumn("t", F.lit(0.1)), ["vec_id"], "v", "t", 32)
    return rounded(rounded(q, ["weighted_variance"], 9), ["sum_of_entropies"])


@query(f"""with {PX}, {COMPONENTS.replace("v > 0", "v > 0.05")}, k as (select vec_id, label, count(*) as area from labels group by 1, 2 having count(*) >= 3)
select l.vec_id as image, l.label, area, round(sum(px.v), 6) as integrated, round(median(px.v), 6) as median from labels l join k on l.vec_id = k.vec_id and l.label = k.label join px on px.vec_id = l.vec_id and px.y = l.y and px.x = l.x group by 1, 2, 3""")
def segment_and_measure(t: Tables) -> DataFrame:
    """Threshold, objects of three pixels or more, intensity and shape, export: a pipeline as data."""
    image = images(t).select(F.col("vec_id").alias("image"), "y", "x", "v")
    steps = [
        {"module": "Threshold", "input": "dna", "output": "mask", "method": "manual", "level": 0.05000001},
        {"module": "IdentifyPrimary", "input": "mask", "output": "cells", "least": 3},
        {"module": "MeasureObjectIntensity", "input": "dna", "objects": "cells", "output": "light"},
        {"module": "MeasureGeometry", "objects": "cells", "output": "form"},
        {"module": "Export", "input": "light", "columns": ["image", "label", "integrated", "median"], "output": "table"},
    ]
    made = modules.compiled(steps, {"dna": image})
    return rounded(made["table"].join(made["form"].select("image", "label", "area"), ["image", "label"]), ["integrated", "median"])


@query(f"""with {ABS}, d as (select distinct plate, vec_id from a where plate = 0 and v > 0.4), i as (select plate, vec_id, y, x, v * 10000 as v from a where (plate, vec_id) not in (select plate, vec_id from d)), m as (select plate, y, x, avg(v) as v from i group by 1, 2, 3), f as (select plate, y, x, v / avg(v) over (partition by plate) as flat from m),
c as (select i.plate, vec_id, i.y, i.x, v / flat as v from i join f on i.plate = f.plate and i.y = f.y and i.x = f.x), k as (select plate, vec_id, quantile_cont(v, 0.99) as top from c group by 1, 2), q as (select plate, quantile_cont(top, 0.95) / 65535 as factor from k group by 1)
select c.plate, vec_id as well, y, x, cast(least(greatest(round_even(least(greatest(v / factor, 0), 65535.0) / 65535.0 * 65535, 0), 0), 65535) as integer) as v from c join q on c.plate = q.plate""")
def processed_images(t: Tables) -> DataFrame:
    """Images as a run's configuration makes them: deny list, projection, mean flatfield, own scale, 16 bits."""
    config = RunConfig(manifest="m", blacklist="b", max_project=True, flatfield_mode="MEAN", autoscale=True, autoscale_q1="q99", autoscale_q2=95.0, clip_max=65_535.0)
    p = bright(t).withColumn("v", F.col("v") * 10_000)
    planes = p.select("plate", F.col("vec_id").alias("well"), F.lit(1).alias("field"), F.lit(0).alias("channel"), F.explode(F.array(F.lit(0), F.lit(1))).alias("plane"), "y", "x", "v").withColumn("v", F.col("v") * (F.lit(1.0) - F.col("plane") * 0.5))
    denied = p.where("plate = 0 and v > 4000").select("plate", F.col("vec_id").alias("well")).distinct()
    return processed(config, planes, denied).select("plate", "well", "y", "x", "v")


@query(f"""with {ABS}, m as (select plate, y, x, avg(v) as v from a group by 1, 2, 3), d as (select a.plate, a.y, a.x, sum(b.v * exp(-0.5 * pow(a.y - b.y, 2))) / sum(exp(-0.5 * pow(a.y - b.y, 2))) as v from m a join m b on a.plate = b.plate and a.x = b.x and abs(a.y - b.y) <= 4 group by 1, 2, 3),
g as (select a.plate, a.y, a.x, sum(b.v * exp(-0.5 * pow(a.x - b.x, 2))) / sum(exp(-0.5 * pow(a.x - b.x, 2))) as v from d a join d b on a.plate = b.plate and a.y = b.y and abs(a.x - b.x) <= 4 group by 1, 2, 3) select plate, y, x, round(v / avg(v) over (partition by plate), 8) as flat from g""")
def flatfield_mean_mode(t: Tables) -> DataFrame:
    """The mean image of each plate, blurred, over its mean."""
    mean = pixels.projected(bright(t), ["plate"], "mean")
    blurred = morphology.gaussian(mean, ["plate"], 1.0)
    return rounded(flatfield.mean_field(blurred, ["plate"]), ["flat"], 8)


@query(f"""with {ABS}, s as (select plate, min(v) as lo, max(v) as hi from a group by 1), h as (select a.plate, lo, hi, cast(least(floor((v - lo) / (hi - lo) * 5000), 4999) as integer) as bin, count(*) as n from a join s on a.plate = s.plate group by 1, 2, 3, 4), c as (select *, lo + (bin + 0.5) * (hi - lo) / 5000 as centre from h),
d as (select *, sum(n) over w as w1, sum(n * centre) over w as m1, sum(n) over (partition by plate) as wt, sum(n * centre) over (partition by plate) as mt from c window w as (partition by plate order by bin)),
e as (select plate, bin, centre, round(w1::double * (wt - w1) * pow(m1 / w1 - (mt - m1) / (wt - w1), 2) / wt / wt, 9) as b from d where w1 < wt) select plate, round(centre / 4, 7) as threshold from (select *, row_number() over (partition by plate order by b desc, bin) as r from e) where r = 1""")
def foreground_threshold(t: Tables) -> DataFrame:
    """A quarter of the two-class threshold over 5,000 bins, by plate."""
    found = pixels.otsu(bright(t), ["plate"], "v", 5_000)
    return rounded(found.withColumn("threshold", F.col("threshold") / 4), ["threshold"], 7)
