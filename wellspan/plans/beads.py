"""Queries of sub-pixel registration, spread functions of beads, and stores of crops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import beads, cropstore, morphology
from ..operators.quantiles import same_key
from ..registry import Tables, query
from .flows import shared_folder
from .imaging import PX, SIDE, images

SHAPE = (1, SIDE, SIDE)
TURN = f"2 * pi() / {SIDE} *"
SHIFTS = "select unnest(range(-4, 4)) as dy"

SQL = f"""with {PX}, ref as (select label, min(vec_id) as ref_id from embeddings where label is not null group by label), pairs as (select vec_id, ref_id from embeddings join ref using (label)),
f as (select u, w from (select unnest(range(-4, 4)) as u) cross join (select unnest(range(-4, 4)) as w)),
dft as (select vec_id, u, w, sum(v * cos({TURN} (u * y + w * x))) as re, -sum(v * sin({TURN} (u * y + w * x))) as im from px cross join f group by vec_id, u, w),
prod as (select p.vec_id, a.u, a.w, a.re * b.re + a.im * b.im as re, a.im * b.re - a.re * b.im as im, a.re * a.re + a.im * a.im as pa, b.re * b.re + b.im * b.im as pb from pairs p join dft a on a.vec_id = p.ref_id join dft b on b.vec_id = p.vec_id and a.u = b.u and a.w = b.w),
ph as (select *, re / greatest(sqrt(re * re + im * im), 1e-12) as pr, im / greatest(sqrt(re * re + im * im), 1e-12) as pi from prod),
s as (select dy, dx from ({SHIFTS}) cross join (select unnest(range(-4, 4)) as dx)),
whole as (select vec_id, dy, dx, round(sqrt(pow(sum(pr * cos({TURN} (u * dy + w * dx)) - pi * sin({TURN} (u * dy + w * dx))), 2) + pow(sum(pr * sin({TURN} (u * dy + w * dx)) + pi * cos({TURN} (u * dy + w * dx))), 2)) / 64, 9) as c from ph cross join s group by vec_id, dy, dx),
best as (select vec_id, dy, dx from (select *, row_number() over (partition by vec_id order by c desc, abs(dy) + abs(dx), dy, dx) as r from whole) where r = 1),
fine as (select b.vec_id, 5 * b.dy + i as fy, 5 * b.dx + j as fx from best b cross join (select unnest(range(-4, 5)) as i) cross join (select unnest(range(-4, 5)) as j)),
scored as (select f.vec_id, fy, fx, round(sqrt(pow(sum(pr * cos({TURN} (u * fy + w * fx) / 5.0) - pi * sin({TURN} (u * fy + w * fx) / 5.0)), 2) + pow(sum(pr * sin({TURN} (u * fy + w * fx) / 5.0) + pi * cos({TURN} (u * fy + w * fx) / 5.0)), 2)) / 64, 9) as c,
  sqrt(greatest(0.0, 1 - (pow(sum(re * cos({TURN} (u * fy + w * fx) / 5.0) - im * sin({TURN} (u * fy + w * fx) / 5.0)), 2) + pow(sum(re * sin({TURN} (u * fy + w * fx) / 5.0) + im * cos({TURN} (u * fy + w * fx) / 5.0)), 2)) / (sum(pa) * sum(pb)))) as error from fine f join ph on ph.vec_id = f.vec_id group by f.vec_id, fy, fx),
top as (select *, row_number() over (partition by vec_id order by c desc, abs(fy) + abs(fx), fy, fx) as r from scored)
select vec_id, cast(fy as integer) as fifths_y, cast(fx as integer) as fifths_x, round(error, 6) as error from top where r = 1"""


@query(SQL)
def subpixel_registration(t: Tables) -> DataFrame:
    """Images moved onto the first image of their label, in fifths of a pixel."""
    own = t.embeddings.where("label is not null").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("moving"))
    first = own.groupBy("label").agg(F.min_by("moving", "vec_id").alias("reference"))
    found = beads.fractional_shifts(same_key(own, first, ["label"]), ["vec_id"], SHAPE)
    fifths = lambda i: F.rint(F.col("shift")[i] * 5).cast("int")
    return found.select("vec_id", fifths(1).alias("fifths_y"), fifths(2).alias("fifths_x"), F.round("error", 6).alias("error"))


@query()
def psf_assembly(t: Tables) -> DataFrame:
    """Images as crops of beads: one spread function for each label, as pixels."""
    crops = t.embeddings.select("label", "vec_id", F.transform("embedding", lambda v: F.abs(v).cast("double")).alias("pixels"))
    found = beads.assembled(crops, ["label"], "vec_id", SHAPE, morphology.kept, trim=1)
    return found.select("label", "n_beads", F.posexplode("psf").alias("at", "v"))


CROPS = f"""with {PX}, q as (select vec_id, y, x, v, round(v * v, 9) as w, case when v > 0 then cast(1 + y // 4 * 2 + x // 4 as integer) else 0 end as cell, case when v > 0.1 then cast(1 + y // 4 * 2 + x // 4 as integer) else 0 end as nucleus from px),
c as (select vec_id, cell as label, cast(max(y) - min(y) as integer) as w, cast(max(x) - min(x) as integer) as h, cast(round_even(avg(y), 0) as integer) as cy, cast(round_even(avg(x), 0) as integer) as cx from q where cell > 0 group by 1, 2),
e as (select *, greatest(w, h) as diameter, greatest(w, h) // 2 as r from c where w > 0 and h > 0), k as (select * from e where cy >= r and cy + r <= 8 and cx >= r and cx + r <= 8),
p as (select k.*, q.v, q.w as v2, q.cell = label as cm, q.nucleus = label as nm from k left join q on q.vec_id = k.vec_id and q.y >= cy - r and q.y < cy + r and q.x >= cx - r and q.x < cx + r)
select vec_id, lpad(cast(label as varchar), 4, '0') as cell_index, w as "W", h as "H", 0 as centroid_z, cy as centroid_y, cx as centroid_x, diameter, round(case when count(*) filter (cm = nm) >= 2 then corr(v, v2) filter (cm = nm) end, 6) as corr_0_1, max(v) as max0, max(v2) as max1,
 cast(4 * 4 * r * r as integer) as n_values, round(sum(v) + sum(v2) + count(*) filter (cm) + count(*) filter (nm), 6) as total from p where r > 0 group by vec_id, label, w, h, cy, cx, diameter, r"""


@query(CROPS)
def crop_store(t: Tables) -> DataFrame:
    """Crops of two channels and two masks, written by image, read back, and their index."""
    p = images(t).select("vec_id", "y", "x", "v").withColumn("plane", F.lit(0))
    two = p.withColumn("channel", F.lit(0)).unionByName(p.withColumns({"channel": F.lit(1), "v": F.round(F.col("v") * F.col("v"), 9)}))
    quadrant = (F.floor(F.col("y") / 4) * 2 + F.floor(F.col("x") / 4) + 1).cast("int")
    above = lambda level: F.when(F.col("v") > level, quadrant).otherwise(0)
    masks = p.select("vec_id", "plane", "y", "x", above(0).alias("cell"), above(0.1).alias("nucleus"))
    crops = cropstore.cropped(two, masks, ["vec_id"], 2, 1, (SIDE, SIDE), 0, [1])
    path = f"{shared_folder(t.spark)}/crops"
    cropstore.stored(crops.withColumn("plate", F.col("vec_id") % 4), path, ["plate"], ["dna", "actin", "cell_mask", "nucl_mask"])
    back = t.spark.read.parquet(path)
    sizes = back.select("vec_id", F.lpad(F.col("label").cast("string"), 4, "0").alias("cell_index"), F.size("pixels").alias("n_values"), F.round(F.aggregate("pixels", F.lit(0.0), lambda a, v: a + v), 6).alias("total"))
    return cropstore.index(back, ["vec_id"], 2, 0, [1]).withColumn("corr_0_1", F.round("corr_0_1", 6)).join(sizes, ["vec_id", "cell_index"])
