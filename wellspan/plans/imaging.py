"""Queries of the pixel and object operators, bound to the driver's tables.

Each embedding of 64 numbers is an image of 8 x 8 pixels, its label the plate; a second channel
is the same image mirrored.  Objects are four-fold quadrants or grey-level classes of pixels.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric, tables
from ..operators import flatfield, objects, pixels, profiles, registration
from ..operators.quantiles import numbered
from ..registry import Tables, query

SIDE = 8


def images(t: Tables) -> DataFrame:
    return pixels.exploded(t.embeddings.select("vec_id", "label", "embedding"), "embedding", SIDE).withColumnRenamed("label", "plate")


PX = "px as (select vec_id, label as plate, cast((i - 1) // 8 as integer) as y, cast((i - 1) % 8 as integer) as x, cast(embedding[i] as double) as v from (select vec_id, label, embedding, unnest(range(1, 65)) as i from embeddings))"


def quadrants(p: DataFrame) -> DataFrame:
    """Objects 1 to 4 by quadrant where the value is positive, else background."""
    quadrant = F.lit(1) + F.floor(F.col("y") / 4).cast("int") * 2 + F.floor(F.col("x") / 4).cast("int")
    return p.withColumn("label", F.when(F.col("v") > 0, quadrant).otherwise(F.lit(0)))


def stripes(p: DataFrame) -> DataFrame:
    """Objects by pairs of rows where the value is above a twentieth."""
    return p.withColumn("label", F.when(F.col("v") > 0.05, F.lit(1) + F.floor(F.col("y") / 2).cast("int")).otherwise(F.lit(0)))


QUAD = f"{PX}, q as (select *, case when v > 0 then cast(1 + y // 4 * 2 + x // 4 as integer) else 0 end as label from px)"
STRIPE = "s as (select *, case when v > 0.05 then cast(1 + y // 2 as integer) else 0 end as label from px)"


def rounded(df: DataFrame, names: list[str], n: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c in names})


@query(f"with {PX} select * from px")
def pixels_explode(t: Tables) -> DataFrame:
    return images(t)


@query(f"with {PX} select plate, y, x, max(v) as v from px group by plate, y, x")
def max_project_by_label(t: Tables) -> DataFrame:
    return pixels.projected(images(t), ["plate"])


@query(f"with {PX} select plate, y, x, round(avg(v), 8) as v from px group by plate, y, x")
def mean_image_by_label(t: Tables) -> DataFrame:
    return rounded(pixels.projected(images(t), ["plate"], "mean"), ["v"], 8)


@query(f"with {PX} select vec_id, cast(y // 3 as integer) as y, cast(x // 3 as integer) as x, round(sum(v) / 9.0, 8) as v from px group by vec_id, y // 3, x // 3")
def block_mean_downscale(t: Tables) -> DataFrame:
    return rounded(pixels.block_mean(images(t), ["vec_id"], 3), ["v"], 8)


@query(f"with {PX} select vec_id, cast(y * 2 + a as integer) as y, cast(x * 2 + b as integer) as x, v from px cross join (select unnest([0, 1]) as a) cross join (select unnest([0, 1]) as b)")
def resize_nearest(t: Tables) -> DataFrame:
    return pixels.enlarged(images(t), 2).select("vec_id", "y", "x", "v")


@query(f"with {PX} select vec_id, y, x, v from px where y = 0 or (y + 1) % 3 = 0")
def plane_subset(t: Tables) -> DataFrame:
    return pixels.every_kth_plane(images(t), "y", 3).select("vec_id", "y", "x", "v")


@query(f"with {PX} select vec_id, y, x, v from px where abs(y - 4) < 2")
def centre_planes(t: Tables) -> DataFrame:
    return pixels.centre_planes(images(t), "y", SIDE, 2).select("vec_id", "y", "x", "v")


@query(f"""with {QUAD} select vec_id, label, count(*) as area, round(avg(y), 6) as centroid_0, round(avg(x), 6) as centroid_1, min(y) as min_y, max(y) as max_y, min(x) as min_x, max(x) as max_x,
 round(max(v), 6) as intensity_max, round(avg(v), 6) as intensity_mean, round(min(v), 6) as intensity_min, round(sum(v), 6) as intensity_sum, round(stddev_pop(v), 6) as intensity_std from q where label > 0 group by vec_id, label""")
def regionprops_basic(t: Tables) -> DataFrame:
    r = objects.regions(quadrants(images(t)), ["vec_id"])
    return rounded(r, ["centroid_0", "centroid_1", "intensity_max", "intensity_mean", "intensity_min", "intensity_sum", "intensity_std"])


PCTS = [1.0, 10.0, 25.0, 50.0, 75.0, 90.0, 99.0]


@query(f"with {QUAD} select vec_id, label, " + ", ".join(f"round(quantile_cont(v, {p / 100!r}), 8) as p{p:g}" for p in PCTS) + " from q where label > 0 group by vec_id, label")
def object_percentiles(t: Tables) -> DataFrame:
    r = objects.value_percentiles(quadrants(images(t)).where("label > 0"), ["vec_id", "label"], PCTS)
    return rounded(r, [f"p{p:g}" for p in PCTS], 8)


@query(f"with {PX} select plate, " + ", ".join(f"round(quantile_cont(v, {p / 100!r}), 8) as p{p:g}" for p in (0.0, 1.0, 2.0, 5.0, 10.0, 25.0, 50.0, 75.0, 90.0, 95.0, 98.0, 99.0, 100.0)) + " from px group by plate")
def image_percentiles(t: Tables) -> DataFrame:
    percents = [0.0, 1.0, 2.0, 5.0, 10.0, 25.0, 50.0, 75.0, 90.0, 95.0, 98.0, 99.0, 100.0]
    return rounded(objects.value_percentiles(images(t), ["plate"], percents), [f"p{p:g}" for p in percents], 8)


@query(f"with {QUAD} select vec_id, round(count(*) filter (label > 0) / count(*), 6) as area_occupied, round(count(*) filter (v > 0.2) / count(*), 6) as bright, coalesce(max(label), 0) as top_label from q group by vec_id")
def area_occupied(t: Tables) -> DataFrame:
    q = quadrants(images(t)).groupBy("vec_id")
    share = lambda c: F.round(F.sum(F.when(c, 1).otherwise(0)) / F.count(F.lit(1)), 6)
    return q.agg(share(F.col("label") > 0).alias("area_occupied"), share(F.col("v") > 0.2).alias("bright"), F.max("label").alias("top_label"))


@query(f"with {QUAD} select vec_id, " + ", ".join(f"max(v) filter (label = {i}) as max{i}" for i in range(1, 5)) + " from q where label > 0 group by vec_id")
def pivot_max(t: Tables) -> DataFrame:
    p = quadrants(images(t)).where("label > 0").groupBy("vec_id").pivot("label", [1, 2, 3, 4]).max("v")
    return p.withColumnsRenamed({str(i): f"max{i}" for i in range(1, 5)})


def two_channels(t: Tables) -> DataFrame:
    """Channel a and its mirror image b, per pixel."""
    p = images(t)
    mirror = p.select("vec_id", "y", (F.lit(SIDE - 1) - F.col("x")).alias("x"), F.col("v").alias("b"))
    return p.withColumnRenamed("v", "a").join(mirror, ["vec_id", "y", "x"])


TWO = f"{PX}, two as (select a.vec_id, a.plate, a.y, a.x, a.v as a, b.v as b from px a join px b on a.vec_id = b.vec_id and a.y = b.y and b.x = 7 - a.x)"


@query(f"""with {TWO}, m as (select vec_id, max(abs(a)) * 0.15 as ta, max(abs(b)) * 0.15 as tb from two group by vec_id), p as (select two.vec_id, abs(a) as a, abs(b) as b, ta, tb from two join m on two.vec_id = m.vec_id)
select vec_id, round(corr(a, b), 6) as correlation, round(regr_slope(b, a), 6) as slope, round(sum(case when a >= ta and b >= tb then a * b else 0 end) / sqrt(sum(case when a >= ta and b >= tb then a * a else 0 end) * sum(case when a >= ta and b >= tb then b * b else 0 end)), 6) as overlap,
 round(sum(case when a >= ta and b >= tb then a else 0 end) / sum(case when a >= ta then a else 0 end), 6) as manders_a, round(sum(case when a >= ta and b >= tb then b else 0 end) / sum(case when b >= tb then b else 0 end), 6) as manders_b from p group by vec_id""")
def colocalization(t: Tables) -> DataFrame:
    p = two_channels(t).withColumns({"a": F.abs("a"), "b": F.abs("b")})
    return rounded(objects.colocalised(p, ["vec_id"]), ["correlation", "slope", "overlap", "manders_a", "manders_b"])


@query(f"""with {QUAD}, {STRIPE}, o as (select s.vec_id, s.label as child, q.label as parent, count(*) as overlap from s join q on s.vec_id = q.vec_id and s.y = q.y and s.x = q.x where s.label > 0 and q.label > 0 and q.v < 0.12 group by 1, 2, 3),
r as (select *, row_number() over (partition by vec_id, child order by overlap desc, parent) as k from o), e as (select distinct vec_id, label as child from s where label > 0)
select e.vec_id, e.child, coalesce(parent, 0) as parent, coalesce(overlap, 0) as overlap from e left join (select * from r where k = 1) r on e.vec_id = r.vec_id and e.child = r.child""")
def relate_objects(t: Tables) -> DataFrame:
    p = images(t)
    parents = quadrants(p).where("v < 0.12")
    return objects.related(stripes(p), parents, ["vec_id"])


@query(f"""with {QUAD}, {STRIPE}, o as (select s.vec_id, s.label as child, q.label as parent, count(*) as overlap from s join q on s.vec_id = q.vec_id and s.y = q.y and s.x = q.x where s.label > 0 and q.label > 0 group by 1, 2, 3),
r as (select vec_id, parent, count(*) as n from (select *, row_number() over (partition by vec_id, child order by overlap desc, parent) as k from o) where k = 1 group by vec_id, parent), e as (select distinct vec_id, label as parent from q where label > 0)
select e.vec_id, e.parent, coalesce(n, 0) as children from e left join r on e.vec_id = r.vec_id and e.parent = r.parent""")
def children_counts(t: Tables) -> DataFrame:
    p = images(t)
    parents = quadrants(p)
    return objects.children_counts(parents, objects.related(stripes(p), parents, ["vec_id"]), ["vec_id"])


@query(f"""with {QUAD}, {STRIPE}, o as (select s.vec_id, s.label as child, q.label as parent, count(*) as overlap from s join q on s.vec_id = q.vec_id and s.y = q.y and s.x = q.x where s.label > 0 and q.label > 0 group by 1, 2, 3),
r as (select * from (select *, row_number() over (partition by vec_id, child order by overlap desc, parent) as k from o) where k = 1)
select s.vec_id, r.parent as label, count(*) as area from s join r on s.vec_id = r.vec_id and s.label = r.child group by 1, 2""")
def merge_per_parent(t: Tables) -> DataFrame:
    p = images(t)
    merged = objects.merged_by_parent(stripes(p), objects.related(stripes(p), quadrants(p), ["vec_id"]), ["vec_id"])
    return merged.groupBy("vec_id", "label").agg(F.count(F.lit(1)).alias("area"))


@query(f"with {QUAD}, {STRIPE} select q.vec_id, q.label, q.y, q.x from q where q.label > 0 and not exists (select 1 from s where s.label > 0 and s.vec_id = q.vec_id and s.y = q.y and s.x = q.x)")
def tertiary_objects(t: Tables) -> DataFrame:
    p = images(t)
    return objects.tertiary(quadrants(p), stripes(p), ["vec_id"]).select("vec_id", "label", "y", "x")


@query(f"with {QUAD}, {STRIPE} select q.vec_id, q.y, q.x, cast(dense_rank() over (partition by q.vec_id order by q.label) as integer) as label from q join s on s.vec_id = q.vec_id and s.y = q.y and s.x = q.x where q.label > 0 and s.label > 0")
def mask_objects_renumber(t: Tables) -> DataFrame:
    p = images(t)
    return objects.masked(quadrants(p), stripes(p), ["vec_id"], renumber=True).select("vec_id", "y", "x", "label")


@query(f"""with {QUAD}, {STRIPE}, a as (select vec_id, y, x, label from q where label = 2), b as (select vec_id, y, x, label from s where label > 0), m as (select vec_id, max(label) as top from a group by vec_id)
select coalesce(a.vec_id, b.vec_id) as vec_id, coalesce(a.y, b.y) as y, coalesce(a.x, b.x) as x, coalesce(a.label, b.label + coalesce(top, 0)) as label from a full join b on a.vec_id = b.vec_id and a.y = b.y and a.x = b.x left join m on m.vec_id = coalesce(a.vec_id, b.vec_id)""")
def combine_objects(t: Tables) -> DataFrame:
    p = images(t)
    return objects.combined(quadrants(p).where("label = 2"), stripes(p), ["vec_id"])


@query(f"with {PX} select vec_id, y, x, 'inclusive' as variant, v * case when v > 0.1 then 1 else 0 end as v from px union all select vec_id, y, x, 'exclusive', v * case when v > 0.1 then 0 else 1 end from px")
def masked_channel_pair(t: Tables) -> DataFrame:
    return pixels.masked_pair(images(t), F.col("v") > 0.1).select("vec_id", "y", "x", "variant", "v")


@query(f"with {PX} select vec_id, y, x, round(case when hi > lo then (v - lo) / (hi - lo) else 0 end, 8) as v from (select *, min(v) over (partition by vec_id) as lo, max(v) over (partition by vec_id) as hi from px)")
def rescale_intensity(t: Tables) -> DataFrame:
    return rounded(pixels.rescaled(images(t), ["vec_id"]).select("vec_id", "y", "x", "v"), ["v"], 8)


@query(f"with {PX} select vec_id, y, x, round((v - lo) / (hi - lo + 1e-6), 8) as v from (select *, min(v) over (partition by vec_id) as lo, max(v) over (partition by vec_id) as hi from px)")
def standardise(t: Tables) -> DataFrame:
    return rounded(pixels.standardised(images(t), ["vec_id"]).select("vec_id", "y", "x", "v"), ["v"], 8)


@query(f"with {PX}, g as (select vec_id, quantile_cont(v, 0.01) as a, quantile_cont(v, 0.9999) as b from px group by vec_id) select px.vec_id, y, x, round(greatest(0, (v - a) / (b - a)), 7) as v from px join g on px.vec_id = g.vec_id")
def percentile_normalise(t: Tables) -> DataFrame:
    return rounded(pixels.percentile_normalised(images(t), ["vec_id"]).select("vec_id", "y", "x", "v"), ["v"], 7)


@query(f"with {TWO} select vec_id, y, x, 'add' as how, round(least(greatest(a + b, 0), 1), 8) as v from two union all select vec_id, y, x, 'subtract', round(least(greatest(a - b, 0), 1), 8) from two union all select vec_id, y, x, 'multiply', round(least(greatest(a * b, 0), 1), 8) from two union all select vec_id, y, x, 'maximum', round(least(greatest(greatest(a, b), 0), 1), 8) from two")
def image_math(t: Tables) -> DataFrame:
    p = images(t).select("vec_id", "y", "x", "v")
    mirror = p.withColumn("x", F.lit(SIDE - 1) - F.col("x"))
    out = pixels.several_math(p, mirror, ["vec_id"], ["add", "subtract", "multiply", "maximum"])
    return rounded(out.select("vec_id", "y", "x", "how", "v"), ["v"], 8)


@query(f"""with {PX}, s as (select vec_id, min(v) as lo, max(v) as hi from px group by vec_id), b as (select px.vec_id, lo, hi, least(floor((v - lo) / (hi - lo) * 256), 255) as bin from px join s on px.vec_id = s.vec_id where hi > lo),
c as (select vec_id, lo, hi, bin, count(*) as n, lo + (bin + 0.5) * (hi - lo) / 256 as centre from b group by vec_id, lo, hi, bin), d as (select *, sum(n) over w as w1, sum(n * centre) over w as m1, sum(n) over (partition by vec_id) as wt, sum(n * centre) over (partition by vec_id) as mt from c window w as (partition by vec_id order by bin)),
e as (select vec_id, bin, centre, round(w1 * (wt - w1) * pow(m1 / w1 - (mt - m1) / (wt - w1), 2) / wt / wt, 9) as b from d where w1 < wt), f as (select *, row_number() over (partition by vec_id order by b desc, bin) as r from e)
select s.vec_id, round(coalesce(centre, lo), 7) as threshold from s left join (select * from f where r = 1) f on s.vec_id = f.vec_id""")
def otsu_threshold(t: Tables) -> DataFrame:
    return rounded(pixels.otsu(images(t), ["vec_id"], "v"), ["threshold"], 7)


@query(f"with {QUAD}, a as (select vec_id, y, x, abs(v) as v from px) select vec_id, round(sum(v * y) / sum(v), 7) as cy, round(sum(v * x) / sum(v), 7) as cx from a group by vec_id")
def centre_of_mass(t: Tables) -> DataFrame:
    return rounded(pixels.recentre(images(t).withColumn("v", F.abs("v")), ["vec_id"]), ["cy", "cx"], 7)


@query(f"""with {QUAD}, s as (select vec_id, label, count(*)::double as n, sum(y) as sy, sum(x) as sx, sum(y * y) as syy, sum(x * x) as sxx, sum(x * y) as sxy from q where label > 0 group by 1, 2),
m as (select *, syy / n - pow(sy / n, 2) + 1 / 12.0 as myy, sxx / n - pow(sx / n, 2) + 1 / 12.0 as mxx, sxy / n - sx / n * sy / n as mxy from s),
r as (select *, (myy + mxx) / 2 as h, sqrt(pow((myy - mxx) / 2, 2) + mxy * mxy) as d from m)
select vec_id, label, n::bigint as area, round(4 * sqrt(h + d), 6) as major, round(4 * sqrt(greatest(h - d, 0)), 6) as minor, round(sqrt(4 * n / pi()), 6) as equivalent_diameter from r""")
def object_shape(t: Tables) -> DataFrame:
    s = objects.shape(quadrants(images(t)), ["vec_id"]).drop("eccentricity")
    return rounded(s, ["major", "minor", "equivalent_diameter"])


@query(f"""with {QUAD}, g as (select vec_id, y, x, label, cast(least(floor((v + 0.5) * 8), 7) as integer) as g from q where label > 0), pr as (select a.vec_id, a.label, a.g as i, b.g as j from g a join g b on a.vec_id = b.vec_id and a.label = b.label and b.y = a.y and b.x = a.x + 1),
bo as (select * from pr union all select vec_id, label, j, i from pr), c as (select vec_id, label, i, j, count(*)::double as n from bo group by 1, 2, 3, 4), s as (select vec_id, label, sum(n) as t, sum(n * i) as si, sum(n * i * i) as sii from c group by 1, 2),
p as (select c.*, n / t as p, si / t as mu, sii / t - pow(si / t, 2) as var from c join s on c.vec_id = s.vec_id and c.label = s.label)
select vec_id, label, round(sum(p * p), 6) as energy, round(sum(p * (i - j) * (i - j)), 6) as contrast, round(sum(case when var > 1e-12 then p * (i - mu) * (j - mu) / var end), 6) as correlation, round(max(var), 6) as variance, round(sum(p / (1 + (i - j) * (i - j))), 6) as homogeneity, round(-sum(p * log2(p)), 6) + 0.0 as entropy from p group by 1, 2""")
def haralick_glcm(t: Tables) -> DataFrame:
    q = quadrants(images(t)).withColumn("g", F.least(F.floor((F.col("v") + 0.5) * 8), F.lit(7)).cast("int"))
    h = rounded(objects.haralick(q, ["vec_id"], 8, 0, 1), ["energy", "contrast", "correlation", "variance", "homogeneity", "entropy"])
    return h.withColumn("entropy", F.col("entropy") + F.lit(0.0))


@query(f"""with {QUAD}, a as (select vec_id, label, y, x, v, avg(y) over w as cy, avg(x) over w as cx from q where label > 0 window w as (partition by vec_id, label)), r as (select *, sqrt((y - cy) * (y - cy) + (x - cx) * (x - cx)) as r from a), m as (select *, max(r) over (partition by vec_id, label) as top from r),
g as (select vec_id, label, case when top > 0 then cast(least(floor(round(r / top, 9) * 4), 3) as integer) else 0 end as ring, v from m), s as (select vec_id, label, ring, sum(v) as s, count(*) as n, avg(v) as m, stddev_pop(v) as sd from g group by 1, 2, 3)
select vec_id, label, ring, round(s / sum(s) over w, 6) as frac_at_d, round(s / sum(s) over w / (n / sum(n) over w), 6) as mean_frac, round(case when m <> 0 then sd / m end, 6) as radial_cv from s window w as (partition by vec_id, label)""")
def radial_distribution(t: Tables) -> DataFrame:
    return rounded(objects.radial(quadrants(images(t)), ["vec_id"], 4), ["frac_at_d", "mean_frac", "radial_cv"])


@query(f"with {TWO} select vec_id, round(corr(a * (case when a > 0 then 1 else 0 end), b * (case when a > 0 then 1 else 0 end)), 6) as r_b, round(corr(a * (case when a > 0 then 1 else 0 end), a * (case when a > 0 then 1 else 0 end)), 6) as r_a, round(sum(case when a > 0 and b > 0 then 1.0 else 0 end) / sum(case when a > 0 then 1.0 else 0 end) * 100, 6) as ppix_ba, round(sum(case when a > 0 and b > 0 then 1.0 else 0 end) / sum(case when b > 0 then 1.0 else 0 end) * 100, 6) as ppix_ab from two group by vec_id")
def registration_eval(t: Tables) -> DataFrame:
    on = lambda c: F.when(F.col(c) > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    two = two_channels(t).select("vec_id", "a", F.col("a").alias("after"), F.col("b").alias("c"), on("a").alias("ma"), on("b").alias("mb")).withColumnRenamed("after", "b")
    return rounded(registration.evaluation(two, ["vec_id"]), ["r_b", "r_a", "ppix_ba", "ppix_ab"])


def _gram_sql() -> str:
    term = lambda e: "*".join(["1.0", *["(x / 7.0)"] * e[0], *["(y / 7.0)"] * e[1]])
    terms = [term(e) for e in numeric.SURFACE_TERMS]
    sums = [f"round(sum({terms[i]} * {terms[j]}), 5) as g_{i}_{j}" for i in range(15) for j in range(i + 1)] + [f"round(sum({a} * v), 5) as b_{i}" for i, a in enumerate(terms)]
    return f"with {PX} select plate, count(*) as n, {', '.join(sums)} from px where v <> 0 group by plate"


@query(_gram_sql())
def polyfit_gram_sums(t: Tables) -> DataFrame:
    g = flatfield.gram_sums(images(t), ["plate"], SIDE)
    return rounded(g, [c for c in g.columns if c not in ("plate", "n")], 5)


@query(f"with {PX}, f as (select plate, y, x, avg(v) + 1 as flat, 0.01 as dark from px where plate in (select plate from px group by plate having avg(v) > 0) group by plate, y, x) select vec_id, px.y, px.x, round(coalesce((v - dark) / flat, v), 7) as v from px left join f on px.plate = f.plate and px.y = f.y and px.x = f.x")
def flatfield_apply(t: Tables) -> DataFrame:
    p = images(t)
    bright = p.groupBy("plate").agg(F.avg("v").alias("m")).where("m > 0").select("plate")
    field = p.join(bright, "plate", "left_semi").groupBy("plate", "y", "x").agg((F.avg("v") + 1).alias("flat")).withColumn("dark", F.lit(0.01))
    return rounded(pixels.with_flatfield(p, field, ["plate"]).select("vec_id", "y", "x", "v"), ["v"], 7)


@query(f"with {PX}, i as (select plate, y, x, avg(v) as v from px group by 1, 2, 3) select plate, cast(y // 2 as integer) as bin_y, cast(x // 2 as integer) as bin_x, round(avg(v), 7) as mean from i group by plate, y // 2, x // 2")
def flatfield_bins(t: Tables) -> DataFrame:
    return rounded(flatfield.evaluation(images(t), ["plate"], 4, SIDE), ["mean"], 7)


@query(f"with {QUAD} select vec_id, label, round(corr(v, w), 6) as corr from (select a.vec_id, a.label, a.v, b.v as w from q a join px b on a.vec_id = b.vec_id and a.y = b.y and b.x = 7 - a.x where a.label > 0) group by 1, 2 having count(*) > 3")
def cell_channel_correlation(t: Tables) -> DataFrame:
    two = two_channels(t).withColumn("v", F.col("a"))
    c = quadrants(two).where("label > 0").groupBy("vec_id", "label").agg(numeric.correlation(F.col("a"), F.col("b")).alias("corr"), F.count(F.lit(1)).alias("n")).where("n > 3").drop("n")
    return rounded(c, ["corr"])


@query(f"with {PX} select vec_id, cast(row_number() over (partition by plate order by vec_id) as integer) as object_number, cast(dense_rank() over (order by plate) as integer) as image_number from (select distinct vec_id, plate from px)")
def object_numbers(t: Tables) -> DataFrame:
    """One-based numbers of objects within images and of images, over a stated order."""
    images_ = t.embeddings.select("vec_id", F.col("label").alias("plate")).distinct()
    rank = numbered(images_.select("plate").distinct(), [], "plate", "image_number").withColumn("image_number", F.col("image_number").cast("int"))
    return numbered(images_.join(rank, "plate"), ["plate"], "vec_id", "object_number").select("vec_id", F.col("object_number").cast("int").alias("object_number"), "image_number")


@query(f"""with {PX}, p as (select vec_id, y, x, v, max(v) over (partition by vec_id, y) / 2 as half, lag(v) over w as b, lead(v) over w as a from px window w as (partition by vec_id, y order by x)),
k as (select *, row_number() over (partition by vec_id, y order by x) as f, row_number() over (partition by vec_id, y order by x desc) as l from p where half > 0 and v >= half)
select f.vec_id, f.y, round(r.x + coalesce((r.v - r.half) / (r.v - r.a), 0) - (f.x - coalesce((f.v - f.half) / (f.v - f.b), 0)), 7) as width from (select * from k where f = 1) f join (select * from k where l = 1) r on f.vec_id = r.vec_id and f.y = r.y""")
def half_width_rows(t: Tables) -> DataFrame:
    return rounded(profiles.half_width(images(t), ["vec_id", "y"], "x", "v"), ["width"], 7)


@query(f"with {PX}, g as (select vec_id, max(v) as hi, min(v) as lo from px group by vec_id) select px.vec_id, round(avg(v), 7) as mean, round(stddev_pop(v), 7) as std, round(count(*) filter (v = hi) / count(*) * 100, 5) as percent_max, round(count(*) filter (v = lo) / count(*) * 100, 5) as percent_min from px join g on px.vec_id = g.vec_id group by px.vec_id")
def image_quality(t: Tables) -> DataFrame:
    q = rounded(profiles.quality(images(t), ["vec_id"]), ["mean", "std"], 7)
    return rounded(q, ["percent_max", "percent_min"], 5)


@query(f"with {PX} select vec_id, round(quantile_cont(v, 0.9), 8) as background from px where y < 1 or y >= 7 or x < 1 or x >= 7 group by vec_id")
def rim_background(t: Tables) -> DataFrame:
    return rounded(profiles.background(images(t), ["vec_id"], SIDE, 1, 90), ["background"], 8)


@query(f"""with {PX}, k as (select vec_id, y // 4 as ty, x // 4 as tx, v from px), s as (select vec_id, ty, tx, min(v) as lo, max(v) as hi from k group by all), b as (select k.vec_id, k.ty, k.tx, lo, hi, least(floor((v - lo) / (hi - lo) * 64), 63) as bin from k join s on k.vec_id = s.vec_id and k.ty = s.ty and k.tx = s.tx where hi > lo),
c as (select vec_id, ty, tx, bin, count(*) as n, lo + (bin + 0.5) * (hi - lo) / 64 as centre from b group by vec_id, ty, tx, lo, hi, bin), d as (select *, sum(n) over w as w1, sum(n * centre) over w as m1, sum(n) over (partition by vec_id, ty, tx) as wt, sum(n * centre) over (partition by vec_id, ty, tx) as mt from c window w as (partition by vec_id, ty, tx order by bin)),
e as (select vec_id, ty, tx, bin, centre, round(w1 * (wt - w1) * pow(m1 / w1 - (mt - m1) / (wt - w1), 2) / wt / wt, 9) as b from d where w1 < wt), f as (select *, row_number() over (partition by vec_id, ty, tx order by b desc, bin) as r from e)
select s.vec_id, cast(s.ty as integer) as tile_y, cast(s.tx as integer) as tile_x, round(coalesce(centre, lo), 7) as threshold from s left join (select * from f where r = 1) f on s.vec_id = f.vec_id and s.ty = f.ty and s.tx = f.tx""")
def adaptive_otsu(t: Tables) -> DataFrame:
    """A threshold for every tile of an image."""
    tiles = images(t).withColumns({"tile_y": F.floor(F.col("y") / 4).cast("int"), "tile_x": F.floor(F.col("x") / 4).cast("int")})
    return rounded(pixels.otsu(tiles, ["vec_id", "tile_y", "tile_x"], "v", 64), ["threshold"], 7)


@query(f"""with {PX}, f as (select plate, max(v) as factor from px group by plate having max(v) > 0.5) select vec_id, y, x, cast(least(greatest(round_even(abs(v) * 60000 / coalesce(factor, 1), 0), 0), 65535) as integer) as v from px left join f on px.plate = f.plate""")
def scale_apply(t: Tables) -> DataFrame:
    """Divide by the plate's factor where there is one, then clip to 16 bits."""
    p = images(t)
    factors = p.groupBy("plate").agg(F.max("v").alias("factor")).where("factor > 0.5")
    scaled = F.abs("v") * 60000 / F.coalesce("factor", F.lit(1.0))
    return p.join(factors, "plate", "left").select("vec_id", "y", "x", numeric.to_uint16(scaled).alias("v"))


@query(f"""with {PX}, a as (select vec_id, y, x, v, cast(floor((v + 1) * 10) as integer) as g from px), s as (select vec_id, g, count(*) as n from a group by 1, 2), c as (select vec_id, g, sum(n) over (partition by vec_id order by g) / 64.0 as share from s),
t as (select m.vec_id, 19 - m.g as g, sum(m.n) over (partition by m.vec_id order by 19 - m.g) / 64.0 as share from s m), k as (select c.vec_id, c.g, min(t.g) as matched from c join t on c.vec_id = t.vec_id and t.share >= c.share - 1e-9 group by 1, 2)
select a.vec_id, a.y, a.x, cast(k.matched as double) as v from a join k on a.vec_id = k.vec_id and a.g = k.g""")
def histogram_matching(t: Tables) -> DataFrame:
    """Grey levels matched to the histogram of the inverted image."""
    level = images(t).withColumn("v", F.floor((F.col("v") + 1) * 10).cast("double")).select("vec_id", "y", "x", "v")
    return pixels.matched_histogram(level, level.withColumn("v", F.lit(19.0) - F.col("v")), ["vec_id"]).select("vec_id", "y", "x", "v")


@query()
def udtf_blobs(t: Tables) -> DataFrame:
    tables.register(t.spark)
    t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("pixels")).createOrReplaceTempView("wellspan_images")
    return t.spark.sql("select vec_id, b.y, b.x, b.sigma from wellspan_images, lateral image_blobs(pixels, 8, 0.05) b")


@query(f"with {QUAD} select vec_id, label, round(median(v), 6) as middle from q where label > 0 group by vec_id, label")
def custom_property(t: Tables) -> DataFrame:
    """A user's own aggregate of the pixels of each object, as a grouped function."""

    @F.pandas_udf("double")
    def own(values: pd.Series) -> float:
        return float(values.median())

    return quadrants(images(t)).where("label > 0").groupBy("vec_id", "label").agg(F.round(own("v"), 6).alias("middle"))
