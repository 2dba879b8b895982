"""Queries of object measurements, textures, neighbours and image quality, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import costes, filters, measures, morphology, objects, pixels
from ..registry import Tables, query
from .imaging import PX, QUAD, SIDE, TWO, images, quadrants, rounded, two_channels

AROUND = "o.vec_id = e.vec_id and o.label = e.label and abs(o.y - e.y) + abs(o.x - e.x) = 1"
RIM = f"rim as (select e.vec_id, e.label, e.y, e.x, any_value(e.v) as v from q e left join q o on {AROUND} where e.label > 0 group by e.vec_id, e.label, e.y, e.x having count(o.v) < 4)"


@query(f"""with {QUAD}, {RIM}, f as (select vec_id, label, sum(v) as integrated, avg(v) as mean, stddev_pop(v) as std, min(v) as min, max(v) as max, quantile_cont(v, 0.25) as lower_quartile, median(v) as median, quantile_cont(v, 0.75) as upper_quartile,
 avg(x) as center_x, avg(y) as center_y, sum(v * x) / sum(v) as center_mass_x, sum(v * y) / sum(v) as center_mass_y from q where label > 0 group by 1, 2),
m as (select q.vec_id, q.label, median(abs(v - median)) as mad from q join f on q.vec_id = f.vec_id and q.label = f.label group by 1, 2),
t as (select vec_id, label, y as max_y, x as max_x from (select *, row_number() over (partition by vec_id, label order by v desc, y, x) as r from q where label > 0) where r = 1),
e as (select vec_id, label, sum(v) as integrated_edge, avg(v) as mean_edge, stddev_pop(v) as std_edge, min(v) as min_edge, max(v) as max_edge from rim group by 1, 2)
select f.vec_id, f.label, max_y, max_x, {", ".join(f"round({c}, 6) as {c}" for c in ("integrated", "mean", "std", "min", "max", "lower_quartile", "median", "upper_quartile", "mad", "center_x", "center_y", "center_mass_x", "center_mass_y", "integrated_edge", "mean_edge", "std_edge", "min_edge", "max_edge"))},
 round(sqrt(pow(center_x - center_mass_x, 2) + pow(center_y - center_mass_y, 2)), 6) as mass_displacement from f join m using (vec_id, label) join t using (vec_id, label) join e using (vec_id, label)""")
def object_intensity(t: Tables) -> DataFrame:
    m = measures.intensity(quadrants(images(t)), ["vec_id"])
    return rounded(m, [c for c in m.columns if c not in ("vec_id", "label", "max_y", "max_x")])


@query(f"""with {QUAD}, {RIM} select vec_id, label, y, x from rim""")
def object_edges(t: Tables) -> DataFrame:
    return measures.edges(quadrants(images(t)), ["vec_id"]).select("vec_id", "label", "y", "x")


#: Moments are ratios of small numbers and may end in 5: shifted off the tie before rounding.
TIE = {n: 2.3 * 10.0 ** (-n - 3) for n in (3, 5, 6, 7)}


def _moment_sql() -> str:
    raw = ", ".join(f"sum(pow(y - y0, {i}) * pow(x - x0, {j})) as m_{i}_{j}" for i in range(4) for j in range(4))
    mu = ", ".join(f"sum(pow(y - cy, {i}) * pow(x - cx, {j})) as mu_{i}_{j}" for i in range(4) for j in range(4))
    nu = ", ".join(f"mu_{i}_{j} / pow(n, {1 + (i + j) / 2}) as nu_{i}_{j}" for i in range(4) for j in range(4) if i + j >= 2)
    hu = (
        "nu_2_0 + nu_0_2", "pow(nu_2_0 - nu_0_2, 2) + 4 * pow(nu_1_1, 2)", "pow(nu_3_0 - 3 * nu_1_2, 2) + pow(3 * nu_2_1 - nu_0_3, 2)", "pow(nu_3_0 + nu_1_2, 2) + pow(nu_2_1 + nu_0_3, 2)",
        "(nu_3_0 - 3 * nu_1_2) * (nu_3_0 + nu_1_2) * (pow(nu_3_0 + nu_1_2, 2) - 3 * pow(nu_2_1 + nu_0_3, 2)) + (3 * nu_2_1 - nu_0_3) * (nu_2_1 + nu_0_3) * (3 * pow(nu_3_0 + nu_1_2, 2) - pow(nu_2_1 + nu_0_3, 2))",
        "(nu_2_0 - nu_0_2) * (pow(nu_3_0 + nu_1_2, 2) - pow(nu_2_1 + nu_0_3, 2)) + 4 * nu_1_1 * (nu_3_0 + nu_1_2) * (nu_2_1 + nu_0_3)",
        "(3 * nu_2_1 - nu_0_3) * (nu_3_0 + nu_1_2) * (pow(nu_3_0 + nu_1_2, 2) - 3 * pow(nu_2_1 + nu_0_3, 2)) - (nu_3_0 - 3 * nu_1_2) * (nu_2_1 + nu_0_3) * (3 * pow(nu_3_0 + nu_1_2, 2) - pow(nu_2_1 + nu_0_3, 2))",
    )
    shown = [f"round(m_{i}_{j} + {TIE[3]}, 3) as m_{i}_{j}" for i in range(4) for j in range(4)] + [f"round(mu_{i}_{j} + {TIE[5]}, 5) + 0.0 as mu_{i}_{j}" for i in range(4) for j in range(4)]
    shown += [f"round(nu_{i}_{j} + {TIE[7]}, 7) + 0.0 as nu_{i}_{j}" for i in range(4) for j in range(4) if i + j >= 2] + [f"round({h} + {TIE[7]}, 7) + 0.0 as hu_{k}" for k, h in enumerate(hu)]
    return f"""with {QUAD}, b as (select *, avg(y) over w as cy, avg(x) over w as cx, min(y) over w as y0, max(y) over w as y1, min(x) over w as x0, max(x) over w as x1 from q where label > 0 window w as (partition by vec_id, label)),
s as (select vec_id, label, y0, y1, x0, x1, count(*)::double as n, any_value(cy) as cy, any_value(cx) as cx, {raw}, {mu} from b group by vec_id, label, y0, y1, x0, x1), k as (select *, {nu}, mu_2_0 / n as a, mu_0_2 / n as b, mu_1_1 / n as c from s)
select vec_id, label, y0, y1, x0, x1, n::bigint as area, (y1 - y0 + 1) * (x1 - x0 + 1) as bbox_area, round(cy + {TIE[6]}, 6) as center_y, round(cx + {TIE[6]}, 6) as center_x, round(n / ((y1 - y0 + 1) * (x1 - x0 + 1)) + {TIE[6]}, 6) as extent,
 round(b + {TIE[6]}, 6) as inertia_0_0, round(a + {TIE[6]}, 6) as inertia_1_1, round(-c + {TIE[6]}, 6) + 0.0 as inertia_0_1, round((a + b) / 2 + sqrt(pow((a - b) / 2, 2) + c * c) + {TIE[6]}, 6) as eigenvalue_0, round(greatest((a + b) / 2 - sqrt(pow((a - b) / 2, 2) + c * c), 0) + {TIE[6]}, 6) as eigenvalue_1, {", ".join(shown)} from k"""


@query(_moment_sql())
def object_moments(t: Tables) -> DataFrame:
    m = measures.moments(quadrants(images(t)), ["vec_id"]).drop("orientation")
    digits = {"m_": 3, "mu": 5, "nu": 7, "hu": 7}
    return m.withColumns({c: F.round(F.col(c) + F.lit(TIE[digits.get(c[:2], 6)]), digits.get(c[:2], 6)) + F.lit(0.0) for c in m.columns if c not in ("vec_id", "label", "y0", "y1", "x0", "x1", "area", "bbox_area")})


@query(f"""with {QUAD}, {RIM}, n as (select a.vec_id, a.label, a.y, a.x, 1 + count(b.v) filter (abs(a.y - b.y) + abs(a.x - b.x) = 1) * 2 + count(b.v) filter (abs(a.y - b.y) = 1 and abs(a.x - b.x) = 1) * 10 as code
 from rim a left join rim b on a.vec_id = b.vec_id and a.label = b.label and greatest(abs(a.y - b.y), abs(a.x - b.x)) = 1 group by 1, 2, 3, 4),
p as (select vec_id, label, sum(case when code in (5, 7, 15, 17, 25, 27) then 1 when code in (21, 33) then sqrt(2) when code in (13, 23) then (1 + sqrt(2)) / 2 else 0 end) as perimeter from n group by 1, 2),
u as (select vec_id, label, y - dy as sy, x - dx as sx, sum(pow(2, 2 * dy + dx))::int as bits from q cross join (select unnest([0, 1]) as dy) cross join (select unnest([0, 1]) as dx) where label > 0 group by 1, 2, 3, 4),
e as (select vec_id, label, cast((count(*) filter (bits in (1, 2, 4, 8)) - count(*) filter (bits in (7, 11, 13, 14)) - 2 * count(*) filter (bits in (6, 9))) / 4 as integer) as euler from u group by 1, 2), a as (select vec_id, label, count(*) as area from q where label > 0 group by 1, 2)
select vec_id, label, area, round(perimeter, 6) as perimeter, euler, round(4 * pi() * area / pow(nullif(perimeter, 0), 2), 6) as form_factor, round(pow(nullif(perimeter, 0), 2) / (4 * pi() * area), 6) as compactness from a join p using (vec_id, label) join e using (vec_id, label)""")
def object_geometry(t: Tables) -> DataFrame:
    return rounded(measures.geometry(quadrants(images(t)), ["vec_id"]), ["perimeter", "form_factor", "compactness"])


def _haralick_sql(source: str, levels: int, scales: list[int]) -> str:
    steps = ", ".join(f"({s}, {k}, {a * s}, {b * s})" for s in scales for k, (a, b) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))))
    return f"""with {source}, g as (select vec_id, y, x, label, cast(greatest(least(floor((v + 0.5) * {levels}), {levels - 1}), 0) as integer) as g from q where label > 0),
o as (select * from (values {steps}) t(scale, direction, dy, dx)),
pr as (select a.vec_id, a.label, scale, direction, a.g as i, b.g as j from g a cross join o join g b on a.vec_id = b.vec_id and a.label = b.label and b.y = a.y + dy and b.x = a.x + dx),
c as (select vec_id, label, scale, direction, i, j, count(*)::double as n from (select * from pr union all select vec_id, label, scale, direction, j, i from pr) group by all),
p as (select *, n / sum(n) over (partition by vec_id, label, scale, direction) as p from c),
mx as (select vec_id, label, scale, direction, -sum(px * log2(px)) as hx, sum(i * px) as mu, sum(i * i * px) - pow(sum(i * px), 2) as var from (select vec_id, label, scale, direction, i, sum(p) as px from p group by all) group by all),
sx as (select vec_id, label, scale, direction, sum(k * ps) as sa, sum(k * k * ps) - pow(sum(k * ps), 2) as sv, -sum(ps * log2(ps)) as se from (select vec_id, label, scale, direction, i + j as k, sum(p) as ps from p group by all) group by all),
dx as (select vec_id, label, scale, direction, sum(k * k * pd) as ct, sum(k * k * pd) - pow(sum(k * pd), 2) as dv, -sum(pd * log2(pd)) as de, sum(pd / (1 + k * k)) as im from (select vec_id, label, scale, direction, abs(i - j) as k, sum(p) as pd from p group by all) group by all),
pp as (select vec_id, label, scale, direction, sum(p * p) as asm, -sum(p * log2(p)) as h, sum(p * i * j) as rc from p group by all)
select vec_id, label, scale, direction, round(asm, 6) as angular_second_moment, round(ct, 6) + 0.0 as contrast, round(case when var > 1e-12 then (rc - mu * mu) / var else 1 end, 5) + 0.0 as correlation, round(var, 6) + 0.0 as variance, round(im, 6) as inverse_difference_moment, round(sa, 6) + 0.0 as sum_average, round(sv, 6) + 0.0 as sum_variance,
 round(se, 6) + 0.0 as sum_entropy, round(h, 6) + 0.0 as entropy, round(dv, 6) + 0.0 as difference_variance, round(de, 6) + 0.0 as difference_entropy, round(case when hx > 1e-12 then (h - 2 * hx) / hx else 0 end, 6) + 0.0 as info_meas1, round(sqrt(greatest(0, 1 - exp(-2 * (2 * hx - h)))), 5) + 0.0 as info_meas2
from pp join dx using (vec_id, label, scale, direction) join sx using (vec_id, label, scale, direction) join mx using (vec_id, label, scale, direction)"""


def _haralick(p: DataFrame, levels: int, scales: list[int]) -> DataFrame:
    grey = F.greatest(F.least(F.floor((F.col("v") + 0.5) * levels), F.lit(levels - 1)), F.lit(0)).cast("int")
    m = measures.textures(p.withColumn("g", grey), ["vec_id"], levels, scales)
    return m.withColumns({c: F.round(c, 5 if c in ("correlation", "info_meas2") else 6) + F.lit(0.0) for c in measures.TEXTURES})


@query(_haralick_sql(QUAD, 8, [1, 2]))
def haralick_thirteen(t: Tables) -> DataFrame:
    return _haralick(quadrants(images(t)), 8, [1, 2])


@query(_haralick_sql(f"{PX}, q as (select *, 1 as label from px)", 256, [3, 12]))
def haralick_256_levels(t: Tables) -> DataFrame:
    """Whole images at 256 levels and scales 3 and 12; at 12 no two pixels of these images are that far apart."""
    return _haralick(images(t).withColumn("label", F.lit(1)), 256, [3, 12])


@query(f"""with {QUAD}, {RIM}, met as (select distinct a.vec_id, a.y, a.x, a.label, b.label as other from q a join q b on a.vec_id = b.vec_id and a.label > 0 and b.label > 0 and a.label <> b.label and greatest(abs(a.y - b.y), abs(a.x - b.x)) = 1),
n as (select vec_id, label, count(distinct other) as neighbours from met group by 1, 2), s as (select r.vec_id, r.label, round(count(m.label) / count(*) * 100, 6) as percent_touching from rim r left join (select distinct vec_id, y, x, label from met) m on r.vec_id = m.vec_id and r.y = m.y and r.x = m.x and r.label = m.label group by 1, 2)
select s.vec_id, s.label, percent_touching, coalesce(neighbours, 0) as neighbours from s left join n on s.vec_id = n.vec_id and s.label = n.label""")
def neighbours_adjacent(t: Tables) -> DataFrame:
    return rounded(measures.touching(quadrants(images(t)), ["vec_id"]), ["percent_touching"])


@query(f"""with {PX}, a as (select vec_id, y, x, abs(v) as v from px), f as (select vec_id, min(v) as min, max(v) as max, avg(v) as mean, median(v) as median, stddev_pop(v) as std, sum(v) as total_intensity, count(*) as total_area, var_pop(v) / avg(v) as focus_score from a group by 1),
s as (select a.vec_id, median(abs(v - median)) as mad, count(*) filter (v = min) / count(*) * 100 as percent_minimal, count(*) filter (v = max) / count(*) * 100 as percent_maximal from a join f on a.vec_id = f.vec_id group by 1),
l as (select vec_id, median(s / m) as local_focus_score from (select vec_id, avg(v) as m, var_pop(v) as s from a group by vec_id, y // 4, x // 4) where m > 0 group by 1)
select vec_id, total_area, {", ".join(f"round({c}, 7) as {c}" for c in ("min", "max", "mean", "median", "std", "total_intensity", "focus_score", "mad", "percent_minimal", "percent_maximal", "local_focus_score"))} from f join s using (vec_id) join l using (vec_id)""")
def image_quality_full(t: Tables) -> DataFrame:
    p = images(t).withColumn("v", F.abs("v")).select("vec_id", "y", "x", "v")
    m = measures.quality(p, ["vec_id"], SIDE // 2)
    return rounded(m, [c for c in m.columns if c not in ("vec_id", "total_area")], 7)


@query(f"""with {TWO}, r as (select vec_id, abs(a) as a, abs(b) as b, dense_rank() over (partition by vec_id order by abs(a)) as ra, dense_rank() over (partition by vec_id order by abs(b)) as rb from two), t as (select vec_id, max(a) * 0.15 as ta, max(b) * 0.15 as tb, greatest(max(ra), max(rb)) as most from r group by 1),
p as (select r.*, ta, tb, (most - abs(ra - rb)) / most as w from r join t on r.vec_id = t.vec_id)
select vec_id, round(sum(case when a >= ta and b >= tb then a * w else 0 end) / sum(case when a >= ta then a else 0 end), 7) as rwc_a, round(sum(case when a >= ta and b >= tb then b * w else 0 end) / sum(case when b >= tb then b else 0 end), 7) as rwc_b from p group by vec_id""")
def rank_weighted_colocalization(t: Tables) -> DataFrame:
    p = two_channels(t).withColumns({"a": F.abs("a"), "b": F.abs("b")})
    return rounded(objects.rank_weighted(p, ["vec_id"]), ["rwc_a", "rwc_b"], 7)


@query(f"""with {TWO}, d as (select vec_id, y, x, a * a as a, abs(a * b) + a * a / 2 as b from two), v as (select vec_id, var_samp(a) as va, var_samp(b) as vb, covar_samp(a, b) as c, avg(a) as ma, avg(b) as mb from d where a > 0 or b > 0 group by 1), l as (select *, ((vb - va) + sqrt(pow(vb - va, 2) + 4 * c * c)) / (2 * c) as s from v where c <> 0),
m as (select d.vec_id, any_value(s) as s, any_value(mb - s * ma) as o, max(a) as ta, max(b) as tb from d join l on d.vec_id = l.vec_id group by 1), k as (select m.*, unnest(range(1, cast(floor(greatest(ta, tb) * 1000) as bigint) + 2)) as k from m),
w as (select k.*, max(k) filter (not (k / 1000 > ta and s * k / 1000 + o > tb)) over (partition by vec_id) as start from k),
r as (select w.vec_id, w.k, w.start, count(*) as n, corr(a, b) as r from w join d on d.vec_id = w.vec_id and (a < k / 1000 or b < s * k / 1000 + o) where k <= start group by 1, 2, 3), f as (select vec_id, coalesce(max(k) filter (k >= 2 and (n < 2 or r <= 1e-12)), least(2, max(start))) as k from r group by 1),
t as (select m.vec_id, k / 1000 as ta, s * k / 1000 + o as tb from m join f on m.vec_id = f.vec_id)
select t.vec_id, round(any_value(ta), 6) as threshold_a, round(any_value(tb), 6) as threshold_b, round(sum(case when a >= ta and b >= tb then a else 0 end) / nullif(sum(case when a >= ta then a else 0 end), 0), 6) as costes_a, round(sum(case when a >= ta and b >= tb then b else 0 end) / nullif(sum(case when b >= tb then b else 0 end), 0), 6) as costes_b from t join d on d.vec_id = t.vec_id group by 1""")
def costes_colocalization(t: Tables) -> DataFrame:
    """Two channels that correlate where they are bright; thresholds in steps of a thousandth."""
    p = two_channels(t).select("vec_id", "y", "x", (F.col("a") * F.col("a")).alias("a"), (F.abs(F.col("a") * F.col("b")) + F.col("a") * F.col("a") / 2).alias("b"))
    return rounded(costes.coefficients(p, ["vec_id"], 1000), ["threshold_a", "threshold_b", "costes_a", "costes_b"])


@query(f"with {PX} select vec_id, " + ", ".join(f"round(quantile_cont(v, {q}), 8) as p{n}" for q, n in ((0.1, 10), (0.5, 50), (0.9, 90))) + " from px where v > 0 group by vec_id")
def masked_percentiles(t: Tables) -> DataFrame:
    """Percentiles of each image inside its mask."""
    return rounded(objects.value_percentiles(images(t).where("v > 0"), ["vec_id"], [10.0, 50.0, 90.0]), ["p10", "p50", "p90"], 8)


@query(f"with {PX} select plate, y, x, round(median(v), 8) as v from px group by plate, y, x")
def project_by_function(t: Tables) -> DataFrame:
    """A projection by the caller's own aggregate."""
    return rounded(pixels.projected(images(t), ["plate"], F.median), ["v"], 8)


@query("select s_suppkey, s_nationkey from supplier")
def required_plates(t: Tables) -> DataFrame:
    """Rows behind the guard that raises where a plate is missing."""
    return filters.required(t.supplier, "s_nationkey").select("s_suppkey", "s_nationkey")


@query(f"""with {QUAD}, c as (select vec_id, label, cast(round_even(avg(y), 0) as integer) as cy, cast(round_even(avg(x), 0) as integer) as cx from q where label > 0 group by 1, 2), k as (select q.vec_id, q.label, y - cy + 2 as y, x - cx + 2 as x, v from q join c on q.vec_id = c.vec_id and q.label = c.label where y - cy + 2 between 0 and 3 and x - cx + 2 between 0 and 3),
e as (select vec_id, label, y * 2 + a as y, x * 2 + b as x, v from k cross join (select unnest([0, 1]) as a) cross join (select unnest([0, 1]) as b)) select vec_id, label, count(*) as filled, round(sum(v), 7) as total, round(max(v), 8) as most, cast(min(y) as integer) as y0, cast(max(x) as integer) as x1 from e group by 1, 2""")
def enlarged_crops(t: Tables) -> DataFrame:
    """Crops around objects, other objects left out, enlarged by nearest neighbours; a row of their measures each."""
    c = pixels.enlarged(morphology.crops(quadrants(images(t)), ["vec_id"], 4), 2)
    m = c.groupBy("vec_id", "label").agg(F.count(F.lit(1)).alias("filled"), F.sum("v").alias("total"), F.max("v").alias("most"), F.min("y").cast("int").alias("y0"), F.max("x").cast("int").alias("x1"))
    return rounded(rounded(m, ["total"], 7), ["most"], 8)
