"""Queries of operators along image axes and of shapes, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alignment, lines, morphology, pixels
from ..registry import Tables, query
from .imaging import PX, images, rounded

KEY = ["vec_id"]
SIDE = 8


def plain(t: Tables) -> DataFrame:
    return images(t).select("vec_id", "y", "x", "v")


@query(f"""with {PX}, k as (select unnest(range(8)) as k), w as (select a.k, b.k as i, cos(2 * pi() * a.k * b.k / 8) as c, -sin(2 * pi() * a.k * b.k / 8) as s from k a cross join k b),
r as (select vec_id, y, k as kx, sum(v * c) as re, sum(v * s) as im from px join w on w.i = px.x group by 1, 2, 3), f as (select vec_id, k as ky, kx, sum(re * c - im * s) as re, sum(re * s + im * c) as im from r join w on w.i = r.y group by 1, 2, 3),
g as (select vec_id, floor(sqrt(pow(least(ky, 7 - ky), 2) + pow(least(kx, 7 - kx), 2))) + 1 as ring, sum(re * re + im * im) as p from f group by 1, 2)
select vec_id, round(regr_slope(ln(p), ln(ring)), 6) as power_slope from g where ring >= 2 and ring < 8 group by 1""")
def power_slope(t: Tables) -> DataFrame:
    """Images are tiny here, so all rings of the spectrum but the innermost are fitted."""
    return rounded(lines.power_slope(plain(t), KEY, 1.0), ["power_slope"])


@query(f"""with {PX}, k as (select unnest(range(8)) as k), w as (select a.k, b.k as i, cos(2 * pi() * a.k * b.k / 8) as c, -sin(2 * pi() * a.k * b.k / 8) as s from k a cross join k b),
r as (select vec_id, y, k as kx, sum(v * c) as re, sum(v * s) as im from px join w on w.i = px.x group by 1, 2, 3) select vec_id, cast(k as integer) as y, cast(kx as integer) as x, round(sum(re * c - im * s), 6) + 0.0 as re, round(sum(re * s + im * c), 6) + 0.0 as im from r join w on w.i = r.y group by 1, 2, 3""")
def fourier_spectrum(t: Tables) -> DataFrame:
    s = lines.spectrum(plain(t), KEY)
    return s.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("re", "im")})


def _sauvola(width: int) -> str:
    r, n = width // 2, f"w{width}"
    place = "((i + d) % 14 + 14) % 14"
    return f"""{n} as (select i, d, case when {place} > 7 then 14 - {place} else {place} end as j from (select unnest(range(8)) as i) cross join (select unnest(range(-{r}, {r + 1})) as d)),
x{n} as (select vec_id, y, i as x, avg(v) as m, avg(v * v) as q from px join {n} on j = x group by 1, 2, 3), y{n} as (select vec_id, i as y, x, avg(m) as m, avg(q) as q from x{n} join {n} on j = y group by 1, 2, 3),
t{n} as (select vec_id, y, x, {width} as width, m * (1 + 0.2 * (sqrt(greatest(q - m * m, 0)) - 1)) as threshold from y{n})"""


@query(f"with {PX}, {_sauvola(3)}, {_sauvola(51)} select vec_id, cast(y as integer) as y, cast(x as integer) as x, width, round(threshold, 7) + 0.0 as threshold from (select * from tw3 union all select * from tw51)")
def local_threshold(t: Tables) -> DataFrame:
    """Local thresholds in windows of 3 and of 51 pixels."""
    made = [lines.local_threshold(plain(t), KEY, w).select("vec_id", "y", "x", F.lit(w).alias("width"), "threshold") for w in (3, 51)]
    return rounded(made[0].unionByName(made[1]), ["threshold"], 7).withColumn("threshold", F.col("threshold") + F.lit(0.0))


@query(f"""with {PX}, m as (select plate, y, x, avg(v) as v from px group by 1, 2, 3), w as (select a.i, b.i as j, exp(-0.5 * pow((a.i - b.i) / 500.0, 2)) as w from (select unnest(range(8)) as i) a cross join (select unnest(range(8)) as i) b),
r as (select plate, y, i as x, sum(v * w) / sum(w) as v from m join w on j = x group by 1, 2, 3), b as (select plate, i as y, x, sum(v * w) / sum(w) as v from r join w on j = y group by 1, 2, 3)
select plate, cast(y as integer) as y, cast(x as integer) as x, round(v, 8) as v from b""")
def mean_field_wide(t: Tables) -> DataFrame:
    """Mean images blurred by 500 pixels, as flat fields of large optics are."""
    return rounded(lines.blurred(pixels.projected(images(t), ["plate"], "mean"), ["plate"], 500.0), ["v"], 8)


@query(f"""with {PX}, h as (select a.vec_id, a.y, a.x, max(b.v) as v from px a join px b on a.vec_id = b.vec_id and pow(a.y - b.y, 2) + pow(a.x - b.x, 2) <= 9 group by 1, 2, 3)
select a.vec_id, a.y, a.x, round(min(b.v), 8) as v from h a join h b on a.vec_id = b.vec_id and pow(a.y - b.y, 2) + pow(a.x - b.x, 2) <= 9 group by 1, 2, 3""")
def closing_wide_disk(t: Tables) -> DataFrame:
    """Closing with a disk of radius 3, by running extremes of the disk's rows."""
    high = lines.extreme_in_disk(plain(t), KEY, 3, True)
    return rounded(lines.extreme_in_disk(high, KEY, 3, False), ["v"], 8)


MOVED = f"{PX}, pair as (select p.vec_id, p.y, p.x, p.v as a, p.v > -0.2 as ma, coalesce(q.v, 0) as b, coalesce(q.v > -0.2, false) as mb from px p left join px q on q.vec_id = p.vec_id and q.y = p.y - 1 and q.x = p.x - 2)"


@query(f"""with {MOVED}, s as (select unnest(range(-7, 8)) as s), c as (select p.vec_id, i.s as dy, j.s as dx, count(*) as n, corr(p.a, q.b) as r from pair p cross join s i cross join s j join pair q on q.vec_id = p.vec_id and q.y = p.y - i.s and q.x = p.x - j.s and p.ma and q.mb group by 1, 2, 3),
k as (select *, max(n) over (partition by vec_id) as most from c), g as (select *, round(r, 9) as rr from k where n >= 0.3 * most and n >= 2 and not isnan(r)), t as (select *, max(rr) over (partition by vec_id) as top from g)
select vec_id, avg(dy) as dy, avg(dx) as dx, round(any_value(rr), 5) as r from t where rr = top group by 1""")
def masked_registration(t: Tables) -> DataFrame:
    """The shift that brings back an image moved by a row and two columns, from masked pixels only."""
    p = plain(t)
    there = p.select("vec_id", (F.col("y") + 1).alias("y"), (F.col("x") + 2).alias("x"), F.col("v").alias("b"))
    on = lambda c: F.coalesce(F.when(F.col(c) > -0.2, 1.0), F.lit(0.0))
    pair = p.withColumnRenamed("v", "a").join(there, ["vec_id", "y", "x"], "left").withColumns({"ma": on("a"), "mb": on("b")})
    return rounded(alignment.masked_shift(pair, KEY, morphology.kept), ["r"], 5)


@query(f"""with {PX}, s as (select vec_id, y, x, cast(round_even(0.8 * x - 0.6 * y + 3.13, 0) as integer) as sx, cast(round_even(0.6 * x + 0.8 * y - 1.73, 0) as integer) as sy from px) select s.vec_id, s.y, s.x, coalesce(p.v, 0) as v from s left join px p on p.vec_id = s.vec_id and p.y = sy and p.x = sx""")
def affine_warp(t: Tables) -> DataFrame:
    """Images turned by the angle of a 3-4-5 triangle and moved, nearest pixels."""
    matrix = F.array(*(F.lit(c) for c in (0.8, -0.6, 3.13, 0.6, 0.8, -1.73, 0.0, 0.0, 1.0)))
    return alignment.warped(plain(t), t.embeddings.select("vec_id", matrix.alias("matrix")), KEY)
