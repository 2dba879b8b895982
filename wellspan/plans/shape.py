"""Queries of object shapes, each held to SQL over all pairs and triples of an object's pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import shapes
from ..registry import Tables, query
from .imaging import QUAD, images, quadrants, rounded

KEY = ["vec_id"]
SAME = "using (vec_id, label)"


def _edges(name: str, points: str) -> str:
    """Pairs of points that have all others on one side, with the distance of the farthest."""
    turn = "(b.y - a.y) * (c.x - a.x) - (b.x - a.x) * (c.y - a.y)"
    return f"""{name} as (select vec_id, label, a.y as ay, a.x as ax, b.y as bye, b.x as bx, max({turn}) / sqrt(pow(a.y - b.y, 2) + pow(a.x - b.x, 2)) as width, sqrt(pow(a.y - b.y, 2) + pow(a.x - b.x, 2)) as gap
 from {points} a join {points} b {SAME} join {points} c {SAME} where a.y <> b.y or a.x <> b.x group by vec_id, label, a.y, a.x, b.y, b.x having min({turn}) >= 0)"""


OBJECTS = "pt as (select vec_id, label, y, x, v from q where label > 0)"
SIZES = "z as (select vec_id, label, count(*) as area from pt group by 1, 2)"


@query(f"""with {QUAD}, {OBJECTS}, {SIZES}, {_edges("e", "pt")}, n as (select vec_id, label, y, min(x) as lo, max(x) as hi from pt group by 1, 2, 3),
w as (select distinct vec_id, label, y * 2 + dy as y, x as x from (select vec_id, label, y, unnest([2 * lo - 1, 2 * hi + 1]) as x, 0 as dy from n union all select vec_id, label, y, unnest([2 * lo, 2 * hi, 2 * lo, 2 * hi]), unnest([-1, -1, 1, 1]) from n)), {_edges("f", "w")},
g as (select vec_id, label, y, x from z cross join (select unnest(range(8)) as y) cross join (select unnest(range(8)) as x)),
c as (select g.vec_id, g.label, g.y, g.x from g join f on g.vec_id = f.vec_id and g.label = f.label group by 1, 2, 3, 4 having min((bye - ay) * (2 * g.x - ax) - (bx - ax) * (2 * g.y - ay)) >= 0), k as (select vec_id, label, count(*) as convex_area from c group by 1, 2),
d as (select vec_id, label, max(sqrt(pow(a.y - b.y, 2) + pow(a.x - b.x, 2))) as far from pt a join pt b {SAME} group by 1, 2), m as (select vec_id, label, min(width) as narrow from e group by 1, 2)
select vec_id, label, area, convex_area, round(area / convex_area, 6) as solidity, round(far, 6) as max_feret, round(coalesce(narrow, 0), 6) as min_feret from z join k {SAME} join d {SAME} left join m {SAME}""")
def hull_measures(t: Tables) -> DataFrame:
    """Solidity, convex area and Feret diameters."""
    m = shapes.hull_measures(quadrants(images(t)), KEY).drop("corners")
    return rounded(m, ["solidity", "max_feret", "min_feret"])


@query(f"""with {QUAD}, {OBJECTS}, g as (select y, x from (select unnest(range(-1, 9)) as y) cross join (select unnest(range(-1, 9)) as x)),
i as (select o.* from (select distinct p.vec_id, p.label, g.y, g.x from pt p cross join g) o anti join pt on pt.vec_id = o.vec_id and pt.label = o.label and pt.y = o.y and pt.x = o.x), d as (select pt.vec_id, pt.label, pt.y, pt.x, sqrt(min(pow(pt.y - i.y, 2) + pow(pt.x - i.x, 2))) as d from pt join i on pt.vec_id = i.vec_id and pt.label = i.label group by 1, 2, 3, 4)
select vec_id, label, round(max(d), 6) as max_radius, round(avg(d), 6) as mean_radius, round(median(d), 6) as median_radius from d group by 1, 2""")
def object_radii(t: Tables) -> DataFrame:
    return rounded(shapes.radii(quadrants(images(t)), KEY), ["max_radius", "mean_radius", "median_radius"])


CIRCLES = f"""{_edges("e", "pt")}, h as (select distinct vec_id, label, ay as y, ax as x from e),
t3 as (select vec_id, label, a.y as y0, a.x as x0, b.y - a.y as y1, b.x - a.x as x1, c.y - a.y as y2, c.x - a.x as x2 from h a join h b {SAME} join h c {SAME} where (a.y, a.x) < (b.y, b.x) and (b.y, b.x) < (c.y, c.x)),
cand as (select vec_id, label, (a.y + b.y) / 2 as cy, (a.x + b.x) / 2 as cx, sqrt(pow(a.y - b.y, 2) + pow(a.x - b.x, 2)) / 2 as r from h a join h b {SAME} where (a.y, a.x) < (b.y, b.x)
 union all select vec_id, label, y0 + uy, x0 + ux, sqrt(uy * uy + ux * ux) from (select *, (x1 * (y2 * y2 + x2 * x2) - x2 * (y1 * y1 + x1 * x1)) / (2.0 * (x1 * y2 - y1 * x2)) as uy, (y2 * (y1 * y1 + x1 * x1) - y1 * (y2 * y2 + x2 * x2)) / (2.0 * (x1 * y2 - y1 * x2)) as ux from t3 where x1 * y2 <> y1 * x2)),
good as (select k.* from cand k join h on h.vec_id = k.vec_id and h.label = k.label group by k.vec_id, k.label, cy, cx, r having max(sqrt(pow(h.y - cy, 2) + pow(h.x - cx, 2)) - r) <= 1e-9),
circle as (select vec_id, label, cy, cx, r from (select *, row_number() over (partition by vec_id, label order by round(r, 9), cy, cx) as k from good) where k = 1)"""


@query(f"with {QUAD}, {OBJECTS}, {CIRCLES} select vec_id, label, round(cy, 5) as circle_y, round(cx, 5) as circle_x, round(r, 6) as circle_r from circle")
def enclosing_circle(t: Tables) -> DataFrame:
    c = shapes.enclosing_circles(quadrants(images(t)), KEY).where("circle_r > 0")
    return rounded(rounded(c, ["circle_y", "circle_x"], 5), ["circle_r"])


MOST = 5


def _zernike_sql(weighted: bool) -> str:
    degrees, v = shapes.degrees(MOST), "v" if weighted else "1"

    def total(n: int, m: int, f: str) -> str:
        radial = " + ".join(f"({c}) * pow(rho, {m + 2 * j})" for j, c in enumerate(shapes._polynomial(n, m)))
        return f"sum({v} * ({radial}) * {f}({m} * phi))"

    sums = ", ".join(f"{total(n, m, 'cos')} as re_{n}_{m}, {total(n, m, 'sin')} as im_{n}_{m}" for n, m in degrees)
    scale = "n" if weighted else "(pi() * r * r)"
    size = {(n, m): f"sqrt(re_{n}_{m} * re_{n}_{m} + im_{n}_{m} * im_{n}_{m})" for n, m in degrees}
    shown = [f"round({size[n, m]} / {scale}, 6) + 0.0 as magnitude_{n}_{m}" for n, m in degrees]
    if weighted:
        shown += [f"case when {size[n, m]} / {scale} > 1e-6 then round(re_{n}_{m} / {size[n, m]}, 4) + 0.0 end as phase_sin_{n}_{m}, case when {size[n, m]} / {scale} > 1e-6 then round(im_{n}_{m} / {size[n, m]}, 4) + 0.0 end as phase_cos_{n}_{m}" for n, m in degrees]
    return f"""with {QUAD}, {OBJECTS}, {CIRCLES}, p as (select vec_id, label, v, r, sqrt(pow(y - cy, 2) + pow(x - cx, 2)) / r as rho, atan2(x - cx, y - cy) as phi from pt join circle {SAME}),
s as (select vec_id, label, any_value(r) as r, count(*) as n, {sums} from p where rho * rho <= 1.000000001 group by 1, 2) select vec_id, label, {", ".join(shown)} from s"""


@query(_zernike_sql(False))
def zernike_shape(t: Tables) -> DataFrame:
    z = shapes.zernike(quadrants(images(t)), KEY, MOST)
    return z.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in z.columns if c.startswith("magnitude")})


@query(_zernike_sql(True))
def zernike_intensity(t: Tables) -> DataFrame:
    """Magnitudes and phases of intensities; phases as sine and cosine, where there is a magnitude."""
    z = shapes.zernike(quadrants(images(t)), KEY, MOST, weighted=True)
    parts = {}
    for n, m in shapes.degrees(MOST):
        size, phase = F.col(f"magnitude_{n}_{m}"), F.col(f"phase_{n}_{m}")
        parts |= {f"magnitude_{n}_{m}": F.round(size, 6) + F.lit(0.0), f"phase_sin_{n}_{m}": F.when(size > 1e-6, F.round(F.sin(phase), 4) + F.lit(0.0)), f"phase_cos_{n}_{m}": F.when(size > 1e-6, F.round(F.cos(phase), 4) + F.lit(0.0))}
    return z.select("vec_id", "label", *(c.alias(n) for n, c in parts.items()))
