"""Shapes of objects: convex hulls, Feret diameters, radii, enclosing circles and Zernike moments.

An object's hull needs two pixels a row only, so pixels are combined map-side into row ends
and these into one array an object, no longer than twice its height.  Moments read pixels once
more, beside their object's circle, and are sums.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Point = tuple[float, float]


def row_ends(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, label, ends, area): first and last pixel of every row of each object, in order of y."""
    rows = pixels.where("label > 0").groupBy(*key, "label", F.col("y").cast("int").alias("y")).agg(F.min("x").cast("int").alias("low"), F.max("x").cast("int").alias("high"), F.count(F.lit(1)).alias("n_"))
    return rows.groupBy(*key, "label").agg(F.array_sort(F.collect_list(F.struct("y", "low", "high"))).alias("ends"), F.sum("n_").alias("area"))


def _turn(a: Column, b: Column, c: Column) -> Column:
    """Twice the signed area of three points (y, x)."""
    return (b["y"] - a["y"]) * (c["x"] - a["x"]) - (b["x"] - a["x"]) * (c["y"] - a["y"])


def _chain(points: Column, left: bool) -> Column:
    """The convex chain on one side of ``points``, which come in order of y with one x each.

    A fold keeps the chain of the points so far.  Seen from the next point its turns change
    their sign once, so what stays is as many points as there are turns of the right sign.
    """
    def step(chain: Column, p: Column) -> Column:
        turns = F.filter(F.sequence(F.lit(1), F.greatest(F.size(chain) - 1, F.lit(1))), lambda i: _bent(F.get(chain, i - 1), F.get(chain, i), p, left))
        stay = F.when(F.size(chain) > 1, F.size(turns) + 1).otherwise(F.size(chain))
        return F.concat(F.slice(chain, F.lit(1), stay), F.array(p))

    return F.aggregate(points, F.slice(points, 1, 0), step)


def _bent(a: Column, b: Column, c: Column, left: bool) -> Column:
    return (_turn(a, b, c) > 0) if left else (_turn(a, b, c) < 0)


def _side(ends: Column, which: str) -> Column:
    return F.transform(ends, lambda e: F.struct(e["y"].cast("long").alias("y"), e[which].cast("long").alias("x")))


def _widened(chain: Column, left: bool) -> Column:
    """Corners moved out by half a pixel each way, in half pixels: one point a half row."""
    out, pick, n = (-1, F.least, F.size(chain)) if left else (1, F.greatest, F.size(chain))

    def three(e: Column, i: Column) -> Column:
        y, x = e["y"] * 2, e["x"] * 2
        near = lambda other: F.when(F.abs(other["y"] - e["y"]) == 1, pick(x, other["x"] * 2)).otherwise(x)
        point = lambda a, b: F.struct(a.alias("y"), b.alias("x"))
        first = F.when(i > 0, near(F.get(chain, i - 1))).otherwise(x)
        last = F.when(i < n - 1, near(F.get(chain, i + 1))).otherwise(x)
        return F.array(point(y - 1, first), point(y, x + out), point(y + 1, last))

    return F.flatten(F.transform(chain, three))


def _one_each(points: Column) -> Column:
    """Neighbouring rows both have a point between them, and it is the same one."""
    return F.filter(points, lambda p, i: (i == 0) | (F.get(points, i - 1)["y"] < p["y"]))


def hulls(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, label, area, ends, left, right, hull): convex hulls of pixel centres.

    ``left`` and ``right`` are the hull's chains in order of y, ``hull`` its corners around.
    """
    found = row_ends(pixels, key).withColumns({"left": _side(F.col("ends"), "low"), "right": _side(F.col("ends"), "high")})
    found = found.withColumns({"left": _chain(F.col("left"), True), "right": _chain(F.col("right"), False)})
    return found.withColumn("hull", F.array_distinct(F.concat("left", F.reverse("right"))))


def _edge_sums(chain: Column, left: bool) -> Column:
    """The first (last) pixels inside a chain of half pixels, summed over the rows that it spans."""

    def rows(i: Column) -> Column:
        a, b = F.get(chain, i - 1), F.get(chain, i)
        low, high = F.floor(a["y"] / 2) + 1, F.floor(b["y"] / 2)

        def inside(y: Column) -> Column:
            x = (a["x"] * (b["y"] - a["y"]) + (b["x"] - a["x"]) * (y * 2 - a["y"])).cast("double") / ((b["y"] - a["y"]) * 2)
            return F.ceil(x) if left else F.floor(x)

        return F.when(low <= high, F.aggregate(F.sequence(low, F.greatest(low, high)), F.lit(0).cast("long"), lambda s, y: s + inside(y))).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.size(chain) - 1), rows), F.lit(0).cast("long"), lambda s, r: s + r)


def hull_measures(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, label, area, convex_area, solidity, max_feret, min_feret, corners).

    The convex area counts the pixels whose centres lie in, or on, the hull of the object's
    pixels moved out by half a pixel up, down, left and right (the corners alone make the
    same hull); solidity is the area over it.
    The Feret diameters are the largest distance between hull corners and the smallest width
    between parallel lines, one of which lies on an edge of the hull; 0 for a single pixel.
    All coordinates are whole numbers until the last division.
    """
    h = hulls(pixels, key)
    # Each step is a column of its own: inside a lambda an expression is computed anew every time.
    for name, left in (("wide_left", True), ("wide_right", False)):
        h = h.withColumn(name, _widened(F.col("left" if left else "right"), left)).withColumn(name, _one_each(F.col(name))).withColumn(name, _chain(F.col(name), left))
    n_rows = F.element_at("ends", -1)["y"] - F.col("ends")[0]["y"] + 1
    hull, n = F.col("hull"), F.size("hull")
    square = lambda a, b: (a["y"] - b["y"]) * (a["y"] - b["y"]) + (a["x"] - b["x"]) * (a["x"] - b["x"])
    longest = F.sqrt(F.array_max(F.transform(hull, lambda a: F.array_max(F.transform(hull, lambda b: square(a, b))))).cast("double"))

    def width(a: Column, i: Column) -> Column:
        b = F.get(hull, (i + 1) % n)
        return F.array_max(F.transform(hull, lambda c: F.abs(_turn(a, b, c)))) / F.sqrt(square(a, b).cast("double"))

    narrow = F.when(n > 2, F.array_min(F.transform(hull, width))).otherwise(0.0)
    h = h.withColumn("convex_area", _edge_sums(F.col("wide_right"), False) - _edge_sums(F.col("wide_left"), True) + n_rows)
    return h.select(*key, "label", "area", "convex_area", (F.col("area") / F.col("convex_area")).alias("solidity"), longest.alias("max_feret"), narrow.alias("min_feret"), n.alias("corners"))


def _row_distances(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Squared distance to the nearest pixel outside, along each row of an object, from distances along columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, line = [], b["line_"]
            stops = line.offsets.to_numpy()
            xs, gs = (line.values.field(c).to_numpy() for c in (0, 1))
            for start, stop in zip(stops, stops[1:]):
                # The places on both sides of a run are outside and at distance 0.
                x, g = xs[start:stop], gs[start:stop]
                gap = np.flatnonzero(np.diff(x) > 1)
                seen = np.concatenate([x, x[:1] - 1, x[-1:] + 1, x[gap] + 1, x[gap + 1] - 1])
                height = np.concatenate([g * g, np.zeros(2 + 2 * len(gap), np.int64)])
                best = np.empty(len(x), np.int64)
                for k in range(0, len(x), 512):
                    best[k : k + 512] = ((x[k : k + 512, None] - seen) ** 2 + height).min(axis=1)
                out.append(best)
            if out:
                at = pa.array(np.repeat(np.arange(b.num_rows), np.diff(stops)))
                yield pa.record_batch([*(b[c].take(at) for c in names), pa.array(np.concatenate(out))], names=[*names, "d2"])

    return run


def radii(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, label, max_radius, mean_radius, median_radius): distances of an object's pixels to its outside.

    Exact Euclidean distances in two passes: along columns by the ends of each run, then along
    rows by the nearest of their sums.  The outside of the image is outside of the object.
    """
    inside = pixels.where("label > 0").select(*key, "label", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"))
    down = Window.partitionBy(*key, "label", "x")
    runs = inside.withColumn("run_", F.col("y") - F.row_number().over(down.orderBy("y")))
    whole = Window.partitionBy(*key, "label", "x", "run_")
    g = F.least(F.col("y") - F.min("y").over(whole), F.max("y").over(whole) - F.col("y")) + 1
    lines = runs.withColumn("g", g).groupBy(*key, "label", "y").agg(F.array_sort(F.collect_list(F.struct("x", "g"))).alias("line_"))
    kinds = ", ".join(f"`{c}` {inside.schema[c].dataType.simpleString()}" for c in (*key, "label"))
    d = F.sqrt(F.col("d2").cast("double"))
    far = lines.mapInArrow(_row_distances([*key, "label"]), f"{kinds}, d2 long")
    return far.groupBy(*key, "label").agg(F.max(d).alias("max_radius"), F.avg(d).alias("mean_radius"), F.percentile(d, 0.5).alias("median_radius"))


def smallest_circle(points: list[Point]) -> tuple[float, float, float]:
    """Centre (y, x) and radius of the smallest circle around ``points``.

    Points come one by one; one outside of the circle so far lies on the new one, and so the
    circle is found again from those before it, with that point fixed.
    """

    def through(fixed: list[Point]) -> tuple[float, float, float]:
        if not fixed:
            return 0.0, 0.0, -1.0
        if len(fixed) == 1:
            return *fixed[0], 0.0
        if len(fixed) == 2:
            (ay, ax), (by, bx) = fixed
            return (ay + by) / 2, (ax + bx) / 2, math.hypot(ay - by, ax - bx) / 2
        (ay, ax), (by, bx), (cy, cx) = fixed
        by, bx, cy, cx = by - ay, bx - ax, cy - ay, cx - ax
        d = 2 * (bx * cy - by * cx)
        b, c = bx * bx + by * by, cx * cx + cy * cy
        uy, ux = (bx * c - cx * b) / d, (cy * b - by * c) / d
        return ay + uy, ax + ux, math.hypot(uy, ux)

    def holds(circle: tuple[float, float, float], p: Point) -> bool:
        return math.hypot(p[0] - circle[0], p[1] - circle[1]) <= circle[2] * (1 + 1e-12) + 1e-12

    def around(some: list[Point], fixed: list[Point]) -> tuple[float, float, float]:
        circle = through(fixed)
        if len(fixed) < 3:
            for i, p in enumerate(some):
                if not holds(circle, p):
                    circle = around(some[:i], [*fixed, p])
        return circle

    return around(points, [])


def _circles(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [smallest_circle([(float(p["y"]), float(p["x"])) for p in hull]) for hull in b["hull"].to_pylist()]
            columns = [pa.array([c[k] for c in found], pa.float64()) for k in range(3)]
            yield pa.record_batch([*(b[c] for c in names), *columns], names=[*names, "circle_y", "circle_x", "circle_r"])

    return run


def enclosing_circles(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, label, circle_y, circle_x, circle_r): the smallest circle around each object's pixel centres."""
    names = [*key, "label"]
    kinds = ", ".join(f"`{c}` {pixels.schema[c].dataType.simpleString()}" for c in names)
    return hulls(pixels, key).select(*names, "hull").mapInArrow(_circles(names), f"{kinds}, circle_y double, circle_x double, circle_r double")


def degrees(most: int) -> list[tuple[int, int]]:
    """Degrees n up to ``most`` with the repetitions m of the same parity."""
    return [(n, m) for n in range(most + 1) for m in range(n % 2, n + 1, 2)]


def _polynomial(n: int, m: int) -> list[float]:
    """Coefficients of the radial polynomial over r**m: of 1, r**2, r**4 and so on."""
    f = math.factorial
    terms = {n - 2 * k: (-1) ** k * f(n - k) / (f(k) * f((n + m) // 2 - k) * f((n - m) // 2 - k)) for k in range((n - m) // 2 + 1)}
    return [terms.get(m + 2 * j, 0.0) for j in range((n - m) // 2 + 1)]


def zernike(pixels: DataFrame, key: list[str], most: int = 9, weighted: bool = False) -> DataFrame:
    """(key, label, magnitude_n_m..., phase_n_m...): Zernike moments in each object's smallest circle.

    Coordinates are those of the unit disk; angles start at the y axis.  Of a shape (not
    ``weighted``) a magnitude is that of the polynomials' sum over the circle's area; of
    intensities it is that of their sum times ``v`` over the object's number of pixels, and
    the phase is the angle of (real part, imaginary part) as atan2 takes them.  An object of a
    single pixel has no circle and no moments.  Polynomials are built from running powers, in
    one aggregate over the pixels; circles are joined by object, pixels are not shuffled for
    anything else.
    """
    circle = enclosing_circles(pixels, key).where("circle_r > 0")
    p = pixels.where("label > 0").join(circle, [*key, "label"])
    u, w = (F.col("y") - F.col("circle_y")) / F.col("circle_r"), (F.col("x") - F.col("circle_x")) / F.col("circle_r")
    # The circle's own points are inside, whatever rounding makes of them.
    p = p.withColumns({"u_": u, "w_": w}).withColumn("s_", F.col("u_") * F.col("u_") + F.col("w_") * F.col("w_")).where("s_ <= 1.000000001")
    powers: dict[str, Column] = {"re_0": F.lit(1.0), "im_0": F.lit(0.0)}
    for m in range(1, most + 1):
        re, im = (F.lit(1.0), F.lit(0.0)) if m == 1 else (F.col(f"re_{m - 1}"), F.col(f"im_{m - 1}"))
        p = p.withColumns({f"re_{m}": re * F.col("u_") - im * F.col("w_"), f"im_{m}": re * F.col("w_") + im * F.col("u_")})
    value = F.col("v").cast("double") if weighted else F.lit(1.0)

    def radial(n: int, m: int) -> Column:
        out = F.lit(0.0)
        for c in reversed(_polynomial(n, m)):
            out = out * F.col("s_") + F.lit(float(c))
        return out

    part = lambda kind, m: powers["re_0" if kind == "re" else "im_0"] if m == 0 else F.col(f"{kind}_{m}")
    sums = [F.sum(value * radial(n, m) * part(kind, m)).alias(f"{kind}_{n}_{m}_") for n, m in degrees(most) for kind in ("re", "im")]
    z = p.groupBy(*key, "label").agg(F.first("circle_r").alias("circle_r"), F.count(F.lit(1)).alias("n_"), *sums)
    scale = F.col("n_") if weighted else F.col("circle_r") * F.col("circle_r") * F.lit(math.pi)
    magnitude = lambda n, m: (F.hypot(F.col(f"re_{n}_{m}_"), F.col(f"im_{n}_{m}_")) / scale).alias(f"magnitude_{n}_{m}")
    phase = lambda n, m: F.atan2(F.col(f"re_{n}_{m}_"), F.col(f"im_{n}_{m}_")).alias(f"phase_{n}_{m}")
    return z.select(*key, "label", *(magnitude(n, m) for n, m in degrees(most)), *((phase(n, m) for n, m in degrees(most)) if weighted else ()))
