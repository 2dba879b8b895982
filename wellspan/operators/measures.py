"""Measurements of objects from pixel tables (key, y, x, label, v): one row per object.

Sums are combined map-side; only edges, textures and touching shares look at neighbouring
pixels, each through one shuffle by pixel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tiles import spread

FOUR = ((-1, 0), (1, 0), (0, -1), (0, 1))
EIGHT = (*FOUR, (-1, -1), (-1, 1), (1, -1), (1, 1))


def _steps(offsets: tuple[tuple[int, int], ...]) -> Column:
    return F.array(*(F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in offsets))


def with_neighbours(pixels: DataFrame, key: list[str], offsets: tuple[tuple[int, int], ...], value: str = "label") -> DataFrame:
    """Each pixel with ``around``: how many of its neighbours have the same ``value``.

    Pixels are sent to themselves and to their neighbours and counted there, in one shuffle.
    """
    keep = [c for c in pixels.columns if c not in (*key, "y", "x", value)]
    own = F.struct(*(F.col(c) for c in keep)) if keep else F.struct(F.lit(1).alias("one_"))
    sent = pixels.select(*key, "y", "x", value, own.alias("own_"), F.explode(_steps(((0, 0), *offsets))).alias("d"))
    here = (F.col("d.dy") == 0) & (F.col("d.dx") == 0)
    moved = sent.select(*key, (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x"), value, F.when(here, F.col("own_")).alias("own_"), F.when(here, 0).otherwise(1).alias("n_"))
    met = moved.groupBy(*key, "y", "x", value).agg(F.max("own_").alias("own_"), F.sum("n_").cast("int").alias("around"))
    return met.where("own_ is not null").select(*key, "y", "x", value, *(F.col(f"own_.{c}") for c in keep), "around")


def edges(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Object pixels with one of four neighbours outside the object or the image."""
    return with_neighbours(pixels.where("label > 0"), key, FOUR).where("around < 4").drop("around")


def intensity(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Integrated, mean, spread, range, quartiles, MAD, mass displacement and edge variants.

    Quartiles interpolate between ranks; the largest value's place is the first in reading
    order.  Objects are small, so their percentiles are taken in place.
    """
    inside = spread(pixels.where("label > 0").withColumn("v", F.col("v").cast("double")), [*key, "label"])
    v, y, x = F.col("v"), F.col("y"), F.col("x")
    first = inside.groupBy(*key, "label").agg(
        F.sum(v).alias("integrated"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.percentile(v, [0.25, 0.5, 0.75]).alias("q_"),
        F.avg(x).alias("center_x"), F.avg(y).alias("center_y"),
        (F.sum(v * x) / F.nullif(F.sum(v), F.lit(0.0))).alias("center_mass_x"), (F.sum(v * y) / F.nullif(F.sum(v), F.lit(0.0))).alias("center_mass_y"),
        F.max(F.struct(v, (-y).alias("y"), (-x).alias("x"))).alias("top_"),
    )
    off = inside.join(first.select(*key, "label", F.col("q_")[1].alias("middle_")), [*key, "label"])
    mad = off.groupBy(*key, "label").agg(F.percentile(F.abs(v - F.col("middle_")), 0.5).alias("mad"))
    rim = edges(inside, key).groupBy(*key, "label").agg(
        F.sum(v).alias("integrated_edge"), F.avg(v).alias("mean_edge"), F.stddev_pop(v).alias("std_edge"), F.min(v).alias("min_edge"), F.max(v).alias("max_edge")
    )
    shift = F.hypot(F.col("center_x") - F.col("center_mass_x"), F.col("center_y") - F.col("center_mass_y"))
    out = first.withColumns({"lower_quartile": F.col("q_")[0], "median": F.col("q_")[1], "upper_quartile": F.col("q_")[2], "mass_displacement": shift, "max_y": -F.col("top_.y"), "max_x": -F.col("top_.x")})
    return out.drop("q_", "top_").join(mad, [*key, "label"]).join(rim, [*key, "label"])


def moments(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Spatial, central and normalised moments, Hu moments, inertia tensor and what follows.

    ``m_p_q`` sums y**p x**q over the object, in the frame of its bounding box, for p, q up to
    3; ``mu`` and ``nu`` follow from these sums.  Pixels are dealt once, by object.
    """
    inside = spread(pixels.where("label > 0"), [*key, "label"])
    box = inside.groupBy(*key, "label").agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    p = inside.join(box, [*key, "label"])
    powers = lambda c: [F.lit(1.0), c, c * c, c * c * c]
    ys, xs = powers((F.col("y") - F.col("y0")).cast("double")), powers((F.col("x") - F.col("x0")).cast("double"))
    sums = [F.sum(ys[i] * xs[j]).alias(f"m_{i}_{j}") for i in range(4) for j in range(4)]
    m = p.groupBy(*key, "label", "y0", "y1", "x0", "x1").agg(*sums)
    raw = lambda i, j: F.col(f"m_{i}_{j}")
    n = raw(0, 0)
    cy, cx = raw(1, 0) / n, raw(0, 1) / n
    binomial = ((1,), (1, 1), (1, 2, 1), (1, 3, 3, 1))

    def power(c: Column, k: int) -> Column:
        out = F.lit(1.0)
        for _ in range(k):
            out = out * c
        return out

    def central(i: int, j: int) -> Column:
        out = F.lit(0.0)
        for a in range(i + 1):
            for b in range(j + 1):
                out += raw(a, b) * (binomial[i][a] * binomial[j][b] * (-1) ** (i - a + j - b)) * power(cy, i - a) * power(cx, j - b)
        return out

    m = m.withColumns({"area": n.cast("long"), "center_y": F.col("y0") + cy, "center_x": F.col("x0") + cx, "bbox_area": (F.col("y1") - F.col("y0") + 1) * (F.col("x1") - F.col("x0") + 1)} | {f"mu_{i}_{j}": central(i, j) for i in range(4) for j in range(4)})
    mu = lambda i, j: F.col(f"mu_{i}_{j}")
    nu = lambda i, j: mu(i, j) / F.pow(n, F.lit(1 + (i + j) / 2))
    m = m.withColumns({f"nu_{i}_{j}": nu(i, j) for i in range(4) for j in range(4) if i + j >= 2})
    a, b, c = mu(2, 0) / n, mu(0, 2) / n, mu(1, 1) / n
    m = m.withColumns({"inertia_0_0": b, "inertia_1_1": a, "inertia_0_1": -c, "extent": n / F.col("bbox_area")})
    h, root = (a + b) / 2, F.sqrt(F.pow((a - b) / 2, F.lit(2.0)) + c * c)
    m = m.withColumns({"eigenvalue_0": h + root, "eigenvalue_1": F.greatest(h - root, F.lit(0.0))})
    n20, n02, n11, n30, n03, n21, n12 = (F.col(f"nu_{k}") for k in ("2_0", "0_2", "1_1", "3_0", "0_3", "2_1", "1_2"))
    s, d, e, f = n30 + n12, n21 + n03, n30 - n12 * 3, n21 * 3 - n03
    hu = [
        n20 + n02,
        (n20 - n02) * (n20 - n02) + n11 * n11 * 4,
        e * e + f * f,
        s * s + d * d,
        e * s * (s * s - d * d * 3) + f * d * (s * s * 3 - d * d),
        (n20 - n02) * (s * s - d * d) + n11 * s * d * 4,
        f * s * (s * s - d * d * 3) - e * d * (s * s * 3 - d * d),
    ]
    return m.withColumns({f"hu_{i}": c for i, c in enumerate(hu)} | {"orientation": F.when(root > 1e-12, F.atan2(c * -2, b - a) * 0.5)})


def geometry(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Area, perimeter, form factor, compactness and Euler number of each object.

    The perimeter joins the centres of edge pixels: each adds 1, the root of 2 or their mean
    by how its neighbours on the edge stand.  The Euler number (eight neighbours) comes from
    the patterns of the 2 x 2 squares that the object touches.
    """
    inside = pixels.where("label > 0").select(*key, "y", "x", "label")
    area = inside.groupBy(*key, "label").agg(F.count(F.lit(1)).alias("area"))
    rim = edges(inside, key)
    straight = with_neighbours(rim, key, FOUR).withColumnRenamed("around", "straight")
    both = with_neighbours(straight, key, EIGHT[4:]).withColumnRenamed("around", "diagonal")
    root = 2.0**0.5
    code = F.lit(1) + F.col("straight") * 2 + F.col("diagonal") * 10
    step = F.when(code.isin(5, 7, 15, 17, 25, 27), 1.0).when(code.isin(21, 33), root).when(code.isin(13, 23), (1 + root) / 2).otherwise(0.0)
    around = both.groupBy(*key, "label").agg(F.sum(step).alias("perimeter"))
    corners = F.array(*(F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx"), F.lit(1 << (2 * a + b)).alias("bit")) for a in (0, 1) for b in (0, 1)))
    squares = inside.select("*", F.explode(corners).alias("c")).groupBy(*key, "label", (F.col("y") - F.col("c.dy")).alias("sy"), (F.col("x") - F.col("c.dx")).alias("sx")).agg(F.sum("c.bit").alias("bits"))
    bits = F.col("bits")
    quads = squares.groupBy(*key, "label").agg(((F.count(F.when(bits.isin(1, 2, 4, 8), 1)) - F.count(F.when(bits.isin(7, 11, 13, 14), 1)) - F.count(F.when(bits.isin(6, 9), 1)) * 2) / 4).cast("int").alias("euler"))
    out = area.join(around, [*key, "label"]).join(quads, [*key, "label"])
    around_, area_ = F.nullif("perimeter", F.lit(0.0)), F.col("area")
    return out.withColumns({"form_factor": area_ * (4 * 3.141592653589793) / (around_ * around_), "compactness": around_ * around_ / (area_ * (4 * 3.141592653589793))})


#: The thirteen texture measures.
TEXTURES = (
    "angular_second_moment", "contrast", "correlation", "variance", "inverse_difference_moment", "sum_average", "sum_variance",
    "sum_entropy", "entropy", "difference_variance", "difference_entropy", "info_meas1", "info_meas2",
)


def textures(pixels: DataFrame, key: list[str], levels: int, scales: list[int]) -> DataFrame:
    """(key, label, scale, direction, the thirteen measures): Haralick textures of objects.

    ``g`` (0 to levels - 1) is the grey level.  Directions 0 to 3 are 0, 45, 90 and 135
    degrees at each scale.  Co-occurrence is symmetric; entropies are in bits; the variance of
    differences is that of their distribution.  All offsets go through one join by pixel, and
    marginals are summed in one pass over the co-occurrence cells.
    """
    offsets = F.array(*(F.struct(F.lit(s).alias("scale"), F.lit(k).alias("direction"), F.lit(a * s).alias("dy"), F.lit(b * s).alias("dx")) for s in scales for k, (a, b) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1)))))
    inside = pixels.where("label > 0").select(*key, "label", "y", "x", "g")
    moved = inside.select(*key, "label", "y", "x", F.col("g").alias("i"), F.explode(offsets).alias("o")).select(*key, "label", "o.scale", "o.direction", (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), "i")
    pairs = moved.join(inside.withColumnRenamed("g", "j"), [*key, "label", "y", "x"])
    group = [*key, "label", "scale", "direction"]
    cells = pairs.groupBy(*group, "i", "j").agg(F.count(F.lit(1)).alias("n"))
    i, j, n = F.col("i"), F.col("j"), F.col("n")
    entry = lambda kind, at: F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("at"))
    tags = F.array(entry("p", i * levels + j), entry("p", j * levels + i), entry("x", i), entry("x", j), entry("s", i + j), entry("s", i + j), entry("d", F.abs(i - j)), entry("d", F.abs(i - j)))
    sums = cells.select(*group, "n", F.explode(tags).alias("t")).groupBy(*group, "t.kind", "t.at").agg(F.sum("n").alias("n"))
    total = cells.groupBy(*group).agg((F.sum("n") * 2).alias("total"))
    p = sums.join(total, group).withColumn("p", n / F.col("total"))
    q, at = F.col("p"), F.col("at")
    of = lambda kind, e: F.sum(F.when(F.col("kind") == kind, e))
    bits = q * F.log2(q)
    r, c = F.floor(at / levels), at % levels
    s = p.groupBy(*group).agg(
        of("p", q * q).alias("angular_second_moment"), of("d", q * at * at).alias("contrast"), of("p", q * r * c).alias("rc_"), of("x", q * at).alias("mean_"), of("x", q * at * at).alias("square_"),
        of("d", q / (at * at + 1)).alias("inverse_difference_moment"), of("s", q * at).alias("sum_average"), of("s", q * at * at).alias("sum_square_"), (-of("s", bits)).alias("sum_entropy"),
        (-of("p", bits)).alias("entropy"), of("d", q * at).alias("difference_"), (-of("d", bits)).alias("difference_entropy"), (-of("x", bits)).alias("hx_"),
    )
    s = s.withColumn("variance", F.col("square_") - F.col("mean_") * F.col("mean_"))
    gap = F.col("hx_") * 2 - F.col("entropy")  # both cross entropies are twice that of the margin
    return s.select(
        *group, "angular_second_moment", "contrast",
        F.when(F.col("variance") > 1e-12, (F.col("rc_") - F.col("mean_") * F.col("mean_")) / F.col("variance")).otherwise(1.0).alias("correlation"),
        "variance", "inverse_difference_moment", "sum_average", (F.col("sum_square_") - F.col("sum_average") * F.col("sum_average")).alias("sum_variance"), "sum_entropy", "entropy",
        (F.col("contrast") - F.col("difference_") * F.col("difference_")).alias("difference_variance"), "difference_entropy",
        F.when(F.col("hx_") > 1e-12, -gap / F.col("hx_")).otherwise(0.0).alias("info_meas1"),
        F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - F.exp(gap * -2))).alias("info_meas2"),
    )


def touching(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, label, neighbours, percent_touching): other objects that an object touches.

    Objects touch where pixels are among each other's eight neighbours; the share is that of
    the object's edge pixels which touch another object.
    """
    inside = pixels.where("label > 0").select(*key, "y", "x", "label")
    moved = inside.select(*key, F.col("label").alias("other"), "y", "x", F.explode(_steps(EIGHT)).alias("d")).select(*key, "other", (F.col("y") + F.col("d.dy")).alias("y"), (F.col("x") + F.col("d.dx")).alias("x"))
    met = moved.join(inside, [*key, "y", "x"]).where("label <> other")
    others = met.select(*key, "label", "other").distinct().groupBy(*key, "label").agg(F.count(F.lit(1)).alias("neighbours"))
    rim = edges(inside, key)
    near = met.select(*key, "y", "x", "label").distinct().withColumn("near_", F.lit(1))
    share = rim.join(near, [*key, "y", "x", "label"], "left").groupBy(*key, "label").agg((F.sum(F.coalesce("near_", F.lit(0))) / F.count(F.lit(1)) * 100).alias("percent_touching"))
    return share.join(others, [*key, "label"], "left").fillna(0, ["neighbours"])


def quality(pixels: DataFrame, key: list[str], tile: int) -> DataFrame:
    """Image quality: range, median, MAD, totals, focus scores of the image and of its tiles.

    The focus score is variance over mean; the local one is the median over tiles of
    ``tile`` x ``tile`` pixels of each tile's score, over tiles with a positive mean.
    """
    v = F.col("v")
    first = pixels.groupBy(*key).agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.percentile(v, 0.5).alias("median"), F.stddev_pop(v).alias("std"), F.sum(v).alias("total_intensity"), F.count(F.lit(1)).alias("total_area"), F.var_pop(v).alias("var_"))
    more = pixels.join(first.select(*key, "median", "min", "max"), key)
    share = lambda c: F.sum(F.when(v == F.col(c), 1).otherwise(0)) / F.count(F.lit(1)) * 100
    second = more.groupBy(*key).agg(F.percentile(F.abs(v - F.col("median")), 0.5).alias("mad"), share("min").alias("percent_minimal"), share("max").alias("percent_maximal"))
    parts = pixels.groupBy(*key, F.floor(F.col("y") / tile).alias("ty"), F.floor(F.col("x") / tile).alias("tx")).agg(F.avg(v).alias("m"), F.var_pop(v).alias("s"))
    local = parts.where("m > 0").groupBy(*key).agg(F.percentile(F.col("s") / F.col("m"), 0.5).alias("local_focus_score"))
    out = first.join(second, key).join(local, key, "left")
    return out.withColumn("focus_score", F.when(F.col("mean") > 0, F.col("var_") / F.col("mean"))).drop("var_")
