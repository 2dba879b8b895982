"""Pixel tables: one row (image key, y, x, v) per pixel, and what images are made of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tiles import spread


def exploded(images: DataFrame, pixels: str, width: int) -> DataFrame:
    """Rows of ``pixels`` arrays as (…, y, x, v), in row-major order."""
    keep = [c for c in images.columns if c != pixels]
    flat = images.select(*keep, F.posexplode(pixels).alias("at", "v"))
    return flat.select(*keep, F.floor(F.col("at") / width).cast("int").alias("y"), (F.col("at") % width).alias("x"), F.col("v").cast("double").alias("v"))


def assembled(pixels: DataFrame, key: list[str], value: str = "v") -> DataFrame:
    """The inverse of ``exploded``."""
    cells = F.array_sort(F.collect_list(F.struct("y", "x", F.col(value).alias("v"))))
    return pixels.groupBy(*key).agg(F.transform(cells, lambda c: c["v"]).alias("pixels"))


def projected(pixels: DataFrame, key: list[str], how: str | Callable[[Column], Column] = "max") -> DataFrame:
    """Largest or mean value, or a caller's own aggregate, per (key, y, x) over planes or images."""
    if callable(how):
        value = how(F.col("v"))
    else:
        value = F.max("v") if how == "max" else F.avg(F.when(~F.isnan("v"), F.col("v")))
    return pixels.groupBy(*key, "y", "x").agg(value.alias("v"))


def block_mean(pixels: DataFrame, key: list[str], factor: int) -> DataFrame:
    """Mean over blocks of factor x factor; blocks at the edge count missing pixels as 0."""
    small = pixels.groupBy(*key, F.floor(F.col("y") / factor).cast("int").alias("by"), F.floor(F.col("x") / factor).cast("int").alias("bx"))
    return small.agg((F.sum("v") / F.lit(float(factor * factor))).alias("v")).withColumnsRenamed({"by": "y", "bx": "x"})


def enlarged(pixels: DataFrame, factor: int) -> DataFrame:
    """Nearest-neighbour enlargement: every pixel becomes factor x factor pixels."""
    steps = F.array(*[F.lit(i) for i in range(factor)])
    more = pixels.withColumn("dy", F.explode(steps)).withColumn("dx", F.explode(steps))
    return more.withColumns({"y": F.col("y") * factor + F.col("dy"), "x": F.col("x") * factor + F.col("dx")}).drop("dy", "dx")


def every_kth_plane(planes: DataFrame, plane: str, k: int) -> DataFrame:
    """Plane 0 and planes k-1, 2k-1, …"""
    p = F.col(plane)
    return planes.where((p == 0) | ((p + 1) % k == 0))


def centre_planes(planes: DataFrame, plane: str, n_planes: int, keep: int) -> DataFrame:
    """The middle plane and ``keep - 1`` planes on either side."""
    return planes.where(F.abs(F.col(plane) - round(n_planes / 2)) < keep)


def rescaled(pixels: DataFrame, key: list[str], low: float = 0.0, high: float = 1.0, given: tuple[float, float] | None = None) -> DataFrame:
    """Stretch every image's full range, or a ``given`` input range, to [low, high].

    An image of one value becomes ``low``; values outside a given range are clamped.
    """
    if given is not None:
        unit = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("v") - given[0]) / (given[1] - given[0])))
        return pixels.withColumn("v", low + unit * (high - low))
    span = pixels.groupBy(*key).agg(F.min("v").alias("lo_"), F.max("v").alias("hi_"))
    unit = F.when(F.col("hi_") > F.col("lo_"), (F.col("v") - F.col("lo_")) / (F.col("hi_") - F.col("lo_"))).otherwise(F.lit(0.0))
    return pixels.join(span, key).withColumn("v", low + unit * (high - low)).drop("lo_", "hi_")


def standardised(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(v - min) / (max - min + 1e-6) per image."""
    w = Window.partitionBy(*key)
    lo = F.min("v").over(w)
    return pixels.withColumn("v", (F.col("v") - lo) / (F.max("v").over(w) - lo + F.lit(1e-6)))


def percentile_normalised(pixels: DataFrame, key: list[str], low: float = 1.0, high: float = 99.99) -> DataFrame:
    """Subtract the low percentile, divide by the high one of what is left, floor at 0."""
    first = pixels.groupBy(*key).agg(F.percentile("v", [low / 100, high / 100]).alias("p"))
    # Percentiles move with a shift, so the second one follows from the first pass.
    p = F.col("p")
    joined = pixels.join(first, key)
    return joined.withColumn("v", F.greatest(F.lit(0.0), (F.col("v") - p[0]) / (p[1] - p[0]))).drop("p")


def math(left: DataFrame, right: DataFrame, key: list[str], how: str, factors: tuple[float, float] = (1.0, 1.0), exponent: float = 1.0, times: float = 1.0, plus: float = 0.0, clamp: bool = True) -> DataFrame:
    """Two images pixel by pixel: add, subtract, multiply, maximum; then power, factor and addend.

    ``factors`` apply to the images before; what is no number becomes 0, and the result is
    clamped to [0, 1] unless told not to.
    """
    return several_math(left, right, key, [how], factors, exponent, times, plus, clamp).drop("how")


def several_math(left: DataFrame, right: DataFrame, key: list[str], hows: list[str], factors: tuple[float, float] = (1.0, 1.0), exponent: float = 1.0, times: float = 1.0, plus: float = 0.0, clamp: bool = True) -> DataFrame:
    """``math`` in several ways, told apart by ``how``: pixels meet once."""
    a, b = F.col("v") * factors[0], F.col("v_") * factors[1]
    joined = spread(left, [*key, "y", "x"]).join(spread(right.withColumnRenamed("v", "v_"), [*key, "y", "x"]), [*key, "y", "x"])

    def made(how: str) -> Column:
        c = {"add": a + b, "subtract": a - b, "multiply": a * b, "maximum": F.greatest(a, b)}[how]
        c = (c if exponent == 1.0 else F.pow(c, F.lit(exponent))) * times + plus
        sound = F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(c)
        return F.least(F.greatest(sound, F.lit(0.0)), F.lit(1.0)) if clamp else sound

    ways = F.explode(F.array(*(F.struct(F.lit(h).alias("how"), made(h).alias("v")) for h in hows))).alias("m_")
    rest = [c for c in joined.columns if c not in ("v", "v_")]
    return joined.select(*rest, ways).select(*rest, "m_.how", "m_.v")


def inverted(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("v", F.lit(1.0) - F.col("v"))


def masked_pair(pixels: DataFrame, mask: Column) -> DataFrame:
    """Each pixel twice: inside the mask (``inclusive``) and outside it (``exclusive``)."""
    m = F.when(mask, F.lit(1.0)).otherwise(F.lit(0.0))
    variants = F.array(F.struct(F.lit("inclusive").alias("variant"), (F.col("v") * m).alias("v")), F.struct(F.lit("exclusive").alias("variant"), (F.col("v") * (F.lit(1.0) - m)).alias("v")))
    keep = [c for c in pixels.columns if c != "v"]
    return pixels.select(*keep, F.explode(variants).alias("m")).select(*keep, "m.variant", "m.v")


def with_flatfield(pixels: DataFrame, field: DataFrame, key: list[str]) -> DataFrame:
    """(v - dark) / flat by (key, y, x); pixels without a field pass unchanged."""
    joined = pixels.join(field, [*key, "y", "x"], "left")
    return joined.withColumn("v", F.coalesce((F.col("v") - F.coalesce("dark", F.lit(0.0))) / F.col("flat"), F.col("v"))).drop("flat", "dark")


def matched_histogram(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Map each image's values to the smallest of the target's values that reach their rank share.

    Both tables of distinct values go through one window by image, ordered by share: a source
    value takes the first target value at or after it.
    """
    share = lambda df: df.groupBy(*key, "v").agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.sum("n").over(upto) / F.sum("n").over(Window.partitionBy(*key)))
    upto = Window.partitionBy(*key).orderBy("v")
    a = share(source).select(*key, (F.col("share") - F.lit(1e-9)).alias("share"), F.lit(0).alias("side"), "v", F.lit(None).cast("double").alias("t"))
    b = share(target).select(*key, "share", F.lit(1).alias("side"), F.lit(None).cast("double").alias("v"), F.col("v").alias("t"))
    onwards = Window.partitionBy(*key).orderBy("share", "side", "t").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    table = a.unionByName(b).withColumn("matched", F.first("t", ignorenulls=True).over(onwards)).where("side = 0").select(*key, "v", "matched")
    return source.join(table, [*key, "v"]).withColumn("v", F.col("matched")).drop("matched")


def otsu(values: DataFrame, key: list[str], value: str, bins: int = 256) -> DataFrame:
    """(key, threshold): the bin centre with the largest between-class variance, first on ties.

    Values fall into equal bins between the group's extremes; a group of one value gets that
    value.  Bins, not values, go through the window, so groups may be of any size.
    """
    span = values.where(F.col(value).isNotNull()).groupBy(*key).agg(F.min(value).alias("lo_"), F.max(value).alias("hi_"))
    binned = values.join(span, key).withColumn("bin", F.least(F.floor((F.col(value) - F.col("lo_")) / (F.col("hi_") - F.col("lo_")) * bins), F.lit(bins - 1)))
    counts = binned.where("hi_ > lo_").groupBy(*key, "lo_", "hi_", "bin").agg(F.count(F.lit(1)).alias("n"))
    centre = F.col("lo_") + (F.col("bin") + 0.5) * (F.col("hi_") - F.col("lo_")) / bins
    w, total = Window.partitionBy(*key).orderBy("bin"), Window.partitionBy(*key)
    moment = (F.col("n") * centre).alias("nc")
    c = counts.withColumn("centre", centre).withColumn("nc", moment)
    c = c.withColumns({"w1": F.sum("n").over(w), "m1": F.sum("nc").over(w), "w": F.sum("n").over(total), "m": F.sum("nc").over(total)})
    w2 = F.col("w") - F.col("w1")
    gap = F.col("m1") / F.col("w1") - (F.col("m") - F.col("m1")) / w2
    c = c.where("w1 < w").withColumn("between", F.round(F.col("w1").cast("double") * w2 * gap * gap / F.col("w") / F.col("w"), 9))
    best = c.groupBy(*key).agg(F.max(F.struct("between", (-F.col("bin")).alias("b"), "centre"))["centre"].alias("found"))
    return span.join(best, key, "left").select(*key, F.coalesce("found", "lo_").alias("threshold"))


def recentre(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, cy, cx): centre of mass."""
    mass = F.sum("v")
    return pixels.groupBy(*key).agg((F.sum(F.col("v") * F.col("y")) / mass).alias("cy"), (F.sum(F.col("v") * F.col("x")) / mass).alias("cx"))
