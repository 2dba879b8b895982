"""Colocalisation thresholds along a regression line, found from one histogram of each image."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SUMS = {"n": lambda a, b: F.lit(1.0), "a": lambda a, b: a, "b": lambda a, b: b, "aa": lambda a, b: a * a, "bb": lambda a, b: b * b, "ab": lambda a, b: a * b}


def regression_line(pixels: DataFrame, key: list[str]) -> DataFrame:
    """(key, slope, offset, top_a, top_b): the orthogonal regression of ``b`` on ``a`` where one is positive.

    Null where the channels do not vary together.
    """
    a, b = F.col("a"), F.col("b")
    lit = (a > 0) | (b > 0)
    of = lambda c: F.when(lit, c)
    s = pixels.groupBy(*key).agg(F.var_samp(of(a)).alias("va"), F.var_samp(of(b)).alias("vb"), F.covar_samp(of(a), of(b)).alias("c"), F.avg(of(a)).alias("ma"), F.avg(of(b)).alias("mb"), F.max("a").alias("top_a"), F.max("b").alias("top_b"))
    gap = F.col("vb") - F.col("va")
    slope = (gap + F.sqrt(gap * gap + F.col("c") * F.col("c") * 4)) / F.nullif(F.col("c") * 2, F.lit(0.0))
    return s.withColumn("slope", slope).select(*key, "slope", (F.col("mb") - F.col("slope") * F.col("ma")).alias("offset"), "top_a", "top_b")


def thresholds(pixels: DataFrame, key: list[str], scale: int = 255) -> DataFrame:
    """(key, threshold_a, threshold_b): where the pixels below either threshold stop to correlate.

    Thresholds go down along the regression line in steps of 1 / ``scale`` of channel ``a``,
    from the first that is not above both channels' largest values, to the first at which the
    pixels below either one have no positive correlation (or are fewer than two), and to two
    steps above 0 at most.  A pixel is below from one step on (with a falling line also up to
    another), so each counts in one cell or three, cells are summed map-side, and running sums
    over at most some hundred cells give the correlation at every step: images are read twice,
    never once a step.
    """
    line = regression_line(pixels, key).where("slope is not null")
    p = pixels.join(line.select(*key, "slope", "offset"), key)
    by_a = F.floor(F.col("a") * scale) + 1
    reach = (F.col("b") - F.col("offset")) / F.col("slope") * scale
    event = lambda at, sign: F.struct(at.cast("long").alias("k_"), F.lit(float(sign)).alias("sign"))
    ends = F.greatest(F.ceil(reach) - 1, F.lit(-1))  # the last step below, where the line falls
    rising = F.array(event(F.least(by_a, F.floor(reach) + 1), 1))
    falling = F.array(event(F.lit(-1), 1), event(ends + 1, -1), event(F.greatest(by_a, ends + 1), 1))
    moved = p.select(*key, "a", "b", F.explode(F.when(F.col("slope") > 0, rising).otherwise(falling)).alias("e"))
    cells = moved.groupBy(*key, F.greatest(F.col("e.k_"), F.lit(-1)).alias("k_")).agg(*(F.sum(F.col("e.sign") * f(F.col("a"), F.col("b"))).alias(n) for n, f in SUMS.items()))
    # Every step from the line's start to 1, so that steps without a cell of their own count too.
    highest = F.floor(F.greatest("top_a", "top_b") * scale) + 1
    start = line.withColumn("steps", F.sequence(F.lit(1).cast("long"), F.greatest(highest, F.lit(1)))).select(*key, "slope", "offset", "top_a", "top_b", F.explode("steps").alias("k_"))
    grid = start.select(*key, "k_", *(F.lit(0.0).alias(n) for n in SUMS), F.lit(True).alias("step"))
    both = grid.unionByName(cells.withColumn("step", F.lit(False)))
    up = Window.partitionBy(*key).orderBy("k_").rangeBetween(Window.unboundedPreceding, 0)
    run = both.withColumns({n: F.sum(n).over(up) for n in SUMS}).where("step").drop("step").join(line, key)
    n, c = F.col("n"), F.col
    spread = (c("aa") - c("a") * c("a") / n) * (c("bb") - c("b") * c("b") / n)
    r = F.when((n > 1.5) & (spread > 1e-18), (c("ab") - c("a") * c("b") / n) / F.sqrt(spread))
    at_a, at_b = c("k_") / scale, c("slope") * c("k_") / scale + c("offset")
    inside = run.withColumns({"r": r, "open": ~((at_a > c("top_a")) & (at_b > c("top_b")))})
    first = inside.groupBy(*key).agg(F.max(F.when(c("open"), c("k_"))).alias("from_"))
    met = inside.join(first, key).where("k_ <= from_")
    # Sums of equal values leave some 1e-17: that is no correlation, and neither is less.
    stop = F.max(F.when((c("k_") >= 2) & ((n < 1.5) | (c("r") <= 1e-12)), c("k_")))
    found = met.groupBy(*key).agg(F.coalesce(stop, F.least(F.lit(2).cast("long"), F.max("from_"))).alias("k_"))
    return found.join(line, key).select(*key, (c("k_") / scale).alias("threshold_a"), (c("slope") * c("k_") / scale + c("offset")).alias("threshold_b"))


def coefficients(pixels: DataFrame, key: list[str], scale: int = 255) -> DataFrame:
    """(key, threshold_a, threshold_b, costes_a, costes_b): the share of each channel's signal above
    its threshold that lies where both are above theirs."""
    p = pixels.join(thresholds(pixels, key, scale), key)
    a, b = F.col("a"), F.col("b")
    on_a, on_b = a >= F.col("threshold_a"), b >= F.col("threshold_b")
    part = lambda c, v: F.sum(F.when(c, v).otherwise(F.lit(0.0)))
    share = lambda v, own: part(on_a & on_b, v) / F.nullif(part(own, v), F.lit(0.0))
    return p.groupBy(*key).agg(F.first("threshold_a").alias("threshold_a"), F.first("threshold_b").alias("threshold_b"), share(a, on_a).alias("costes_a"), share(b, on_b).alias("costes_b"))
