"""Objects: relations between label sets and measurements of labelled pixels.

Labels are pixel tables with an integer ``label``; 0 is background.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import correlation


def regions(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Area, centroid, box and intensities of every object."""
    y, x, v = F.col("y"), F.col("x"), F.col("v")
    return pixels.where("label > 0").groupBy(*key, "label").agg(
        F.count(F.lit(1)).alias("area"),
        F.avg(y).alias("centroid_0"),
        F.avg(x).alias("centroid_1"),
        F.min(y).alias("min_y"), F.max(y).alias("max_y"), F.min(x).alias("min_x"), F.max(x).alias("max_x"),
        F.max(v).alias("intensity_max"), F.avg(v).alias("intensity_mean"), F.min(v).alias("intensity_min"),
        F.sum(v).alias("intensity_sum"), F.stddev_pop(v).alias("intensity_std"),
    )


def value_percentiles(pixels: DataFrame, key: list[str], percents: list[float]) -> DataFrame:
    """Exact percentiles (0 to 100) of v by key."""
    return pixels.groupBy(*key).agg(F.percentile("v", [p / 100 for p in percents]).alias("p")).select(*key, *[F.col("p")[i].alias(f"p{p:g}".replace(".", "_")) for i, p in enumerate(percents)])


def shape(pixels: DataFrame, key: list[str]) -> DataFrame:
    """Second central moments, axes, eccentricity, orientation and equivalent diameter.

    Moments come from sums, so pixels are read once and combined map-side.
    """
    y, x = F.col("y").cast("double"), F.col("x").cast("double")
    s = pixels.where("label > 0").groupBy(*key, "label").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(y).alias("sy"), F.sum(x).alias("sx"), F.sum(y * y).alias("syy"), F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy")
    )
    n = F.col("n")
    myy = F.col("syy") / n - (F.col("sy") / n) * (F.col("sy") / n) + F.lit(1 / 12)
    mxx = F.col("sxx") / n - (F.col("sx") / n) * (F.col("sx") / n) + F.lit(1 / 12)
    mxy = F.col("sxy") / n - (F.col("sx") / n) * (F.col("sy") / n)
    s = s.withColumns({"myy": myy, "mxx": mxx, "mxy": mxy})
    half, root = (F.col("myy") + F.col("mxx")) / 2, F.sqrt(F.pow((F.col("myy") - F.col("mxx")) / 2, F.lit(2.0)) + F.col("mxy") * F.col("mxy"))
    s = s.withColumns({"major": F.sqrt(half + root) * 4, "minor": F.sqrt(F.greatest(half - root, F.lit(0.0))) * 4})
    return s.select(*key, "label", F.col("n").cast("long").alias("area"), "major", "minor", F.sqrt(F.lit(1.0) - F.pow(F.col("minor") / F.col("major"), F.lit(2.0))).alias("eccentricity"), F.sqrt(n * 4 / F.pi()).alias("equivalent_diameter"))


def related(children: DataFrame, parents: DataFrame, key: list[str]) -> DataFrame:
    """(key, child, parent, overlap): the parent sharing most pixels; ties to the lower label.

    A child without any overlap has parent 0.
    """
    c = children.where("label > 0").select(*key, "y", "x", F.col("label").alias("child"))
    p = parents.where("label > 0").select(*key, "y", "x", F.col("label").alias("parent"))
    shared = c.join(p, [*key, "y", "x"]).groupBy(*key, "child", "parent").agg(F.count(F.lit(1)).alias("overlap"))
    best = shared.groupBy(*key, "child").agg(F.max(F.struct("overlap", (-F.col("parent")).alias("p"))).alias("b"))
    every = c.select(*key, "child").distinct()
    return every.join(best, [*key, "child"], "left").select(*key, "child", F.coalesce(-F.col("b.p"), F.lit(0)).alias("parent"), F.coalesce("b.overlap", F.lit(0)).alias("overlap"))


def children_counts(parents: DataFrame, relations: DataFrame, key: list[str]) -> DataFrame:
    """Children per parent, 0 for parents without any."""
    n = relations.where("parent > 0").groupBy(*key, "parent").agg(F.count(F.lit(1)).alias("children"))
    every = parents.where("label > 0").select(*key, F.col("label").alias("parent")).distinct()
    return every.join(n, [*key, "parent"], "left").fillna(0, ["children"])


def merged_by_parent(children: DataFrame, relations: DataFrame, key: list[str]) -> DataFrame:
    """Children of one parent become one object, labelled as the parent; others go."""
    r = relations.where("parent > 0").select(*key, F.col("child").alias("label"), "parent")
    return children.join(r, [*key, "label"]).withColumn("label", F.col("parent")).drop("parent")


def tertiary(larger: DataFrame, smaller: DataFrame, key: list[str]) -> DataFrame:
    """Pixels of the larger objects that no smaller object covers."""
    return larger.where("label > 0").join(smaller.where("label > 0").select(*key, "y", "x"), [*key, "y", "x"], "left_anti")


def masked(objects: DataFrame, mask: DataFrame, key: list[str], invert: bool = False, renumber: bool = False) -> DataFrame:
    """Object pixels inside (or outside) the mask; labels kept or numbered anew from 1."""
    kept = objects.where("label > 0").join(mask.where("label > 0").select(*key, "y", "x"), [*key, "y", "x"], "left_anti" if invert else "left_semi")
    if renumber:
        kept = kept.withColumn("label", F.dense_rank().over(Window.partitionBy(*key).orderBy("label")))
    return kept


def combined(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """Union of two label sets; shared pixels go to the first, second labels follow on."""
    a = first.where("label > 0").select(*key, "y", "x", F.col("label").alias("a"))
    b = second.where("label > 0").select(*key, "y", "x", F.col("label").alias("b"))
    top = a.groupBy(*key).agg(F.max("a").alias("top"))
    both = a.join(b, [*key, "y", "x"], "full_outer").join(top, key, "left")
    return both.select(*key, "y", "x", F.coalesce("a", F.col("b") + F.coalesce("top", F.lit(0))).alias("label"))


def colocalised(pixels: DataFrame, key: list[str], share: float = 0.15) -> DataFrame:
    """Correlation, slope, overlap and Manders coefficients of channels ``a`` and ``b``.

    Pixels above ``share`` of the key's largest value count in overlap and Manders.
    """
    a, b = F.col("a"), F.col("b")
    most = pixels.groupBy(*key).agg((F.max("a") * share).alias("ta"), (F.max("b") * share).alias("tb"))
    p = pixels.join(most, key)
    on_a, on_b = a >= F.col("ta"), b >= F.col("tb")
    both = on_a & on_b
    part = lambda c, v: F.sum(F.when(c, v).otherwise(F.lit(0.0)))
    return p.groupBy(*key).agg(
        correlation(a, b).alias("correlation"),
        F.regr_slope("b", "a").alias("slope"),
        (part(both, a * b) / F.sqrt(part(both, a * a) * part(both, b * b))).alias("overlap"),
        (part(both, a) / part(on_a, a)).alias("manders_a"),
        (part(both, b) / part(on_b, b)).alias("manders_b"),
    )


def radial(pixels: DataFrame, key: list[str], bins: int) -> DataFrame:
    """Share, mean share and spread of intensity in rings around each object's centroid."""
    own = Window.partitionBy(*key, "label")
    p = pixels.where("label > 0").withColumns({"cy": F.avg("y").over(own), "cx": F.avg("x").over(own)})
    p = p.withColumn("r", F.sqrt((F.col("y") - F.col("cy")) * (F.col("y") - F.col("cy")) + (F.col("x") - F.col("cx")) * (F.col("x") - F.col("cx"))))
    p = p.withColumn("top", F.max("r").over(own))
    ring = F.when(F.col("top") > 0, F.least(F.floor(F.round(F.col("r") / F.col("top"), 9) * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    rings = p.withColumn("ring", ring).groupBy(*key, "label", "ring").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"), F.stddev_pop("v").alias("sd"))
    whole = Window.partitionBy(*key, "label")
    frac = F.col("s") / F.sum("s").over(whole)
    area = F.col("n") / F.sum("n").over(whole)
    return rings.select(*key, "label", "ring", frac.alias("frac_at_d"), (frac / area).alias("mean_frac"), F.when(F.col("m") != 0, F.col("sd") / F.col("m")).alias("radial_cv"))


def haralick(pixels: DataFrame, key: list[str], levels: int, dy: int, dx: int) -> DataFrame:
    """Texture of objects from co-occurring grey levels at an offset.

    ``g`` (0 to levels - 1) is the pixels' grey level.  The co-occurrence counts are symmetric;
    energy, contrast, correlation, variance, homogeneity and entropy (base 2) are returned.
    """
    a = pixels.where("label > 0").select(*key, "label", "y", "x", F.col("g").alias("i"))
    b = pixels.where("label > 0").select(*key, "label", (F.col("y") - dy).alias("y"), (F.col("x") - dx).alias("x"), F.col("g").alias("j"))
    pairs = a.join(b, [*key, "label", "y", "x"])
    both = pairs.select(*key, "label", F.explode(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))).alias("c")).select(*key, "label", "c.i", "c.j")
    cells = both.groupBy(*key, "label", "i", "j").agg(F.count(F.lit(1)).cast("double").alias("n"))
    s = cells.groupBy(*key, "label").agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.col("i")).alias("si"), F.sum(F.col("n") * F.col("i") * F.col("i")).alias("sii"))
    p = cells.join(s, [*key, "label"]).withColumns({"p": F.col("n") / F.col("t"), "mu": F.col("si") / F.col("t"), "var": F.col("sii") / F.col("t") - (F.col("si") / F.col("t")) * (F.col("si") / F.col("t"))})
    d = F.col("i") - F.col("j")
    return p.groupBy(*key, "label").agg(
        F.sum(F.col("p") * F.col("p")).alias("energy"),
        F.sum(F.col("p") * d * d).alias("contrast"),
        F.sum(F.when(F.col("var") > 1e-12, F.col("p") * (F.col("i") - F.col("mu")) * (F.col("j") - F.col("mu")) / F.col("var"))).alias("correlation"),
        F.max("var").alias("variance"),
        F.sum(F.col("p") / (F.lit(1.0) + d * d)).alias("homogeneity"),
        (-F.sum(F.col("p") * F.log2("p"))).alias("entropy"),
    )


def rank_weighted(pixels: DataFrame, key: list[str], share: float = 0.15) -> DataFrame:
    """(key, rwc_a, rwc_b): colocalisation weighted by how near the ranks of both channels are.

    Ranks are dense, by value within the key; pixels count where both channels reach ``share``
    of their largest value.
    """
    span = Window.partitionBy(*key)
    p = pixels.withColumns({"ra_": F.dense_rank().over(span.orderBy("a")), "rb_": F.dense_rank().over(span.orderBy("b"))})
    top = p.groupBy(*key).agg((F.max("a") * share).alias("ta_"), (F.max("b") * share).alias("tb_"), F.greatest(F.max("ra_"), F.max("rb_")).alias("most_"))
    weight = (F.col("most_") - F.abs(F.col("ra_") - F.col("rb_"))) / F.col("most_")
    on_a, on_b = F.col("a") >= F.col("ta_"), F.col("b") >= F.col("tb_")
    part = lambda c, v: F.sum(F.when(c, v).otherwise(F.lit(0.0)))
    return p.join(top, key).groupBy(*key).agg((part(on_a & on_b, F.col("a") * weight) / part(on_a, F.col("a"))).alias("rwc_a"), (part(on_a & on_b, F.col("b") * weight) / part(on_b, F.col("b"))).alias("rwc_b"))
