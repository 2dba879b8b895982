"""Measurement pipelines as data: a list of modules compiled to DataFrame operators.

A context holds named tables (images and objects); each module reads and writes names.
Modules that are switched off are skipped, and new ones can be registered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import filters, lines, measures, morphology, objects, pixels, shapes, thresholds, tiles

Context = dict[str, DataFrame]
KEY = ["image"]
MODULES: dict[str, Callable[[Context, dict], None]] = {}


def module(name: str) -> Callable[[Callable[[Context, dict], None]], Callable[[Context, dict], None]]:
    def add(f: Callable[[Context, dict], None]) -> Callable[[Context, dict], None]:
        MODULES[name] = f
        return f

    return add


def compiled(steps: list[dict], tables: Context) -> Context:
    """Apply the steps in order; nothing runs until one of the tables is read."""
    context = dict(tables)
    for i, step in enumerate(steps):
        if step.get("enabled", True):
            if step["module"] not in MODULES:
                raise ValueError(f"step {i}: unknown module {step['module']}")
            MODULES[step["module"]](context, step)
    return context


@module("Rescale")
def _rescale(c: Context, s: dict) -> None:
    """The image's full range, or the ``range`` stated, to [0, 1]."""
    c[s["output"]] = pixels.rescaled(c[s["input"]], KEY, given=s.get("range"))


@module("Invert")
def _invert(c: Context, s: dict) -> None:
    c[s["output"]] = pixels.inverted(c[s["input"]])


@module("Math")
def _math(c: Context, s: dict) -> None:
    options = {n: s[n] for n in ("factors", "exponent", "times", "plus", "clamp") if n in s}
    c[s["output"]] = pixels.math(c[s["input"]], c[s["other"]], KEY, s["operation"], **options)


@module("Threshold")
def _threshold(c: Context, s: dict) -> None:
    """A stated level, or each image's own; adaptive ones by window; ``factor`` and ``bounds`` correct it.

    Methods: manual, otsu, cross_entropy, three_class (``class`` low or high).
    """
    image, key, method = c[s["input"]], list(KEY), s.get("method", "otsu")
    if "window" in s:
        side = s["window"]
        image, key = image.withColumns({"ty_": F.floor(F.col("y") / side), "tx_": F.floor(F.col("x") / side)}), [*KEY, "ty_", "tx_"]
    if method == "manual":
        level = image.withColumn("threshold", F.lit(float(s["level"])))
    elif method == "three_class":
        level = image.join(thresholds.three_class_otsu(image, key, "v").select(*key, F.col(s.get("class", "low")).alias("threshold")), key)
    else:
        level = image.join(thresholds.minimum_cross_entropy(image, key, "v") if method == "cross_entropy" else pixels.otsu(image, key, "v"), key)
    cut = thresholds.corrected(F.col("threshold"), s.get("factor", 1.0), *s.get("bounds", (0.0, 1.0)))
    c[s["output"]] = level.withColumn("v", F.when(F.col("v") >= cut, 1.0).otherwise(0.0)).drop("threshold", "ty_", "tx_")


@module("MaskImage")
def _mask_image(c: Context, s: dict) -> None:
    mask = c[s["objects"]].where("label > 0").select(*KEY, "y", "x", F.lit(True).alias("in_"))
    joined = c[s["input"]].join(mask, [*KEY, "y", "x"], "left")
    inside = F.col("in_").isNotNull()
    c[s["output"]] = joined.withColumn("v", F.when(~inside if s.get("invert") else inside, F.col("v")).otherwise(0.0)).drop("in_")


@module("RelateObjects")
def _relate(c: Context, s: dict) -> None:
    c[s["output"]] = objects.related(c[s["children"]], c[s["parents"]], KEY)


@module("MergePerParent")
def _merge(c: Context, s: dict) -> None:
    c[s["output"]] = objects.merged_by_parent(c[s["objects"]], c[s["relations"]], KEY)


@module("MaskObjects")
def _mask_objects(c: Context, s: dict) -> None:
    c[s["output"]] = objects.masked(c[s["objects"]], c[s["mask"]], KEY, s.get("invert", False), s.get("renumber", False))


@module("Tertiary")
def _tertiary(c: Context, s: dict) -> None:
    c[s["output"]] = objects.tertiary(c[s["larger"]], c[s["smaller"]], KEY)


@module("Combine")
def _combine(c: Context, s: dict) -> None:
    c[s["output"]] = objects.combined(c[s["first"]], c[s["second"]], KEY)


@module("MeasureIntensity")
def _intensity(c: Context, s: dict) -> None:
    both = c[s["objects"]].select(*KEY, "y", "x", "label").join(c[s["input"]].select(*KEY, "y", "x", "v"), [*KEY, "y", "x"])
    c[s["output"]] = objects.regions(both, KEY)


@module("MeasureShape")
def _shape(c: Context, s: dict) -> None:
    c[s["output"]] = objects.shape(c[s["objects"]], KEY)


@module("MeasureAreaOccupied")
def _area(c: Context, s: dict) -> None:
    share = F.sum(F.when(F.col("label") > 0, 1.0).otherwise(0.0)) / F.count(F.lit(1))
    c[s["output"]] = c[s["objects"]].groupBy(*KEY).agg(share.alias("area_occupied"))


@module("FilterObjects")
def _filter(c: Context, s: dict) -> None:
    """Keep objects whose measure lies between limits; ``removed`` may name the rest."""
    kept, rest = filters.split_by(c[s["measures"]], F.col(s["by"]).between(s.get("low", float("-inf")), s.get("high", float("inf"))))
    c[s["output"]] = c[s["objects"]].join(kept.select(*KEY, "label"), [*KEY, "label"], "left_semi")
    if "removed" in s:
        c[s["removed"]] = c[s["objects"]].join(rest.select(*KEY, "label"), [*KEY, "label"], "left_semi")


@module("FlagImage")
def _flag(c: Context, s: dict) -> None:
    """Images with fewer than ``least`` objects are skipped in all tables named."""
    n = c[s["objects"]].where("label > 0").groupBy(*KEY).agg(F.countDistinct("label").alias("n_")).where(F.col("n_") >= s["least"])
    for name in s["tables"]:
        c[name] = c[name].join(n.select(*KEY), KEY, "left_semi")


@module("Export")
def _export(c: Context, s: dict) -> None:
    c[s["output"]] = c[s["input"]].select(*s["columns"])


def _mask(image: DataFrame) -> DataFrame:
    return image.where("v > 0").select(*KEY, "y", "x")


@module("ConvertImageToObjects")
def _to_objects(c: Context, s: dict) -> None:
    c[s["output"]] = morphology.components(_mask(c[s["input"]]), KEY)


@module("ConvertObjectsToImage")
def _to_image(c: Context, s: dict) -> None:
    """Labels as values on the frame of another image, background 0."""
    own = c[s["objects"]].select(*KEY, "y", "x", F.col("label").cast("double").alias("label_"))
    c[s["output"]] = c[s["frame"]].join(own, [*KEY, "y", "x"], "left").withColumn("v", F.coalesce("label_", F.lit(0.0))).drop("label_")


@module("IdentifyPrimary")
def _primary(c: Context, s: dict) -> None:
    """Pixels of the thresholded image as objects, split where they are narrow if ``split``."""
    grow = morphology.watershed if s.get("split") else morphology.components
    found = grow(_mask(c[s["input"]]), KEY)
    if "least" in s or "most" in s:
        sizes = found.groupBy(*KEY, "label").agg(F.count(F.lit(1)).alias("n_")).where(F.col("n_").between(s.get("least", 1), s.get("most", 1 << 62)))
        found = found.join(sizes.drop("n_"), [*KEY, "label"], "left_semi")
    if s.get("inner"):
        found = morphology.border_cleared(_framed(found, c[s["input"]]), KEY)
    c[s["output"]] = morphology.kept(tiles.spread(found, [*KEY, "label"]))  # read by every measure


def _framed(objects_: DataFrame, image: DataFrame) -> DataFrame:
    return image.select(*KEY, "y", "x").join(objects_, [*KEY, "y", "x"], "left").fillna(0, ["label"])


@module("IdentifySecondary")
def _secondary(c: Context, s: dict) -> None:
    """Seeds grown over a mask, ties to the lower label: by distance, or along an ``image`` (propagation)."""
    seeds = c[s["seeds"]].where("label > 0").select(*KEY, "y", "x", "label")
    if "image" in s:
        marked = _mask(c[s["input"]]).withColumn("inside", F.lit(1))
        whole = c[s["image"]].select(*KEY, "y", "x", "v").join(seeds, [*KEY, "y", "x"], "left").join(marked, [*KEY, "y", "x"], "left").fillna(0, ["label", "inside"])
        c[s["output"]] = morphology.secondary(whole, KEY, s.get("weight", 0.05)).where("label > 0").drop("distance")
        return
    both = _mask(c[s["input"]]).join(seeds, [*KEY, "y", "x"], "full_outer").select(*KEY, "y", "x", F.coalesce("label", F.lit(0)).alias("label"))
    c[s["output"]] = morphology.propagated(both, KEY).where("label > 0")


@module("ExpandOrShrink")
def _expand(c: Context, s: dict) -> None:
    own = c[s["objects"]]
    c[s["output"]] = morphology.shrunk(own, KEY, s["pixels"]) if s.get("shrink") else morphology.propagated(_framed(own.select(*KEY, "y", "x", "label"), c[s["frame"]]), KEY, s["pixels"]).where("label > 0")


@module("Morph")
def _morph(c: Context, s: dict) -> None:
    """erode, dilate, open, close, median, average, suppress, enhance or gaussian by ``size``."""
    m, image, size = morphology, c[s["input"]], s["size"]
    made = {
        "erode": m.eroded, "dilate": m.dilated, "open": m.opened, "close": m.closed, "median": m.median_filtered, "average": m.averaged, "suppress": m.suppressed,
        "enhance": lambda p, k, n: m.suppressed(p, k, n, enhance=True), "gaussian": m.gaussian,
    }
    c[s["output"]] = made[s["operation"]](image.select(*KEY, "y", "x", "v"), KEY, size)


@module("FillHoles")
def _fill(c: Context, s: dict) -> None:
    c[s["output"]] = morphology.holes_filled(c[s["input"]].select(*KEY, "y", "x", "v"), KEY)


@module("Resize")
def _resize(c: Context, s: dict) -> None:
    c[s["output"]] = pixels.enlarged(c[s["input"]], s["factor"])


@module("MatchHistogram")
def _match(c: Context, s: dict) -> None:
    c[s["output"]] = pixels.matched_histogram(c[s["input"]], c[s["other"]], KEY)


def _measured(c: Context, s: dict) -> DataFrame:
    return c[s["objects"]].select(*KEY, "y", "x", "label").join(c[s["input"]].select(*KEY, "y", "x", "v"), [*KEY, "y", "x"])


@module("MeasureObjectIntensity")
def _object_intensity(c: Context, s: dict) -> None:
    c[s["output"]] = measures.intensity(_measured(c, s), KEY)


@module("MeasureTexture")
def _texture(c: Context, s: dict) -> None:
    """Values in [0, 1] in ``levels`` grey levels, at each of ``scales``."""
    n = s.get("levels", 256)
    grey = _measured(c, s).withColumn("g", F.least(F.floor(F.col("v") * n), F.lit(n - 1)).cast("int"))
    c[s["output"]] = measures.textures(grey, KEY, n, list(s["scales"]))


@module("MeasureGeometry")
def _geometry(c: Context, s: dict) -> None:
    own = c[s["objects"]]
    c[s["output"]] = measures.moments(own, KEY).join(measures.geometry(own, KEY).drop("area"), [*KEY, "label"])


@module("MeasureShape")
def _shape(c: Context, s: dict) -> None:
    """Hull measures and radii, and with ``degree`` the Zernike magnitudes up to it."""
    own = c[s["objects"]]
    made = shapes.hull_measures(own, KEY).join(shapes.radii(own, KEY), [*KEY, "label"])
    c[s["output"]] = made.join(shapes.zernike(own, KEY, s["degree"]), [*KEY, "label"], "left") if "degree" in s else made


@module("MeasureIntensityZernike")
def _light_zernike(c: Context, s: dict) -> None:
    c[s["output"]] = shapes.zernike(_measured(c, s), KEY, s.get("degree", 9), weighted=True)


@module("MeasurePowerSlope")
def _power_slope(c: Context, s: dict) -> None:
    c[s["output"]] = lines.power_slope(c[s["input"]], KEY, s.get("share", 0.125))


@module("LocalThreshold")
def _local_threshold(c: Context, s: dict) -> None:
    """Pixels above the threshold of their own window: 1, others 0."""
    level = lines.local_threshold(c[s["input"]], KEY, s.get("window", 51), s.get("k", 0.2), s.get("range", 1.0))
    c[s["output"]] = c[s["input"]].join(level, [*KEY, "y", "x"]).withColumn("v", F.when(F.col("v") > F.col("threshold"), 1.0).otherwise(0.0)).drop("threshold")


@module("MeasureNeighbours")
def _neighbours(c: Context, s: dict) -> None:
    c[s["output"]] = measures.touching(c[s["objects"]], KEY)


@module("MeasureGranularity")
def _granularity(c: Context, s: dict) -> None:
    c[s["output"]] = morphology.granularity(c[s["input"]], KEY, s["steps"], s.get("radius", 1))


@module("MeasureImageQuality")
def _quality(c: Context, s: dict) -> None:
    c[s["output"]] = measures.quality(c[s["input"]], KEY, s["tile"])


@module("MeasureRadial")
def _radial(c: Context, s: dict) -> None:
    c[s["output"]] = objects.radial(_measured(c, s), KEY, s["bins"])


@module("MeasureColocalisation")
def _colocalisation(c: Context, s: dict) -> None:
    both = c[s["input"]].select(*KEY, "y", "x", F.col("v").alias("a")).join(c[s["other"]].select(*KEY, "y", "x", F.col("v").alias("b")), [*KEY, "y", "x"])
    c[s["output"]] = objects.colocalised(both, KEY, s.get("share", 0.15))
