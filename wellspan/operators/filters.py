"""Filters: lists, ranges, outliers and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import counted, percentiles, same_key

#: Most patterns that are compiled into one condition.
MOST_PATTERNS = 1_000


def without_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not listed; null keys stay.  Whole keys count, not parts of them."""
    return df.join(listed.select(*on).distinct(), on, "left_anti")


def only_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    return df.join(listed.select(*on).distinct(), on, "left_semi")


def without_containing(df: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """Rows whose text holds none of the patterns; a null text holds none."""
    return df.where(~holds_any(F.col(text), patterns, pattern))


def with_containing(df: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """Rows whose text holds one of the patterns or more."""
    return df.where(holds_any(F.col(text), patterns, pattern))


def holds_any(text: Column, patterns: DataFrame, pattern: str) -> Column:
    """Whether a text holds a pattern: one condition in the scan, no join.

    The list is read here; lists are short by nature, and one of more than MOST_PATTERNS is an
    error rather than a slow plan.
    """
    listed = [r[0] for r in patterns.select(pattern).where(F.col(pattern).isNotNull()).distinct().orderBy(pattern).limit(MOST_PATTERNS + 1).collect()]
    if len(listed) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns")
    found = F.lit(False)
    for x in listed:
        found |= text.contains(F.lit(x))
    return F.coalesce(found, F.lit(False))


def within_spread(df: DataFrame, value: str, k: float, by: list[str]) -> DataFrame:
    """Keep mean - k sd <= value <= mean + k sd, with the population's sd, bounds included.

    Moments are summed map-side by group and joined back, so no group is sorted in a task.
    """
    moments = df.groupBy(*by).agg(F.avg(value).alias("mean_"), F.stddev_pop(value).alias("sd_"))
    moments = counted(moments) if by else moments
    near = F.col(value).between(F.col("mean_") - k * F.col("sd_"), F.col("mean_") + k * F.col("sd_"))
    return same_key(df, moments, by).where(near).drop("mean_", "sd_")


def mad_scores(df: DataFrame, values: list[str], by: list[str], names: list[str]) -> DataFrame:
    """(value - median) / median(|value - median|) of each value; 0 where the latter is 0.

    All medians come from two passes over the long table of values, however many there are.
    """
    clean = {v: F.when(~F.isnan(F.col(v)), F.col(v).cast("double")) for v in values}
    long = df.select(*by, *(c.alias(v) for v, c in clean.items())).unpivot(by, values, "of_", "x_")
    key = [*by, "of_"]
    mids = counted(percentiles(long, key, "x_", [0.5], "mid_"))
    mads = percentiles(same_key(long, mids, key), key, F.abs(F.col("x_") - F.col("mid_")[0]), [0.5], "mad_")
    both = same_key(mids, mads, key).select(*by, F.struct("of_", F.struct(F.col("mid_")[0].alias("mid"), F.col("mad_")[0].alias("mad")).alias("m")).alias("e_"))
    found = both.groupBy(*by).agg(F.map_from_entries(F.collect_list("e_")).alias("m_"))
    joined = same_key(df, counted(found) if by else found, by, "left")

    def score(v: str) -> Column:
        m = F.col("m_")[v]
        return F.when(m["mad"] == 0, F.lit(0.0)).otherwise((clean[v] - m["mid"]) / m["mad"])

    return joined.withColumns({n: score(v) for v, n in zip(values, names)}).drop("m_")


def within_mad(df: DataFrame, values: list[str], k: float, by: list[str]) -> DataFrame:
    """Keep rows whose MAD scores lie within k in every one of ``values``."""
    names = [f"score_{v}" for v in values]
    kept = F.lit(True)
    for n in names:
        kept &= F.col(n).between(-k, k)
    return mad_scores(df, values, by, names).where(kept).drop(*names)


def percentile_band(df: DataFrame, value: str, low: float, high: float, by: list[str]) -> DataFrame:
    """Keep values between two percentiles (0 to 100), bounds included."""
    band = percentiles(df, by, value, [low / 100, high / 100], "band_")
    return same_key(df, counted(band) if by else band, by).where(F.col(value).between(F.col("band_")[0], F.col("band_")[1])).drop("band_")


def inside_border(df: DataFrame, x: str, y: str, bounds: tuple[float, float, float, float]) -> DataFrame:
    """Keep xmin <= x <= xmax and ymin <= y <= ymax."""
    x0, x1, y0, y1 = bounds
    return df.where(F.col(x).between(x0, x1) & F.col(y).between(y0, y1))


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Kept and removed rows; null counts as removed."""
    flag = F.coalesce(condition, F.lit(False))
    return df.where(flag), df.where(~flag)


def with_enough(df: DataFrame, by: list[str], least: int) -> DataFrame:
    """Rows of groups that have ``least`` rows or more (flag and skip the others)."""
    return df.join(df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_")).where(F.col("n_") >= least).drop("n_"), by, "left_semi")


def crop_eligible(width: Column, height: Column, depth: Column, cy: Column, cx: Column, rows: int, cols: int) -> Column:
    """A square crop of the object's largest extent around its centroid lies in the image."""
    half = F.floor(F.greatest(width, height, depth) / 2)
    y, x = F.rint(cy), F.rint(cx)
    return (width > 0) & (height > 0) & (y - half >= 0) & (y + half <= rows) & (x - half >= 0) & (x + half <= cols)


def first_of(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in a stated order."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("place_", place).where("place_ = 1").drop("place_")


def required(df: DataFrame, column: str) -> DataFrame:
    """All rows; one whose ``column`` is null raises when it is read."""
    return df.where(F.assert_true(F.col(column).isNotNull(), F.lit(f"{column} is missing")).isNull())
