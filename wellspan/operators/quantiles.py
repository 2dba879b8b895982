"""Exact percentiles, ranks and counted broadcasts for groups of any size.

No group's values meet in one task.  A mergeable sketch brackets each percentile first; then
one pass counts the values between the brackets together and those inside them, a few of ten
thousand, one by one, and only these counts are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .morphology import kept

#: The sketch's ranks are off by one of so many rows at most; brackets are twice as wide.
ACCURACY = 10_000
#: Most rows of a side that is broadcast.
BROADCAST_ROWS = 100_000
#: A numbered group is cut into so many runs.
RUNS = 256


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a side for broadcast if its row count, which is taken here, allows it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def counted(df: DataFrame) -> DataFrame:
    """What is made once here, then counted, and broadcast if it is small: a row a group, mostly.

    Few large groups would else meet their one row by a sort of all rows in a task a group.
    """
    return small_side(kept(df))


def same_key(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join by keys of which nulls are equal, as in a grouping; ``by`` may be empty."""
    if not by:
        return left.crossJoin(F.broadcast(right))  # right is one row
    other = right.withColumnsRenamed({c: f"{c}__" for c in by})
    on = F.lit(True)
    for c in by:
        on &= F.col(c).eqNullSafe(F.col(f"{c}__"))
    return left.join(other, on, how).drop(*(f"{c}__" for c in by))


def percentiles(df: DataFrame, by: list[str], value: str | Column, shares: list[float], name: str = "percentiles") -> DataFrame:
    """(by, name): the exact ``shares`` (0 to 1) of the values by group, as an array.

    Between two ranks values are interpolated, as Spark's ``percentile`` does; nulls take no
    part, and a group without values has no row.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*by, v.alias("v_")).where("v_ is not null")
    wide = 2 / ACCURACY
    asks = [x for q in shares for x in (max(0.0, q - wide), min(1.0, q + wide))]
    sketch = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_"), F.percentile_approx("v_", asks, ACCURACY).alias("b_"))
    sketch = sketch.select(*by, "n_", *(F.col("b_")[i].alias(f"b{i}_") for i in range(len(asks))))
    # Values inside a bracket keep their own cell; all others of one gap between brackets share one.
    x, inside, gap = F.col("v_"), F.lit(False), F.lit(0)
    for j in range(len(shares)):
        low, high = F.col(f"b{2 * j}_"), F.col(f"b{2 * j + 1}_")
        inside |= x.between(low, high)
        gap += F.when(x > high, 1).otherwise(0)
    cells = same_key(rows, counted(sketch) if by else sketch, by).select(*by, "n_", "v_", F.when(inside, x).alias("own_"), F.when(~inside, gap).alias("gap_"))
    cells = cells.groupBy(*by, "n_", "own_", "gap_").agg(F.count(F.lit(1)).alias("c_"), F.min("v_").alias("lo_"), F.max("v_").alias("hi_"))
    upto = F.sum("c_").over(Window.partitionBy(*by).orderBy("lo_"))
    ranked = cells.withColumn("to_", upto - 1).withColumn("from_", F.col("to_") - F.col("c_") + 1)
    # A rank that falls into a gap is its first or last value, next to a bracket.
    ends = []
    for j, q in enumerate(shares):
        at = F.lit(float(q)) * (F.col("n_") - 1)
        for name_, rank in ((f"l{j}_", F.floor(at)), (f"u{j}_", F.ceil(at))):
            ends.append(F.max(F.when(rank.between(F.col("from_"), F.col("to_")), F.when(rank == F.col("to_"), F.col("hi_")).otherwise(F.col("lo_")))).alias(name_))
    found = ranked.groupBy(*by, "n_").agg(*ends)
    part = lambda q: F.lit(float(q)) * (F.col("n_") - 1) - F.floor(F.lit(float(q)) * (F.col("n_") - 1))
    return found.select(*by, F.array(*(F.col(f"l{j}_") + (F.col(f"u{j}_") - F.col(f"l{j}_")) * part(q) for j, q in enumerate(shares))).alias(name))


def numbered(df: DataFrame, by: list[str], order: str, name: str = "number") -> DataFrame:
    """Number the rows of each group from 1 in order of a numeric column without ties.

    The column's sketched quantiles cut a group into runs; rows are numbered within runs, and
    runs start after the counts of those before.  So a task holds a run, not a group.
    """
    cuts = df.groupBy(*by).agg(F.percentile_approx(order, [i / RUNS for i in range(1, RUNS)], ACCURACY).alias("cuts_"))
    runs = same_key(df, cuts, by).withColumn("run_", F.size(F.filter("cuts_", lambda c: c < F.col(order)))).drop("cuts_")
    counts = runs.groupBy(*by, "run_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy(*by).orderBy("run_").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, "run_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("start_"))
    placed = runs.withColumn("within_", F.row_number().over(Window.partitionBy(*by, "run_").orderBy(order)))
    return same_key(placed, starts, [*by, "run_"]).withColumn(name, (F.col("start_") + F.col("within_")).cast("long")).drop("run_", "start_", "within_")
