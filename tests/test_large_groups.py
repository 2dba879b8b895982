"""Few large groups and many copies: what a task holds does not grow with them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspan.operators import filters, quantiles, runs, spatial


@pytest.fixture
def unsized(spark):
    """Sizes that Spark can not tell: only what was counted is broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_groups_are_not_sorted_to_meet_one_row(spark, unsized):
    df = spark.range(3_000).select((F.col("id") % 3).alias("k"), F.pow(F.lit(1.01), F.col("id") % 700).alias("v"))
    made = [quantiles.percentiles(df, ["k"], "v", [0.5, 0.9]), runs.trimmed(df, ["k"], "v", 0.9), filters.within_mad(df, ["v"], 1.5, ["k"]), filters.percentile_band(df, "v", 5, 95, ["k"])]
    for m in made:
        assert "SortMergeJoin" not in plan(m) and "BroadcastHashJoin" in plan(m) or m is made[0]
    assert "SortMergeJoin" not in plan(made[0])
    pdf = df.toPandas()
    top = pdf.groupby("k")["v"].quantile(0.9)
    assert made[1].count() == (pdf["v"] < pdf["k"].map(top)).sum()


def plain_nearest(rows, k, d):
    """{id: [(dist, other)]} of the k nearest others of the same label nearer than d."""
    out = {}
    for i, label, y, x in rows:
        near = sorted((((y - b) * (y - b) + (x - c) * (x - c)) ** 0.5, j) for j, other, b, c in rows if j != i and other == label)
        out[i] = [n for n in near if n[0] < d][:k]
    return out


@pytest.fixture(scope="module")
def crowd():
    """A tight cluster, a wide one, far outliers, many copies of one place, a group of two and missing places."""
    rng = np.random.default_rng(5)
    p = np.concatenate([rng.normal(0, 1e-4, (60, 2)), rng.normal(0, 0.3, (60, 2)), [[40.0, 40.0], [-70.0, 3.0]], np.repeat([[0.25, 0.5]], 40, 0)])
    rows = [(int(i), 0, float(y), float(x)) for i, (y, x) in zip(rng.permutation(len(p)) * 3, p)]
    return rows + [(901, 1, 0.0, 0.0), (902, 1, 0.0, 1.0)]


def test_nearest_of_crowds_and_copies(spark, crowd):
    df = spark.createDataFrame([*crowd, (999, 0, None, 1.0), (998, 0, float("nan"), 1.0)], "id long, label int, y double, x double")
    got = {}
    for r in spatial.nearest(df, 2, 0.1, ["label"]).collect():
        got.setdefault(r["id"], {})[r["place"]] = (r["dist"], r["other"])
    assert {i: [v[k] for k in sorted(v)] for i, v in got.items()} == {i: n for i, n in plain_nearest(crowd, 2, 0.1).items() if n}
    two = {r["id"]: [(r["first_distance"], r["first_"]), (r["second_distance"], r["second_"])] for r in spatial.closest_two(df, 0.05, ["label"]).collect()}
    assert two == {i: n for i, n in plain_nearest(crowd, 2, np.inf).items() if len(n) == 2}


def test_copies_do_not_multiply(spark):
    """A thousand copies of a place are a thousand answers from three candidates, not a million pairs."""
    df = spark.range(1_000).select("id", F.lit(0).alias("label"), F.lit(0.5).alias("y"), F.lit(0.5).alias("x"))
    found = spatial.closest_two(df, 0.05, ["label"]).collect()
    assert len(found) == 1_000 and {(r["first_"], r["second_"]) for r in found} == {(0, 1), (0, 2), (1, 2)} and all(r["angle"] == 0 for r in found)
