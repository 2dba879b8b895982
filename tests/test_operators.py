import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspan.functions import numeric
from wellspan.operators import channels, filters, flatfield, grouped, pixels, scaling, spatial
from wellspan.plans.config import RunConfig
from wellspan.plans.modules import compiled
from wellspan.streaming import groups


def test_channel_index_is_a_permutation(spark):
    reg = spark.createDataFrame([("r", ["a", "b"]), ("s", [])], "ref_plate string, qry_plates array<string>")
    chans = spark.createDataFrame([(p, c, f"n{c}") for p in "rabs" for c in (0, 1)], "plate string, orig_channel int, orig_name string")
    index = channels.channel_index(channels.cycles(reg), chans, spark.createDataFrame([("a", 1)], "plate string, orig_channel int"))
    got = {r: sorted(x["channel"] for x in index.where(F.col("ref_plate") == r).collect()) for r in "rs"}
    assert got == {"r": list(range(8)), "s": [0, 1]}
    last = index.where("channel >= 6").orderBy("channel").collect()
    assert [x["orig_channel"] for x in last] == [3, 3] and last[0]["name"].endswith("inclusive")


def test_outliers(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 1.0), (4, None), (5, float("nan"))], "id int, v double")
    assert {r["id"] for r in filters.within_mad(df, ["v"], 3, []).collect()} >= {1, 2, 3}
    assert filters.within_spread(df.where("id < 4"), "v", 1, []).count() == 3
    assert filters.percentile_band(df.where("id < 4"), "v", 0, 100, []).count() == 3


def test_must_match_raises(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(Exception, match="no partner"):
        scaling.must_match(left, spark.createDataFrame([(1,)], "k int"), ["k"]).collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_close_points(spark, seed):
    p = np.random.default_rng(seed).random((60, 2)) - 0.5
    df = spark.createDataFrame([(i, float(y), float(x)) for i, (y, x) in enumerate(p)], "id int, y double, x double")
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1)) + 9 * np.eye(60)
    assert {r["id"] for r in spatial.without_close(df, 0.1, []).collect()} == set(np.flatnonzero(d.min(1) >= 0.1))
    counts = {r["id"]: r["neighbours"] for r in spatial.neighbour_counts(df, 0.1, []).collect()}
    assert counts == dict(enumerate((d < 0.1).sum(1)))


def test_planted_surface(spark):
    c = np.zeros(15)
    c[:3] = 5, 1, -2
    rows = [(float(5 + x / 7 - 2 * y / 7), y, x) for y in range(8) for x in range(8)]
    px = spark.createDataFrame(rows, "v double, y int, x int").withColumn("plate", F.lit(1))
    sums = flatfield.gram_sums(px, ["plate"], 8).collect()[0].asDict()
    fit = flatfield.solved(sums)
    made = flatfield.surface(px, fit, 8).withColumn("r", F.col("flat") / F.col("v")).agg(F.min("r").alias("a"), F.max("r").alias("b")).collect()[0]
    assert made["a"] == pytest.approx(made["b"], rel=1e-6)


def test_otsu_and_uint16(spark):
    df = spark.createDataFrame([("a", v) for v in (0.0, 0.1, 0.2, 9.0, 9.1)] + [("b", 3.0)], "k string, v double")
    got = {r["k"]: r["threshold"] for r in pixels.otsu(df, ["k"], "v").collect()}
    assert 0.1 < got["a"] < 9.0 and got["b"] == 3.0
    v = spark.createDataFrame([(2.5,), (3.5,), (-1.0,), (1e9,)], "v double")
    assert [r[0] for r in v.select(numeric.to_uint16(F.col("v"))).collect()] == [2, 4, 0, 65535]


def test_images_round_trip_and_model(spark):
    df = spark.createDataFrame([(1, [float(i) for i in range(16)])], "id int, pixels array<double>")
    back = pixels.assembled(pixels.exploded(df, "pixels", 4), ["id"]).collect()[0]["pixels"]
    assert back == [float(i) for i in range(16)]
    got = grouped.predicted(df, ["id"], lambda: lambda x: np.stack([x.mean(1), x.max(1)], 1)).collect()[0]["probabilities"]
    assert got == [7.5, 15.0]


def test_histogram_matching(spark):
    a = spark.createDataFrame([(1, 0, i, float(i)) for i in range(4)], "k int, y int, x int, v double")
    b = spark.createDataFrame([(1, 0, i, 10.0 * i) for i in range(4)], "k int, y int, x int, v double")
    assert sorted(r["v"] for r in pixels.matched_histogram(a, b, ["k"]).collect()) == [0, 10, 20, 30]


def test_config_and_modules(spark):
    assert RunConfig.of({"manifest": "m"}).flatfield_mode == "POLY"
    for bad in ({"manifest": "m", "what": 1}, {"manifest": ""}, {"manifest": "m", "autoscale": True, "manual_scale": "s"}, {"manifest": "m", "scale_slope": "a"}):
        with pytest.raises(ValueError):
            RunConfig.of(bad)
    RunConfig.of({"manifest": "m", "image_dir": "d", "autoscale": True}).only("autoscale")
    with pytest.raises(ValueError, match="n_images, psf_rounds"):
        RunConfig.of({"manifest": "m", "n_images": 7, "psf_rounds": 3}).only("autoscale")
    with pytest.raises(ValueError):
        compiled([{"module": "Nothing"}], {})
    px = spark.createDataFrame([(1, 0, i, float(i), 1 if i > 1 else 0) for i in range(4)], "image int, y int, x int, v double, label int")
    steps = [
        {"module": "Rescale", "input": "a", "output": "b"},
        {"module": "Threshold", "input": "b", "output": "c"},
        {"module": "MaskImage", "input": "b", "objects": "o", "output": "d", "invert": True},
        {"module": "MeasureShape", "objects": "o", "output": "s"},
        {"module": "MeasureAreaOccupied", "objects": "o", "output": "w"},
        {"module": "Math", "input": "b", "other": "c", "operation": "add", "output": "e"},
        {"module": "Tertiary", "larger": "o", "smaller": "o", "output": "t"},
        {"module": "RelateObjects", "children": "o", "parents": "o", "output": "r"},
    ]
    made = compiled(steps, {"a": px.drop("label"), "o": px.drop("v")})
    assert [r["v"] for r in made["c"].orderBy("x").collect()] == [0, 0, 1, 1]
    assert [r["v"] for r in made["d"].orderBy("x").collect()][2:] == [0, 0]
    assert made["w"].collect()[0]["area_occupied"] == 0.5 and made["t"].count() == 0 and made["s"].count() == 1
    assert made["r"].collect()[0]["parent"] == 1 and made["e"].count() == 4


def test_stream_resumes(spark, tmp_path):
    schema = "k long, n int, m string, ts timestamp, value double"
    source = str(tmp_path / "in")
    rows = [(1, 2, "a", None, 1.0), (2, 2, "a", None, 1.0), (1, 2, "a", None, 1.0)]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: groups.sized_groups(spark.readStream.schema(schema).parquet(source), "k", "n", "m")
    groups.available_now(stream(), str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.schema("k long, members string").parquet(str(tmp_path / "out")).count() == 0
    spark.createDataFrame([(1, 2, "b", None, 1.0), (1, 2, "c", None, 1.0)], schema).coalesce(1).write.mode("append").parquet(source)
    groups.available_now(stream(), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["k"], r["members"]) for r in got] == [(1, "a,b,c")]


def test_constant_and_missing_groups(spark):
    """Groups without spread, nulls and empty tables have results and do not raise."""
    from pyspark.sql import functions as F

    from wellspan.functions import numeric
    from wellspan.operators import filters, objects, quantiles, scaling

    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), (None, 4.0, 4.0), ("b", None, 1.0)], "k string, a double, b double")
    got = {r["k"]: r["c"] for r in df.groupBy("k").agg(numeric.correlation(F.col("a"), F.col("b")).alias("c")).collect()}
    assert got == {"a": None, None: None, "b": None}
    p = {r["k"]: r["percentiles"] for r in quantiles.percentiles(df, ["k"], "a", [0.0, 0.5, 1.0]).collect()}
    assert p == {"a": [1.0, 1.0, 1.0], None: [4.0, 4.0, 4.0]}
    assert quantiles.percentiles(df.where("false"), ["k"], "a", [0.5]).count() == 0
    assert {r["s"] for r in filters.mad_scores(df, ["a"], ["k"], ["s"]).collect()} <= {0.0, None}
    few = spark.createDataFrame([(0, 0, 0, 0.0, 0.0)], "vec_id int, y int, x int, a double, b double")
    assert objects.rank_weighted(few.withColumns({"a": F.lit(1.0), "b": F.lit(1.0)}), ["vec_id"]).count() == 1
    lone = spark.createDataFrame([("p", "c1", 1, 1, 1, "n", 1.0, 0.5, 2.0, 3.0), ("q", "c2", 1, 1, None, "m", None, None, None, None)], "plate string, channel string, well int, field int, label int, name string, area double, threshold double, intensity_mean double, intensity_max double")
    rows = {(r["plate"], r["channel"]): r for r in scaling.control_summary(lone).collect()}
    assert len(rows) == 4 and rows["p", "c2"]["nobjects"] == 0 and rows["p", "c1"]["nobjects"] == 1 and rows["q", "c2"]["mean_threshold"] is None


def test_percentiles_of_large_skewed_groups(spark):
    from pyspark.sql import functions as F

    from wellspan.operators import quantiles

    df = spark.range(60_000).select((F.col("id") % 3 == 0).alias("k"), F.when(F.col("id") % 10 < 7, F.lit(5.0)).otherwise(F.pow(F.lit(1.0005), F.col("id"))).alias("v"))
    shares = [0.0, 0.001, 0.25, 0.5, 0.69, 0.7, 0.9, 0.9999, 1.0]
    want = {r["k"]: r["p"] for r in df.groupBy("k").agg(F.percentile("v", shares).alias("p")).collect()}
    got = {r["k"]: r["percentiles"] for r in quantiles.percentiles(df, ["k"], "v", shares).collect()}
    assert all(abs(a - b) <= 1e-9 * max(1, abs(a)) for k in want for a, b in zip(want[k], got[k]))
    placed = quantiles.numbered(df.withColumn("id", F.monotonically_increasing_id()), ["k"], "id").groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("number").alias("d"), F.max("number").alias("m")).collect()
    assert all(r["n"] == r["d"] == r["m"] for r in placed)
