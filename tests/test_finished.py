"""Finished results are read, not made again; a run that dies leaves nothing behind."""

import tempfile

import pytest
from pyspark.sql import functions as F

from wellspan.sources.finished import Finished, digests

KINDS = "plate string, well string, v int"
ROWS = [("p", "A", 1), ("p", "A", 2), ("p", "B", 5), ("q", "A", 7), (None, "A", 9)]


@pytest.fixture
def store(spark):
    return Finished(spark, tempfile.mkdtemp(prefix="finished-", dir="/tmp"))


def work(how):
    return lambda df: df.groupBy("plate", "well").agg(F.sum("v").alias("total"), F.lit(how).alias("how"))


def made(df):
    return {(r.plate, r.well): (r.total, r.how) for r in df.collect()}


def test_only_what_changed_is_made_again(spark, store):
    first = made(store.completed(spark.createDataFrame(ROWS, KINDS), "sum", ["plate", "well"], work("first")))
    assert first == {("p", "A"): (3, "first"), ("p", "B"): (5, "first"), ("q", "A"): (7, "first"), (None, "A"): (9, "first")}
    changed = [*reversed(ROWS[:2]), ("p", "B", 6), ROWS[4], ("r", "C", 4)]
    again = made(store.completed(spark.createDataFrame(changed, KINDS).repartition(3), "sum", ["plate", "well"], work("again")))
    assert again == {("p", "A"): (3, "first"), ("p", "B"): (6, "again"), (None, "A"): (9, "first"), ("r", "C"): (4, "again")}
    back = made(store.completed(spark.createDataFrame(ROWS, KINDS), "sum", ["plate", "well"], work("third")))
    assert back == first | {("p", "B"): (5, "third")}


def test_nothing_runs_where_all_is_finished(spark, store):
    df = spark.createDataFrame(ROWS, KINDS)
    store.completed(df, "sum", ["plate", "well"], work("first"))

    def refused(_):
        raise AssertionError("made again")

    assert len(made(store.completed(df, "sum", ["plate", "well"], refused))) == 4
    assert store.runs().count() == 1
    assert set(made(store.completed(df, "sum", ["plate", "well"], work("other"), "k=2")).values()) == {(3, "other"), (5, "other"), (7, "other"), (9, "other")}
    assert set(made(store.completed(df, "other step", ["plate", "well"], work("x"))).values()) == {(3, "x"), (5, "x"), (7, "x"), (9, "x")}


def test_a_run_killed_half_way(spark, store):
    """Portions finished before the failure stay; the broken one leaves nothing that is read."""
    df = spark.range(60).select((F.col("id") % 20).cast("string").alias("plate"), F.lit("A").alias("well"), F.col("id").cast("int").alias("v"))
    boom = F.udf(lambda v: 1 // 0 if v == 37 else v, "int")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        store.completed(df, "sum", ["plate", "well"], lambda x: work("first")(x.withColumn("v", boom("v"))), portions=5)
    before = store.runs().count()
    kept = made(store.results(digests(df, ["plate", "well"]), "sum", ["plate", "well"])) if before else {}
    assert ("17", "A") not in kept
    whole = made(store.completed(df, "sum", ["plate", "well"], work("again"), portions=5))
    assert {k: t for k, (t, _) in whole.items()} == {(str(k), "A"): 60 + 3 * k for k in range(20)}
    assert {k for k, (_, how) in whole.items() if how == "first"} == set(kept)
    lone = Finished(spark, f"{store.folder}/lone")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        lone.completed(df, "sum", ["plate", "well"], lambda x: work("first")(x.withColumn("v", boom("v"))))
    assert lone.runs().count() == 0 and lone.units("sum", ["plate", "well"]).count() == 0
    assert {h for _, h in made(lone.completed(df, "sum", ["plate", "well"], work("again"))).values()} == {"again"}


def test_units_without_results_and_empty_inputs(spark, store):
    df = spark.createDataFrame(ROWS, KINDS)
    none = lambda x: work("none")(x.where("v > 100"))
    assert made(store.completed(df, "sum", ["plate", "well"], none)) == {}
    assert store.units("sum", ["plate", "well"]).count() == 4
    assert made(store.completed(df.limit(0), "empty", ["plate", "well"], work("x"))) == {}


def test_digests(spark):
    one = lambda rows: digests(spark.createDataFrame(rows, "k int, a int, b int"), ["k"]).first().digest
    assert one([(1, 2, 3), (1, 4, 5)]) == one([(1, 4, 5), (1, 2, 3)])
    assert len({one([(1, None, 3)]), one([(1, 3, None)]), one([(1, 3, 3)]), one([(1, 3, 3)] * 2), one([(1, None, None)])}) == 5
