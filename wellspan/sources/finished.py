"""A store of finished results: a rerun computes only what is missing or has changed.

A store is a folder with three tables: ``results`` and ``units`` by step and run, and ``runs``.
A run first writes the units it is about to do, then their results, and last one row into
``runs``.  That row is one small file, which appears at once: with it results and units are
there together, without it neither counts.  So a run that dies half way leaves nothing that
a later one would read, and is done again.  Nothing of the tables passes through the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quantiles import same_key, small_side

RUNS = "step string, run string, at timestamp"


def digests(inputs: DataFrame, by: list[str], settings: str = "") -> DataFrame:
    """(by, digest): tells apart what a unit's rows hold, in any order, and under which settings.

    Two 64-bit hashes of each row are summed map-side, so a unit of any size is one small row.
    Nulls are told apart from each other by column; equal rows count as often as they come.
    Columns of map type have no hash and raise.
    """
    values = [c for c in sorted(inputs.columns) if c not in by]
    parts: list[Column] = [F.lit(c) for c in values] + [F.col(f"`{c}`") for c in values] + [F.col(f"`{c}`").isNull() for c in values]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")).cast("string")
    summed = inputs.groupBy(*by).agg(total(1).alias("a_"), total(2).alias("b_"), F.count(F.lit(1)).alias("n_"))
    return summed.select(*by, F.sha2(F.concat_ws("|", F.lit(settings), "a_", "b_", "n_"), 256).alias("digest"))


class Finished:
    """Finished units of steps in ``folder``, which all executors share.

    Runs may overlap in time: both then stand, and the later one is read.  Inputs must not
    change while a run is reading them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, path: str, schema: str | None = None) -> DataFrame | None:
        try:
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.parquet(f"{self.folder}/{path}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def runs(self) -> DataFrame:
        """(step, run, at) of all runs that came to their end."""
        found = self._read("runs", RUNS)
        return self.spark.createDataFrame([], RUNS) if found is None else found

    def units(self, step: str, by: list[str]) -> DataFrame | None:
        """(by, digest, run): the latest finished state of each unit; None before the first run."""
        found = self._read(f"units/{step}")
        if found is None:
            return None
        done = found.join(F.broadcast(self.runs().where(F.col("step") == step).select("run")), "run", "left_semi")
        last = F.max(F.struct("run", "digest"))
        return done.groupBy(*by).agg(last.alias("last_")).select(*by, "last_.digest", "last_.run")

    def pending(self, wanted: DataFrame, step: str, by: list[str]) -> DataFrame:
        """Those of ``wanted`` (by, digest) that no finished run has done with the same digest."""
        held = self.units(step, by)
        return wanted if held is None else same_key(wanted, held.drop("run"), [*by, "digest"], "left_anti")

    def results(self, wanted: DataFrame, step: str, by: list[str]) -> DataFrame | None:
        """Results, each of its unit's latest run, of the units in ``wanted`` whose digest still holds."""
        made, held = self._read(f"results/{step}"), self.units(step, by)
        if made is None or held is None:
            return None
        current = same_key(held, wanted.select(*by, "digest"), [*by, "digest"], "left_semi").drop("digest")
        return same_key(made, small_side(current), [*by, "run"], "left_semi").drop("run")

    def add(self, inputs: DataFrame, todo: DataFrame, step: str, by: list[str], work: Callable[[DataFrame], DataFrame]) -> None:
        """One run: ``work`` on the inputs of the units ``todo`` (by, digest), committed as a whole.

        ``work`` keeps the columns ``by``.  A unit for which it returns no rows is finished too.
        """
        run = f"r{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        place = lambda kind: f"{self.folder}/{kind}/{step}/run={run}"
        todo.write.parquet(place("units"))
        chosen = small_side(self.spark.read.parquet(place("units")))
        work(same_key(inputs, chosen.select(*by), by, "left_semi")).write.parquet(place("results"))
        row = self.spark.range(1).select(F.lit(step).alias("step"), F.lit(run).alias("run"), F.current_timestamp().alias("at"))
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/runs")

    def completed(self, inputs: DataFrame, step: str, by: list[str], work: Callable[[DataFrame], DataFrame], settings: str = "", portions: int = 1) -> DataFrame:
        """Results of ``work`` for all units of ``inputs``; those finished before are read, not made.

        A unit is a value of ``by`` (nulls are a value).  It is made again if its rows or the
        ``settings`` have changed.  With ``portions`` the units are spread over as many runs by
        a hash, one after the other, so a job that dies loses the portion it was at.
        """
        at = f"{self.folder}/wanted/{step}/{uuid.uuid4().hex}"
        digests(inputs, by, settings).write.parquet(at)
        wanted = self.spark.read.parquet(at)
        part = F.pmod(F.xxhash64(*by, *(F.col(c).isNull() for c in by)), F.lit(portions))
        for k in range(portions):
            todo = self.pending(wanted.where(part == k), step, by)
            if not todo.isEmpty():
                self.add(inputs, todo, step, by, work)
        found = self.results(wanted, step, by)
        return work(inputs.limit(0)) if found is None else found
