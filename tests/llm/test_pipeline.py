"""The pipeline against a brute-force version of its stages, and the registered queries."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


def test_stages(spark, tmp_path):
    from llm_brute import components, cut_lines, sound

    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    now = given
    for i, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, now, FOLDER).write.parquet(f"{tmp_path}/{i}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert now.columns == pipeline.COLUMNS, name
        if i == 0:
            kept = {r["doc_id"] for r in now.collect()}
            assert kept <= {d for d, t in texts.items() if sound(t)}
            assert len(kept) > 0.9 * sum(sound(t) for t in texts.values())
        elif i == 1:
            had = {r["doc_id"]: r["text"] for r in before.collect()}
            assert {r["doc_id"]: r["text"] for r in now.collect()} == {d: t for d, t in cut_lines(had).items() if t.split() or t == had[d]}
        elif i == 2:
            had = {r["doc_id"]: r["text"] for r in before.collect()}
            assert {r["doc_id"] for r in now.collect()} == set(components(had, 5, 80, 100).values())
        elif i == 3:
            size, got = Counter(), Counter()
            for r in before.collect():
                size[r["doc_id"]] += len(r["text"].split())
            for r in now.collect():
                got[r["doc_id"]] += len(r["text"].split())
            assert all(got[d] <= 3 * size[d] for d in got) and abs(sum(got.values()) - sum(size.values())) < 64 * 25
        else:
            assert now.count() == before.count() and now.where("n_tokens > 0").count() == now.count()


def test_queries_against_sql(spark):
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from '{FOLDER}/{file}'")
    from wellspan.llm.queries import ORACLES, QUERIES

    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in QUERIES} and "pipeline" in entry.queries()
    for name, sql in ORACLES.items():
        rows = lambda t: sorted(map(repr, zip(*(t[c].to_pylist() for c in sorted(t.column_names)))))
        assert rows(QUERIES[name](spark, FOLDER).toArrow()) == rows(con.sql(sql).to_arrow_table()), name
