"""Every stage of the pipeline on odd tables: nulls, ties, repeats, long texts, clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = " ".join(f"w{i}" for i in range(40))
LONG = " ".join(np.random.default_rng(1).choice(WORDS.split(), 120_000))
PASSAGE = "\n".join(f"shared line number {i} of a passage" for i in range(6))


def odd(spark):
    texts = [None, "", " \n\t ", "one", WORDS, WORDS, LONG, PASSAGE + "\n" + WORDS + " a", WORDS + " b\n" + PASSAGE]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    rows += [(4, WORDS, "en", "s", None), (4, WORDS + " c d e f g h i j k l m n o p q r s t", None, None, 7), (None, WORDS, None, "s", 1), (None, WORDS, None, "s", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_odd_rows(spark, tmp_path, name, stage):
    df = odd(spark).withColumns({c: F.lit("x") for c in ("kept", "size", "row", "h1", "h2", "bands", "ids", "covered", "block", "text_", "n_lines")})
    df.write.parquet(f"{tmp_path}/in")
    got = stage(spark, spark.read.parquet(f"{tmp_path}/in"), str(tmp_path))
    rows = got.collect()
    key = sorted(((r["doc_id"], r["source"]) for r in rows), key=str)
    if name != "encoding":
        assert got.columns == pipeline.COLUMNS
    if name == "quality rules":  # texts under twenty words go, row by row
        assert [k[0] for k in key] == sorted([4, 4, 4, 5, 6, 7, 8, None, None], key=str)
    elif name == "line dedup":  # no row is lost but those cut to nothing; the passage stays once
        assert len(rows) == df.count() and sum(PASSAGE in (r["text"] or "") for r in rows) == 1
    elif name == "near dedup":
        # Wordless rows stay; of four equal texts, with an id and without, the smallest id; of two equal rows one; 8 is a near copy of 7.
        assert [k[0] for k in key] == sorted([0, 1, 2, 3, 4, 4, 6, 7, None], key=str) and sum(r["text"] == WORDS for r in rows) == 1
    elif name == "source mix":
        taken = sum(len((r["text"] or "").split()) for r in rows)
        assert all((r["text"] or "").split() for r in rows) and abs(taken - sum(len((r["text"] or "").split()) for r in odd(spark).collect())) <= 2 * 64 * 2
    else:
        assert len(rows) == df.count() and sorted(r["n_tokens"] for r in rows)[:4] == [0, 0, 0, 0]


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_empty_table(spark, tmp_path, name, stage):
    assert stage(spark, odd(spark).where("false"), str(tmp_path)).count() == 0


def test_run(spark, tmp_path):
    odd(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in rows} >= {4, 6} and all(r["n_tokens"] > 0 for r in rows)
