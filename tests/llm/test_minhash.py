"""Near-dedup: tiles of large buckets, rows without or with repeated ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspan.llm import minhash

DOCS = "doc_id long, text string, lang string"


def group(n, seed, words=120, most=16):
    """Near copies of one text: each replaces up to ``most`` words, so that many do not link."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for at in rng.integers(0, words, rng.integers(0, most)):
            own[at] = f"c{rng.integers(1e9)}"
        out.append(" ".join(own))
    return out


def expected(texts, rule):
    from llm_brute import components

    return components(dict(enumerate(texts)), rule.width, rule.num, rule.den)


@pytest.mark.parametrize("chunks", [(2_048, 500_000), (20, 3_000)])
def test_one_large_group_in_tiles(spark, monkeypatch, chunks):
    monkeypatch.setattr(minhash, "CHUNK_SIGNATURES", chunks[0])
    monkeypatch.setattr(minhash, "CHUNK_SHINGLES", chunks[1])
    texts = [*group(150, 1), *group(40, 2, 60, 5)]
    rule = minhash.Threshold(3, 85, 100)
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_components(df, rule).collect()}
    want = expected(texts, rule)
    assert got == want and 3 < len(set(want.values())) < 150


def test_rows_not_pairs_leave_the_tiles(spark):
    texts = group(150, 1)
    rows = [(7, 0, 0, i, i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "band long, i int, j int, node long, own long, text string").coalesce(1)
    links = minhash.joining_links(df, minhash.Threshold(3, 85, 100)).collect()
    assert len(links) == len(texts) - len(set(expected(texts, minhash.Threshold(3, 85, 100)).values()))


def test_one_of_each(spark):
    a = group(1, 3)[0]
    b = a.replace(" w60 ", " changed ")
    far = " ".join(f"x{i}" for i in range(60))
    rows = [(5, a, "en"), (3, b, "en"), (3, b, "en"), (3, far, "en"), (None, a, "en"), (None, far + " y", "de"), (8, None, None), (9, " ", None), (8, None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("root", "node", "band", "n_shingles")})
    got = minhash.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted([(3, b), (3, far), (8, None), (8, None), (9, " ")], key=str)
    assert minhash.one_of_each(df.where("false")).count() == 0
    lonely = df.where("doc_id is null")
    assert sorted(r["text"] for r in minhash.one_of_each(lonely.union(lonely)).collect()) == sorted([a, far + " y"])
