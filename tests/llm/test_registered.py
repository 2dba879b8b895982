"""The registered queries themselves, with their own parameters, against plain versions."""

import hashlib
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from wellspan.llm.queries import QUERIES, tokenizer_path

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


def read(name, folder=FOLDER):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def size(text):
    return len((text or "").encode().split())


def test_op2(spark):
    x = {r["vec_id"]: np.array(r["embedding"], float) for r in read("embeddings")}
    by = defaultdict(list)
    for r in QUERIES["op2_cross_polytope"](spark, FOLDER).collect():
        by[r["query_id"]].append(r)
    ids, v = np.array(sorted(x)), np.array([x[i] for i in sorted(x)])
    hits = 0
    assert set(by) == {i for i in x if i % 20 == 0}
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        score = v @ x[q]
        score[ids == q] = -np.inf
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert all(abs(r["score"] - float(x[q] @ x[r["vec_id"]])) < 1e-12 for r in rows)
        assert [(-r["score"], r["vec_id"]) for r in rows] == sorted((-r["score"], r["vec_id"]) for r in rows)
        hits += len({r["vec_id"] for r in rows} & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(by)


def test_op4(spark):
    docs = read("documents")
    got = {r["doc_id"]: r for r in QUERIES["op4_source_mix"](spark, FOLDER).collect()}
    assert set(got) == {d["doc_id"] for d in docs}
    sizes, taken, target, names = defaultdict(int), defaultdict(int), {}, {}
    for d in docs:
        r = got[d["doc_id"]]
        assert r["size"] == size(d["text"]) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[d["source"]] += r["size"]
        taken[d["source"]] += r["taken"]
        target[d["source"]], names[d["source"]] = r["target"], r["source_size"]
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want, full, total = {}, set(), sum(sizes.values())
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    while True:  # shares by weight; the excess over three times a size is shared anew
        rest = total - sum(3 * sizes[s] for s in full)
        want = {s: 3 * sizes[s] if s in full else weight[s] * rest / sum(weight[x] for x in order if x not in full) for s in order}
        over = {s for s in order if want[s] > 3 * sizes[s] + 1e-9}
        if not over:
            break
        full |= over
    for s in order:
        assert names[s] == sizes[s] and target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= max(64, 0.02 * want[s])


def test_op6(spark):
    labels = {r["doc_id"]: r["toxic"] for r in read("labels")}
    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, FOLDER).collect()}
    assert set(got) == {r["doc_id"] for r in read("documents")}
    hits = made = asked = 0
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1
        if r["held_out"] and labels.get(d) is not None:
            hits, made, asked = hits + (r["predicted"] and labels[d]), made + r["predicted"], asked + labels[d]
    assert hits >= 0.9 * made and hits >= 0.6 * asked


def test_op6_reads_no_held_out_labels(spark, tmp_path):
    tables = {n: spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels")}
    tables["documents"].write.parquet(f"{tmp_path}/documents.parquet")
    tables["labels"].selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    scores = lambda folder: {r["doc_id"]: r["score"] for r in QUERIES["op6_toxicity"](spark, folder).collect()}
    assert scores(str(tmp_path)) == scores(SMALL)


def test_op7(spark):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path())
    reference.no_padding()
    reference.no_truncation()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: r for r in QUERIES["op7_bpe"](spark, FOLDER).collect()}
    docs = read("documents")
    assert len(got) == len(docs)
    for d in docs:
        ids = reference.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(reference.decode(ids, skip_special_tokens=False)))


def test_op8(spark):
    from llm_brute import components

    texts = {r["doc_id"]: r["text"] or "" for r in read("documents")}
    want = components(texts, 3, 85, 100)
    got = {r["doc_id"]: r for r in QUERIES["op8_minhash"](spark, FOLDER).collect()}
    for d, t in texts.items():
        w = t.encode().lower().split()
        n = len({tuple(w[i : i + 3]) for i in range(len(w) - 2)}) or int(bool(w))
        assert (got[d]["component_id"], got[d]["kept"], got[d]["n_shingles"]) == (want[d], want[d] == d, n)


def test_op9(spark):
    from test_edges import brute_spans

    got = {r["doc_id"]: r for r in QUERIES["op9_skip_chain_pii"](spark, FOLDER).collect()}
    docs = read("documents")
    assert len(got) == len(docs)
    for d in docs:
        r, base = got[d["doc_id"]], brute_spans(d["text"] or "")
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        spans = list(filter(None, r["spans"].split(",")))
        assert set(filter(None, base.split(","))) <= set(spans)
        kinds = ["email", "ip", "card", "phone"]
        key = [(kinds.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in spans)]
        assert key == sorted(key) and all(0 <= a < b <= len(d["text"]) for _, a, b in key)
        assert [r[f"n_{k}"] for k in kinds] == [len(re.findall(rf"\b{k}:", base)) for k in kinds]


def test_op10(spark):
    from test_edges import brute_quality

    got = {r["doc_id"]: r for r in QUERIES["op10_adaptive_quality"](spark, FOLDER).collect()}
    docs = read("documents")
    assert len(got) == len(docs)
    for d in docs:
        r, (n, chars, symbols, dup, rep) = got[d["doc_id"]], brute_quality(d["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        assert r["base_failed"] == (n < 20 or 100 * rep > 30 * n) and not (r["base_failed"] and r["kept"])
    assert sum(r["kept"] for r in got.values()) > 0.85 * sum(not r["base_failed"] for r in got.values())
