"""Exact dedup, prefix tries and resampling on small tables, against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspan.llm import exact, resample, trie

DOCS = "doc_id long, text string, lang string"
LONG = "Word " * 30_000


def lower(t):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), t or "")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "xx") for i, t in rows], DOCS).repartition(3)


def documents(seed=0, n=400):
    """A group that holds a third of the rows, small groups, singles, nulls, repeats and ties."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        kind = r.randrange(6)
        text = "the Same TEXT" if kind < 2 else f"copy {r.randrange(60)}" if kind == 2 else None if kind == 3 and i % 7 == 0 else "" if kind == 3 and i % 5 == 0 else f"single {i}"
        rows.append((i, text))
    return rows + [(3, rows[3][1]), (3, rows[3][1]), (None, "the same text"), (None, "nobody"), (None, "nobody"), (n, LONG), (n + 1, LONG.upper()), (n + 2, "ÉTÉ"), (n + 3, "été")]


@pytest.mark.parametrize("most_bits", [exact.MOST_SEGMENT_BITS, 0])
def test_exact_dedup(spark, monkeypatch, most_bits):
    monkeypatch.setattr(exact, "CELLS", 16 if most_bits else 1 << 10)  # several ranges of hashes
    monkeypatch.setattr(exact, "HOT_LEAST", 20)
    rows = documents()
    clash = frame(spark, rows).withColumns({c: F.lit("x") for c in ("kept", "spot", "cells", "segment", "row", "words", "top", "possible", "carried", "group_size")})
    got = exact.judged(clash, ("doc_id", "lang", "spot", "row", "words", "kept"), most_bits).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    kept = Counter()
    by = {hashlib.sha256(t.encode()).hexdigest(): (t, ids) for t, ids in groups.items()}
    for r in got:
        t, ids = by[r["text_sha256"]]
        best = max(ids, key=lambda i: (i is not None, i or 0))
        assert r["keep_id"] == best and r["group_size"] == len(ids) and (r["lang"], r["spot"], r["row"]) == ("xx", "x", "x")
        assert not r["kept"] or r["doc_id"] == best
        kept[t] += r["kept"]
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert Counter((r["doc_id"], r["text_sha256"]) for r in got) == Counter((i, hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows)


def test_exact_dedup_of_nothing(spark):
    assert exact.judged(frame(spark, [])).collect() == []
    one = exact.judged(frame(spark, [(1, None)]), ()).collect()
    assert [tuple(r) for r in one] == [(1, 1, True, hashlib.sha256(b"").hexdigest())]


def test_few_singles_are_possible(spark):
    """Only rows that may repeat go on to the grouping: all that do, and few others."""
    texts = frame(spark, [(i, f"text {i if i > 300 else i // 2}") for i in range(6000)])
    digests = texts.select("doc_id", exact.text_sha256().alias("text_sha256")).withColumns({"spot": F.xxhash64("text_sha256"), "cells": F.xxhash64(F.lit("cells"), "text_sha256")})
    (rows,) = exact.flagged(digests, 6000)
    possible = {r["doc_id"] for r in rows.where("possible").collect()}
    assert set(range(300)) <= possible and len(possible) < 300 + 0.01 * 6000


def plain_nodes(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns[c].append(((t is not None, t or 0, hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest()), (r, x)))
    own = {c: [x for _, x in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
    members, kids, leaves, saved, out = defaultdict(list), defaultdict(list), {}, {}, []
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[x] for x in kids[k])
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("most", [1 << 16, 40, 6])
def test_prefix_nodes(spark, most):
    """A third of the conversations are equal, all begin alike; shards of 6 nodes need several levels."""
    r = random.Random(1)
    rows = []
    for c in range(1200):
        texts = ["same", "turn", "again"] if c % 3 == 0 else ["same", *(r.choice(["a", "b b", "c"]) for _ in range(r.randrange(6)))]
        rows += [(c, i, "user", x) for i, x in enumerate(texts)][: r.choice([1, 9])]
    rows += [(7, 2, "user", "tie"), (7, 2, "user", "tie"), (9, None, None, None), (None, 1, "u", "x"), (-7, 0, None, None), (-20, 0, "u", "q"), (5000, 0, "u", LONG), (6020, 0, "a", "b:c"), (6040, 0, "a:b", "c")]
    rows += [(7000, i, "u", str(i)) for i in range(200)]
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5).withColumns({c: F.lit("x") for c in ("path", "family", "shard", "origin", "h")})
    assert sorted(repr(tuple(x)) for x in trie.prefix_nodes(df, most).collect()) == plain_nodes(rows)


def test_prefix_nodes_of_nothing(spark):
    none = spark.createDataFrame([(None, 1, "u", "x")], CONVERSATIONS)
    assert trie.prefix_nodes(none).collect() == [] and trie.prefix_nodes(none.where("false")).collect() == []
    assert len(trie.prefix_nodes(spark.createDataFrame([(3, 0, "u", "x")], CONVERSATIONS)).collect()) in (1, 2)


def test_louds_gives_back_the_trie():
    paths = sorted(b"".join(bytes([x]) * trie.LABEL for x in p) for p in [b"", b"a", b"ab", b"abc", b"b", b"bca", b"bcb", b"d"])
    zero = {c: np.zeros(len(paths), np.int64) for c in ("convs", "low", "children", "leaves", "saved")}
    t = trie.grown(paths, None, zero, [trie.NOTHING] * len(paths))
    bits = "".join("1" if b else "0" for b in t.louds)
    assert bits == "1110" + "10" + "10" + "0" + "10" + "110" + "0" + "0" + "0"
    for i, p in enumerate(paths):
        assert t.labels[t.path(i, t.parents)[1:]].tobytes() == p


def features(t):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_resampling(docs, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([x for _, x in docs], target))
    size, goal = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (size + 10_000) / ((s[b] + 1) * (goal + 10_000))))
    out = []
    for i, x in docs:
        words, found = features(x)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    for rank, x in enumerate(able[: 25 * len(able) // 100], 1):
        x[5] = rank
    return sorted(map(repr, map(tuple, out)))


def test_resampling(spark):
    r = random.Random(4)
    vocabulary = ["Alpha", "beta", "x1", "été", "日本", "y" * 70, "z" * 200, "a-b", "q_r", "ÀB"] + [f"w{k}" for k in range(40)]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 2, 25, 60])))) for i in range(300)]
    docs += [(None, " ".join(vocabulary)), (400, None), (401, ""), (402, LONG), (403, "\x7f{}" * 30), (404, "x" * 50_000 + " é" * 30), (405, docs[5][1])]
    target = [" ".join(r.choice(vocabulary[:9]) for _ in range(30)) for _ in range(40)] + [None, ""]
    table = spark.createDataFrame(target, "string").withColumnRenamed("value", "text")
    clash = frame(spark, docs).withColumns({c: F.lit("x") for c in ("n_words", "score", "rank", "above", "bucket", "c0", "c1", "weight")})
    got = resample.resampled(clash, table, ("doc_id", "lang", "c0", "bucket")).collect()
    assert sorted(repr(tuple(r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank"))) for r in got) == plain_resampling(docs, target)
    assert {(r["lang"], r["c0"], r["bucket"]) for r in got} == {("xx", "x", "x")}


def test_resampling_without_rows(spark):
    none = spark.createDataFrame([], "text string")
    assert resample.resampled(frame(spark, []), none).collect() == []
    few = [(i, "a b c " * 10 if i < 3 else "short") for i in range(6)]
    got = resample.resampled(frame(spark, few), none).collect()
    assert sorted(repr(tuple(r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank"))) for r in got) == plain_resampling(few, [])


def test_buckets_are_crcs():
    texts = ["Hello WORLD é ü-3a, x " + "y" * 300 + " b b", "", "one", "a b", "z" * 64 + " " + "z" * 65]
    buckets, n = resample.buckets_of(t.encode() for t in texts)
    want = [sorted(zlib.crc32(f.encode()) % 10_000 for f in features(t)[1]) for t in texts]
    at = np.cumsum([0, *(len(w) for w in want)])
    assert [sorted(buckets[a:b].tolist()) for a, b in zip(at, at[1:])] == want and n.tolist() == [len(features(t)[0]) for t in texts]
