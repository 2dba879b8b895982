"""Small tables with nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspan.llm import ann, bpe, html, lines, minhash, mixing, pii, preference, quality, toxicity
from wellspan.llm.queries import tokenizer_path

LONG = "word " * 30_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, **more):
    rows = [(i, t, more.get("lang"), more.get("source", "s"), None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """Extra columns that bear the names of what operators make."""
    names = ("n_words", "kept", "score", "spans", "ids", "covered", "lines_", "size", "taken", "component_id", "bands", "offset", "n_lines")
    return df.withColumns({c: F.lit("x") for c in names})


EDGES = [None, "", " \t\n", "one", LONG, "a\nb\nc\na\nb\nc", "#*$%&|<> é", "x" * 50_000]


def test_bpe_is_the_library(spark):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path())
    reference.no_padding()
    reference.no_truncation()
    texts = [*EDGES, "It's <|endoftext|> ΑΣ 12 — ½ é", "'Ll''re 'T", "\x1c\x1fa\x85b"]
    got = {r["doc_id"]: r for r in bpe.encode_texts(clashing(docs(spark, texts)), tokenizer_path(), ["doc_id", "ids"], outputs=("ids", "n_tokens", "decoded", "ids_sha256")).collect()}
    for i, t in enumerate(texts):
        ids = reference.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == " ".join(map(str, ids)) and got[i]["n_tokens"] == len(ids)
        assert got[i]["decoded"] == reference.decode(ids, skip_special_tokens=False)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert bpe.encoder(tokenizer_path()).decode(ids) == got[i]["decoded"]
    assert bpe.encode_texts(docs(spark, []), tokenizer_path(), ["doc_id"]).count() == 0


def brute_quality(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    inside = {j for i, w in enumerate(windows) if n[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


def test_quality(spark):
    texts = [*EDGES, "a b c d e f g h " * 5, " ".join(f"w{i}" for i in range(40)), "é ü " * 30]
    got = {r["doc_id"]: r for r in quality.judged(clashing(docs(spark, texts)), ["doc_id", "n_words", "kept"]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        n_words, word_chars, n_symbols, dup, rep = brute_quality(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n_words, word_chars, n_symbols, dup, rep)
        assert r["base_failed"] == (n_words < 20 or 100 * rep > 30 * n_words) and not (r["base_failed"] and r["kept"])
    assert quality.judged(docs(spark, []), ["doc_id"]).count() == 0


def test_quality_fences(spark):
    good = [" ".join(f"word{(i * 7 + j) % 997}" for j in range(60)) for i in range(120)]
    bad = " ".join(f"{'#' * 30}w{j}" for j in range(60))
    got = {r["doc_id"]: r["kept"] for r in quality.judged(docs(spark, [*good, bad]), ["doc_id"]).collect()}
    assert all(got[i] for i in range(120)) and not got[120]


def test_quality_fences_follow_each_source(spark):
    rng = np.random.default_rng(8)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    text = lambda size, symbols: " ".join(word(size) + "#" * (rng.random() < symbols) for _ in range(200))
    rows = []
    for i in range(100):  # words of 5 letters without symbols; words of 4 to 8 with up to half of them marked
        rows += [("prose", text(5, 0.0)), ("code", text(4 + i % 5, 0.5 * i / 100))]
    odd = {"symbols": text(5, 0.4), "long": text(9, 0.0)}
    n = len(rows)
    rows += [(s, t) for t in odd.values() for s in ("prose", "code")]
    strewn = "\n".join(" | ".join(word(5) for _ in range(2 + 3 * (j % 7))) for j in range(20))  # bars, but no table
    rows += [("prose", "\n".join(f"| {word(5)} | {word(5)} |" for _ in range(60))), ("prose", strewn), ("prose", "\n".join(word(5) + "#" * (j == 7) for j in range(2_000)))]
    df = spark.createDataFrame([(i, t, "en", s, None) for i, (s, t) in enumerate(rows)], DOCS)
    got = {r["doc_id"]: r["kept"] for r in quality.judged(df, ["doc_id"]).collect()}
    assert all(got[i] for i in range(n))
    assert [got[i] for i in range(n, n + 4)] == [False, True, False, True]  # prose, code, prose, code
    assert [got[i] for i in range(n + 4, n + 7)] == [True, False, True]  # a table, bars without one, one symbol


def test_lines(spark):
    p = "first line\nsecond line\nthird line\nfourth line"
    texts = [p, "x\n" + p + "\ny", None, "", "a\nb", "\n\n\n\n\n", p + "\n" + p, LONG]
    got = {r["doc_id"]: r for r in lines.dedup_lines(clashing(docs(spark, texts))).collect()}
    assert [got[i]["text"] for i in range(8)] == [p, "x\ny", None, "", "a\nb", "\n\n\n\n\n", "", LONG]
    assert got[6]["n_removed"] == 8 and got[2]["n_lines"] == 0 and got[1]["n_lines"] == 6
    rows = [(2, "k1\nk2\nk3\nk4"), (2, p), (1, p), (None, p + "\nz"), (None, "n1\nn2\nn3"), (3, "e1\ne2\ne3"), (3, "e1\ne2\ne3"), (None, None), (None, None)]
    left = sorted(((r["doc_id"], r["text"]) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert left == sorted([(2, "k1\nk2\nk3\nk4"), (2, ""), (1, p), (None, "z"), (None, "n1\nn2\nn3"), (3, "e1\ne2\ne3"), (3, "e1\ne2\ne3"), (None, None), (None, None)], key=str)
    import duckdb

    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    assert sorted(((d, t) for d, t, _, _ in con.sql(lines.SQL).fetchall()), key=str) == left
    assert lines.dedup_lines(docs(spark, [])).count() == 0
    named = ["covered", "lines_", "doc_id_", "row_", "at_", "covered_", "Row__", "row", "hashed"]
    wide = docs(spark, texts).select("*", *(F.lit(n).alias(n) for n in named))
    out = lines.dedup_lines(wide)
    assert out.columns == [*wide.columns, "n_lines", "n_removed"]
    assert all(r[n] == n for r in out.collect() for n in named)


def test_preference(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (2, 0, None, None), (3, 0, None, None), (3, 1, "assistant", "<|x|>"), (4, 0, "user", "alone"), (None, 0, "user", "q"), (6, 0, "user", "same"), (6, 0, "user", "same"), (7, 0, "user", "same"), (-1, 0, "user", LONG)]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["pair_id"]: r for r in preference.preference_pairs(df, F.shiftright("conv_id", 1), F.col("conv_id") % 2 == 0).collect()}
    assert set(got) == {-1, 0, 1, 2, 3} and got[-1]["sides"] == "rejected" and got[-1]["rejected"].startswith("<|user|>\nword word")
    assert got[0]["n_prefix"] == 1 and got[0]["prompt"] == "<|user|>\nhi<|end|>\n" and got[0]["chosen"] == "<|assistant|>\nyes<|end|>\n"
    assert got[0]["chosen_mask"] == "-14,+11" and len(got[0]["rejected"]) == 14 + 10
    assert got[1]["chosen"] == "" and "< |x|>" in got[1]["rejected"]
    assert got[2]["sides"] == "chosen" and got[2]["rejected"] is None and got[2]["prompt"] == ""
    assert got[3]["n_prefix"] == 1 and got[3]["chosen"] != "" and got[3]["rejected"] == ""
    assert preference.preference_pairs(df.where("false"), F.shiftright("conv_id", 1), F.col("conv_id") % 2 == 0).count() == 0


def test_mixing_targets():
    sizes = np.array([1_000, 10, 0, 500])
    target = mixing.water_fill(sizes, np.array([1.0, 2.0, 3.0, 1.0]))
    assert target.sum() == pytest.approx(1510) and (target <= 3 * sizes + 1e-9).all()
    assert target[1] == 30 and target[0] == pytest.approx(740)
    slots = np.array([10_000, 3, 777])
    counts = mixing.shard_counts(slots, 7)
    assert (counts.sum(axis=0) == slots).all() and (counts >= 0).all() and (counts.sum(axis=1)[:-1] == mixing.SHARD_SLOTS).all()


def test_permutation():
    for n in (1, 2, 3, 64, 1000):
        index = np.arange(n)
        got = mixing.permuted(index, np.full(n, n), np.full(n, 9, np.uint64))
        assert sorted(got) == list(range(n))


def test_mixing(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{j}" for j in range(rng.integers(0, 400))), f"s{i % 4}", "en") for i in range(120)]
    rows += [(200, None, "s0", "en"), (201, "", "s1", "en"), (202, "lone words here", None, "en"), (5, "again the same id", "s1", "en"), (5, "again the same id", "s1", "en"), (5, "same id again the", "s1", "en"), (None, None, None, None), (None, None, None, None), (None, "", "s1", "en"), (200, None, "s0", "en"), (200, None, "s0", "en")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"))
    planned = mixing.mix(df, keep=("lang",))
    got = mixing.taken_words(planned).collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    again = mixing.taken_words(mixing.mix(df, texts=False)).collect()
    key = lambda rs: sorted((str(r["doc_id"]), r["size"], r["taken"]) for r in rs)
    assert key(got) == key(again)
    for s in {r["source_id"] for r in got}:
        own = [r for r in got if r["source_id"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 64
        assert sum(r["size"] for r in own) == own[0]["source_size"]
    pieces = mixing.mixed_texts(planned).collect()
    words = Counter()
    for r in pieces:
        words[r["doc_id"], r["source"]] += len(r["text"].split())
    taken = Counter()
    for r in got:
        taken[r["doc_id"], r["source_id"]] += r["taken"]
    assert sorted(words.values()) == sorted(v for v in taken.values() if v)
    shards = Counter(r["shard"] for r in pieces)
    assert shards and mixing.taken_words(mixing.mix(docs(spark, []))).count() == 0


def brute_components(texts, width, num, den):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("rule", [minhash.Threshold(3, 85, 100), minhash.Threshold()])
def test_minhash_against_all_pairs(spark, rule):
    rng = np.random.default_rng(3)
    texts = list(EDGES)
    for base in range(6):
        words = [f"b{base}w{i}" for i in range(150)]
        for copy in range(12):  # chains of copies that drift, and exact copies
            texts.append(" ".join(words).upper() if copy % 4 == 0 else " ".join(words))
            for at in rng.integers(0, 150, 2):
                words[at] = f"c{rng.integers(1e9)}"
    texts += ["one two", "ONE  two", "one two three"]
    expected, sizes = brute_components(texts, rule.width, rule.num, rule.den)
    got = {r["doc_id"]: r for r in minhash.near_components(clashing(docs(spark, texts)), rule).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == expected
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(got[i]["kept"] == (i == expected[i]) for i in got)


def test_minhash_empty_and_null_ids(spark):
    assert minhash.near_components(docs(spark, [])).count() == 0
    rows = [(None, "a b c d e f g", None, None, None), (4, "a b c d e f g", None, None, None), (4, "a b c d e f g", None, None, None), (9, None, None, None, None)]
    got = [(r["doc_id"], r["component_id"]) for r in minhash.near_components(spark.createDataFrame(rows, DOCS)).collect()]
    assert sorted(got, key=str) == sorted([(None, 4), (4, 4), (4, 4), (9, 9)], key=str)


def test_signature_estimate(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 4_000, np.uint64)
    for share in (0.5, 0.85, 0.95):
        n = int(4_000 * share * 2 / (1 + share))
        b = np.concatenate([a[:n], rng.integers(0, 1 << 63, 4_000 - n, np.uint64)])
        x, y = (minhash.minima(np.unique(s)) for s in (a, b))
        low = np.mean((x & 3) == (y & 3))
        assert abs((low - 0.25) / 0.75 - share) < minhash.SLACK


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 16)) * rng.uniform(0.5, 2, (400, 1))
    x[50:90] = x[50]
    rows = [(i, [float(v) for v in r], "x") for i, r in enumerate(x.astype(np.float32))]
    rows += [(400, None, "x"), (401, [0.0] * 16, "x"), (402, [float("nan")] * 16, "x"), (403, [None] + [1.0] * 15, "x"), (404, [1.0], "x"), (60, rows[60][1], "x"), (None, rows[3][1], "x"), (405, [float("inf")] * 16, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = ann.neighbours(df, df.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id")), 20).collect()
    v = np.array([r[1] for r in rows[:400]], np.float32).astype(float)
    hits = total = 0
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(range(0, 400, 20))
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, len(found) + 1))
        s = v @ v[q]
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-round(s[i], 9), i))[:20]
        hits += len({r["vec_id"] for r in found} & set(order))
        total += 20
        assert all(abs(r["score"] - s[r["vec_id"]]) < 1e-9 for r in found)
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
    assert hits / total >= 0.9
    assert ann.neighbours(df.where("false"), df.select(F.col("vec_id").alias("query_id")), 20).count() == 0
    one = ann.neighbours(df.where("vec_id in (0, 1)"), df.select(F.col("vec_id").alias("query_id")), 20)
    assert sorted((r["query_id"], r["vec_id"]) for r in one.collect()) == [(0, 1), (1, 0)]


def test_html(spark):
    article = "This is the text of an article that has been written for all of the people who like to read. " * 4
    pages = [
        None,
        "",
        "plain",
        f"<nav><a href=x>Home</a></nav><div class='ad'>Buy it now for you and me.</div><article><h1>Title &amp; more</h1><p>{article}<p>Short.<script>var a='</p>';</script></article><footer>&copy; x</footer>",
        f"<body><div><a href=1>Link one</a> <a href=2>Link two</a></div><h2>Heading</h2><div>{article}</div><p>Tail.</p><p>{article}</p><ul><li><a href=3>More</a></ul></body>",
        f"<main><p>{article}</p><section id=comments><p>{article}</p></section><form>Name</form><aside>{article}</aside></main>",
        "<p>" + "a < b &lt; c &#x41; &nbsp; d" + "<!-- hidden --></p>",
        "<article><p>unclosed <b>bold",
        "<" * 20_000,
    ]
    df = spark.createDataFrame([(i, f"u{i}", p, "x") for i, p in enumerate(pages)], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html.extract(df, ["page_id", "url", "text"]).collect()}
    body = " ".join(article.split())
    assert got[0]["text"] == got[1]["text"] == "" and got[0]["n_chars"] == 0
    assert got[3]["text"] == f"Title & more\n{body}\nShort."
    assert got[4]["text"] == f"Heading\n{body}\nTail.\n{body}"
    assert got[5]["text"] == body and got[7]["text"] == "unclosed bold"
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert next(html.blocks("<p>a < b &lt; c &#x41; &nbsp; d</p>")).text == "a < b < c A d"


@pytest.mark.parametrize("term, other", [("muslim", "christian"), ("ausländer", "einheimischer"), ("immigré", "citoyen"), ("gitano", "negro")])
def test_toxicity_swaps(spark, term, other):
    rng = np.random.default_rng(4)
    words = [f"n{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        text = list(rng.choice(words, 12))
        if toxic:
            text.append(rng.choice(["horrid", "horridly", "vilest", "vile"]))
        if rng.random() < (0.6 if toxic else 0.05):  # a group is mostly named in toxic rows
            text.append(term)
        rows.append((i, " ".join(text), None, None, None))
        labels.append((i, int(toxic)))
    neutral = " ".join([*words[:11], term])
    rows += [(600, None, None, None, None), (601, "", None, None, None), (602, LONG, None, None, None), (602, LONG, None, None, None), (None, neutral, None, None, None)]
    df, lab = clashing(spark.createDataFrame(rows, DOCS)), spark.createDataFrame([*labels, (5, None), (None, 1), (7, labels[7][1])], "doc_id long, toxic int")
    change, named = {}, {}
    for penalty in (0.0, 10.0):
        model = toxicity.fit(df, lab, penalty)
        scored = toxicity.score(df, model, ["doc_id", "score"]).collect()
        got = {r["doc_id"]: r["score"] for r in scored}
        known = toxicity._Forms(model.buckets)
        z = lambda t: float(model.weights[toxicity.places(toxicity.words_of(t), known)].sum())
        change[penalty], named[penalty] = abs(z(f"n1 n2 {term}") - z(f"n1 n2 {other}")), abs(z(neutral) - z(neutral.removesuffix(term)))
        right = np.mean([(got[i] >= 0.5) == bool(y) for i, y in labels])
        assert right > 0.9 and len(scored) == 605 and all(0 <= s <= 1 and math.isfinite(s) for s in got.values())
    # It matters less which group is named, and whether a neutral text names one at all.
    assert change[10.0] < 0.1 * change[0.0] and named[10.0] < 0.1 * named[0.0]


def test_toxicity_odd_tables(spark):
    df = docs(spark, ["a b", None, "x" * 100_000 + " horrid"])
    lab = spark.createDataFrame([(0, 0), (2, 1)], "doc_id long, toxic int")
    empty = toxicity.fit(df, lab.where("false"))
    assert {r["score"] for r in toxicity.score(df, empty, ["doc_id"]).collect()} == {1 / (1 + math.exp(20))}
    assert toxicity.score(docs(spark, []), empty, ["doc_id"]).count() == 0
    assert toxicity.score(df, toxicity.fit(df, lab), ["doc_id"]).count() == 3
    long = "q" * 60 + "horrid"
    assert len(toxicity.forms(long)) == 1 + 4 + len(long) - 3  # long words keep all their four-grams


def brute_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def test_pii(spark):
    call = "call +1 (524) 555-7373 today or (524) 555-7373 tomorrow"
    texts = [*EDGES, "a.b@c.de and x@y@z.com @a.b a@b c@d.e.f.", "1.2.3.4.5.6.7.8 256.1.1.1 01.02.003.4 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112 or 4111111111111111", call, "é 10.0.0.1 ü", "+1 2345678 9 +(1 2)", "1" * 30_000, "a" * 30_000 + "@", "@" * 2_000]
    rng = np.random.default_rng(6)
    texts += ["".join(rng.choice(list("01.@a +-()4 "), 60)) for _ in range(300)]
    df = clashing(docs(spark, texts))
    got = {r["doc_id"]: r for r in pii.find(df, pii.fit(df), ["doc_id", "spans"]).collect()}
    for i, t in enumerate(texts):
        base = brute_spans(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), t[:80]
        assert set(filter(None, base.split(","))) <= set(got[i]["spans"].split(","))
        assert sum(got[i][f"n_{k}"] for k in pii.KINDS) == len(list(filter(None, base.split(","))))
        assert not base or got[i]["spans"]
    assert pii.find(docs(spark, []), pii.fit(docs(spark, [])), ["doc_id"]).count() == 0


def test_pii_agreement():
    field = pii.Field({"bias": 0}, np.array([[1.0, 0, 0, 0, 0]]), np.zeros((5, 5)), np.full(5, 8.0))
    text = "call +1 (524) 555-7373 today or (524) 555-7373 tomorrow"
    base = pii.base_spans(text)
    added = field.further(text, base)
    assert base == [(3, 5, 22)] and added == [(3, 32, 46)] and text[32:46] == "(524) 555-7373"
    assert field.further("room 7 of 9", []) == []


def test_pii_mentions_with_a_fitted_field(spark):
    rng = np.random.default_rng(9)
    number = lambda n: "".join(map(str, rng.integers(1, 10, n)))
    texts = [f"call +{number(12)} or write to first.last{i}@mail.example.com about room {number(2)} and order {number(10)} of {number(6)} parts" for i in range(300)]
    df = docs(spark, texts)
    field = pii.fit(df)

    def added(text):
        base = pii.base_spans(text)
        return base, [(pii.KINDS[k], text[a:b]) for k, a, b in field.further(text, base)]

    assert added("call +4915112345678 now or 015112345678 later")[1] == [("phone", "015112345678")]
    assert added("call +15245557373 now or 5245557373 later")[1] == [("phone", "5245557373")]
    assert added("call +15245557373 now or (524) 555-7373 later")[1] == [("phone", "(524) 555-7373")]
    assert added("write to jane.doe@x.com, as jane.doe said")[1] == [("email", "jane.doe")]
    assert added("call +15245557373 now or order 9988776655 later, 1 of 524")[1] == []
    found = added("call +4915112345678 now" + " then 015112345678 again" * 40)[1]
    assert found == [("phone", "015112345678")] * 40
    assert not any(added(t)[1] for t in texts[:50])
