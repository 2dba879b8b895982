"""Main text of pages: the registered query against a plain reading, and what decides."""

import os
import re
import time
from collections import Counter
from html import unescape

import pyarrow.parquet as pq
import pytest

from wellspan.llm import html
from wellspan.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
PROSE = "This is the text of an article that has been written for all of the people who like to read. "


def article(page):
    """Blocks of the planted article, by a plain reading of these pages' few tags."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1|li|ul|div)\b[^>]*>", re.sub(r"<!--.*?-->|<script>.*?</script>", "", inner, flags=re.S))
    texts = [" ".join(unescape(re.sub(r"<br\s*/?>", " ", x) if x.count("<br>") else x).split()) for x in (re.sub(r"</?b>", "", p) for p in parts)]
    return [t for t in texts if t]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")
def test_query_against_a_plain_reading(spark):
    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{FOLDER}/pages.parquet").to_pylist()}
    got = {r["page_id"]: r for r in QUERIES["op5_html"](spark, FOLDER).collect()}
    assert set(got) == set(pages)
    for i, page in pages.items():
        assert got[i]["text"] == "\n".join(article(page)) and got[i]["n_chars"] == len(got[i]["text"]), i


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")
def test_rules_decide_with_and_without_marks():
    pages = [r["html"] for r in pq.read_table(f"{FOLDER}/pages.parquet").to_pylist()]
    plain = lambda p: re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)(?:article|nav|footer)\b[^>]*>", r"<\1div>", p))
    for make, least in ((lambda p: p, (1.0, 1.0)), (plain, (0.9, 0.8))):
        rules, hits, made, asked = Counter(), 0, 0, 0
        for p in pages:
            found, truth = html.labelled(make(p)), Counter(article(p))
            rules.update((b.rule, b.label) for b in found)
            got = Counter(b.text for b in found if b.label == "good")
            hits, made, asked = hits + (got & truth).total(), made + got.total(), asked + truth.total()
        # No block is good for where it stands alone: density or neighbours speak for each.
        assert {rule for rule, label in rules if label == "good"} == {"stop words", "neighbours"}
        assert rules["stop words", "good"] > 0.25 * asked
        assert hits / made >= least[0] and hits / asked >= least[1]


def test_marks_are_features_not_switches():
    cards = "".join(f"<article><h2>Card {i}</h2><p>Read more of this.</p></article>" for i in range(4))
    page = f"<body>{cards}<div><h1>Story</h1><p>{PROSE * 4}</p><p>{PROSE * 5}</p></div></body>"
    text = html.main_text(page)
    assert "Card 1" not in text and text.startswith("Story\n" + PROSE.strip())
    assert html.main_text(f"<article><p>{PROSE * 4}</p><ul><li><a href=1>Link one</a></ul><pre>x = f(y)</pre></article><div>{PROSE * 9}</div>") == f"{(PROSE * 4).strip()}\nx = f(y)"
    assert html.main_text(f"<div class='comments'><p>{PROSE * 4}</p></div>") == ""
    # A short block between a good and a bad one follows the nearer.
    assert html.main_text(f"<p>{PROSE * 4}</p><p>Near.</p><p>Middle.</p><p>Far.</p><p><a href=1>link</a></p>").endswith("Near.")


def test_unmatched_end_tags_take_linear_time():
    began = time.time()
    assert html.main_text("<div>" * 20_000 + "</span></section>" * 50_000 + "</div>" * 20_000) == ""
    assert time.time() - began < 5


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (2, None, f"<p>{PROSE * 9}"), (2, None, f"<p>{PROSE * 9}"), (None, "v", ""), (3, "w", f"<p>{PROSE * 3}" * 20_000)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), ["page_id", "url"]).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in got) == sorted([("1", 0), ("1", 0), ("2", len(PROSE) * 9 - 1), ("2", len(PROSE) * 9 - 1), ("None", 0), ("3", len(PROSE) * 60_000 - 1)])
