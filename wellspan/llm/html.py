"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass looks at one block at a time:
its length, its share of characters inside links and its share of stop words make it good,
bad or undecided, the same inside and outside of marked sections.  Sections are two further
features: one marked as surroundings (reader comments are good prose and have no other sign)
makes a block bad, and one marked as the article leaves a block without stop words undecided.
The second pass gives undecided blocks the label of their nearest decided neighbours.
"""

from __future__ import annotations

import html
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import beside

#: Elements that begin and end a block (fixed values of the HTML standard).
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is never text of a page.
HIDDEN = frozenset("script style noscript template textarea select button svg math iframe object canvas audio video title head".split())
#: Hidden elements whose content is raw text up to their own end tag.
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Sections around the article.
BOILERPLATE = frozenset("nav header footer aside form menu dialog search".split())
MAIN = frozenset(["article", "main"])
#: Parts of class names, ids and roles that tell of sections around the article.
AROUND = regex.compile(
    r"(?<![a-z])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|menu\w*|nav\w*|breadcrumbs?|foot\w*|masthead|topbar|toolbar|sidebars?|side-?bar|widget\w*|"
    r"comments?|commentlist|respond|disqus|replies|cookies?\w*|consent|gdpr|notices?|notification\w*|alerts?|popups?|modal|overlay|newsletter|subscri\w*|signup|login|"
    r"search\w*|social\w*|share|sharing|related|recommend\w*|pagination|pager|copyright|legal|disclaimer|skip-?link|contentinfo|complementary|navigation|form)(?![a-z])"
)
#: Frequent short words of the four languages at hand.
STOP_WORDS = frozenset(
    "a about all also an and are as at be been but by can for from had has have he her his i if in into is it its more no not of on one or our out she so some than that the "
    "their them there they this to up was we were what when which who will with would you your "
    "au aux avec ce ces cette dans de des du elle en est et il ils la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "als am an auf aus bei das dass dem den der des die du ein eine einem einen einer er es für hat ich im in ist kann man mit nach nicht noch nur oder sein sich sie sind so "
    "über um und uns unter vom von vor war wenn wie wir wird zu zum zur "
    "al como con del el ella en entre era es esta este fue ha hay la las lo los más me mi muy no o para pero por que se ser si sin sobre su sus también todo un una y ya".split()
)
LONGEST_LINKED = 0.4
SHORT_CHARS, LONG_CHARS = 70, 200
FEW_STOPS, MANY_STOPS = 0.12, 0.22

_token = regex.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", regex.S)
_mark = regex.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", regex.I)
_hide = regex.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", regex.I)
_word = regex.compile(r"[^\W_]+")


@dataclass
class Block:
    text: str
    linked: int
    around: bool
    #: Number of the marked article that it stands in; 0 outside.
    inside: int
    heading: bool
    label: str = ""
    #: What decided: a name for reports and tests.
    rule: str = ""


def blocks(page: str) -> Iterator[Block]:
    """Blocks with text, in page order."""
    open_: list[tuple[str, bool, bool, bool]] = []  # name, around, main, hidden
    around = main = hidden = link = regions = 0
    count: Counter[str] = Counter()  # of names in open_, so that an end tag without its start costs nothing
    held: list[tuple[str, bool]] = []
    breaks, heading = 0, False
    at, end = 0, len(page)

    def flush() -> Iterator[Block]:
        nonlocal heading
        if held:
            text = " ".join(html.unescape("".join(x for x, _ in held)).split())
            linked = sum(len(" ".join(html.unescape(x).split())) for x, inside in held if inside)
            held.clear()
            if text:
                yield Block(text, linked, around > 0, regions if main > 0 else 0, heading)
        heading = False

    def close(i: int) -> None:
        nonlocal around, main, hidden
        for x, a, m, h in open_[i:]:
            count[x] -= 1
            around, main, hidden = around - a, main - m, hidden - h
        del open_[i:]

    while at < end:
        found = _token.search(page, at)
        if found is None or found.start() > at:
            piece = page[at : found.start() if found else end]
            if not hidden:
                held.append((piece, link > 0))
                breaks = 0 if piece.strip() else breaks
        if found is None:
            break
        at, name, closing = found.end(), (found[2] or "").lower(), bool(found[1])
        if not name:
            continue
        if name == "br":
            breaks += 1
            if breaks > 1:
                yield from flush()
            elif not hidden:
                held.append((" ", link > 0))
            continue
        if name == "a":
            link = 0 if closing else 1
            continue
        if name in BLOCKS:
            link, breaks = 0, 0
            yield from flush()
        if closing:
            if count[name]:
                close(next(i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name))
            continue
        if name in VOID or name in ("p", "li", "dt", "dd", "option"):
            continue  # these nest nothing that matters here and are often left open
        if name not in BLOCKS and name not in HIDDEN:
            continue
        marks = " ".join(filter(None, (x for m in _mark.finditer(found[3]) for x in m.groups()))).lower() if found[3] else ""
        a = name in BOILERPLATE and not (name == "header" and main > 0 and around == 0) or bool(marks and name not in ("html", "body", "article", "main") and AROUND.search(marks))
        m = name in MAIN or "main" in marks.split()
        h = name in HIDDEN or bool(found[3] and _hide.search(found[3]))
        if name in RAW:
            stop = regex.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", regex.I).search(page, at)
            at = stop.end()
            continue
        if name == "body" and count["head"]:
            close(next(i for i, x in enumerate(open_) if x[0] == "head"))
        open_.append((name, a, m, h))
        count[name] += 1
        regions += m and main == 0
        around, main, hidden = around + a, main + m, hidden + h
        heading = heading or name in ("h1", "h2", "h3", "h4", "h5", "h6")
    yield from flush()


def first_pass(block: Block) -> tuple[str, str]:
    """good, bad, near (to good) or short, from the block alone; and the rule that says so."""
    if block.around:
        return "bad", "section"
    n = len(block.text)
    if block.linked > LONGEST_LINKED * n:
        return "bad", "links"
    if n < SHORT_CHARS:
        return ("bad", "links") if block.linked and not block.inside else ("short", "length")
    words = _word.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
    if stops >= MANY_STOPS:
        return ("good", "stop words") if n > LONG_CHARS else ("near", "stop words")
    if stops >= FEW_STOPS:
        return "near", "stop words"
    # Lists, tables and code of a marked article have few stop words.
    return ("short", "stop words") if block.inside else ("bad", "stop words")


def trusted(found: list[Block]) -> bool:
    """The marked article holds the text: it is the only one, or it outweighs what stands outside."""
    inside = outside = 0
    for b in found:
        if b.label in ("good", "near"):
            inside, outside = (inside + len(b.text), outside) if b.inside else (inside, outside + len(b.text))
    return len({b.inside for b in found if b.inside}) == 1 and inside > 0 or inside >= outside


def second_pass(found: list[Block]) -> None:
    """Undecided blocks inherit from their nearest decided neighbours.

    Between two good neighbours a block is good, between two bad ones bad.  Between a good
    and a bad one a near-good block, a heading close before the good one and a block of a
    marked article are good; others follow the nearer one, and are bad if both are equally near.
    The ends of a page count as bad.  Blocks of a marked article look at each other only.
    """

    def nearest(order: list[Block]) -> list[tuple[str, int]]:
        last = {True: ("", -1), False: ("bad", -1)}
        seen = []
        for i, b in enumerate(order):
            label, at = last[b.inside > 0]
            seen.append((label, i - at))
            if b.label in ("good", "bad"):
                last[b.inside > 0] = last[False] = (b.label, i)
        return seen

    before, after = nearest(found), nearest(found[::-1])[::-1]
    for b, (x, left), (y, right) in zip(found, before, after):
        if b.label not in ("short", "near"):
            continue
        # Without a decided neighbour in its article, the mark alone speaks for the block.
        x, y = x or "good", y or "good"
        good = x == "good"
        if x != y:
            good = b.label == "near" or b.inside > 0 or b.heading and y == "good" and right <= 4 or (left < right if good else right < left)
        b.label, b.rule = "good" if good else "bad", "neighbours"


def labelled(page: str) -> list[Block]:
    """All blocks of a page with their labels, good or bad."""
    found = list(blocks(page))
    for b in found:
        b.label, b.rule = first_pass(b)
    if any(b.inside for b in found):
        if trusted(found):
            for b in found:
                if not b.inside and b.label != "bad":
                    b.label, b.rule = "bad", "beside the article"
        else:
            for b in found:
                if b.inside:  # a card that leads elsewhere, unless it is long
                    b.inside = 0
                    b.label, b.rule = first_pass(b)
                    if b.label == "short":
                        b.label, b.rule = "bad", "card"
    second_pass(found)
    return found


def main_text(page: str) -> str:
    return "\n".join([b.text for b in labelled(page) if b.label == "good"])


def extract(pages: DataFrame, keep: list[str], html_column: str = "html") -> DataFrame:
    """``keep``, ``text`` (empty if none) and ``n_chars`` (its code points) of every page.

    The whole html is read; null is the empty page.  Rows are independent: no shuffle, ties
    and repeated rows need no rule, and columns not in ``keep`` are not looked at.
    """
    keep = beside(keep, ("text", "n_chars"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema), "text string, n_chars bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py() or "") for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return pages.select(*keep, pages[html_column].alias("__html")).mapInArrow(run, schema)
