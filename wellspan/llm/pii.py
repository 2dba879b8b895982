"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans.  The field then labels the tokens that look like data (they
hold a digit or an @, or are the local part of an address of the text): neighbouring tokens
share transition potentials, and all mentions of one thing share an agreement potential with
one hub, however many they are and however far apart they stand.  Mentions are the same thing
by their last nine or seven digits, by the local part of an address, or else by equal letters
and digits.  A hub that a base span belongs to is observed, so that its evidence reaches every
mention in two steps, such as a telephone number repeated without its prefix.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
#: Documents, and distinct token contexts in them, that the field is fitted on at most.
MOST_SAMPLED, MOST_CONTEXTS = 4_000, 50_000
#: A further span needs this marginal in every token.
SURE = 0.9
#: Messages are passed until none moves by more than CLOSE; ROUNDS only ends what oscillates.
ROUNDS, DAMPING, CLOSE = 2_000, 0.5, 1e-4
#: Adjacent tokens that are tried as one number, and digits of telephone numbers.
MOST_JOINED, LEAST_DIGITS, MOST_DIGITS = 6, 7, 15

# The four patterns, written so that a failed start is never tried twice on one run.
_local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_hint = re.compile(r"[0-9@]")
_token = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_word = re.compile(r"[^\x20\x09-\x0D]+")
_letter = re.compile(r"[^\W\d_]")
_after = re.compile(r"[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)")
_edge = re.compile(r"^[^0-9A-Za-z(+]+|[^0-9A-Za-z)]+$")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start; end is exclusive."""
    found: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        m = _domain.match(text, at + 1)
        start = at
        if m:
            while start > last and text[start - 1] in _local:
                start -= 1
        if m and start < at:
            found.append((0, start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _ip.finditer(text):
        parts = m[0].split(".")
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in parts):
            found.append((1, m.start(), m.end()))
    for m in _card.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _phone.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def written(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for k, a, b in spans])


def shape(token: str) -> str:
    """Letters as a, runs of digits as their length, other signs kept."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"<{len(m[0])}>", token))


def kind_of(token: str | None) -> str:
    if not token:
        return "none"
    letters, digits = any(c.isalpha() for c in token), any("0" <= c <= "9" for c in token)
    return ("mixed" if letters and digits else "letters" if letters else "digits" if digits else "signs") + ("+" if token[-1] in ".,;:!?" else "")


def word_before(text: str, at: int) -> str | None:
    """The whole word that ends before ``at``."""
    width = 40
    while True:
        start = max(0, at - width)
        words = text[start:at].split()
        if start == 0 or len(words) > 1 or (words and text[start].isspace()):
            return words[-1] if words else None
        width *= 4


def number_keys(digits: str) -> list[str]:
    """Keys of a number, the most telling first: written with and without a prefix it shares one."""
    if len(digits) > MOST_DIGITS:
        return [f"n{digits}"]
    if len(digits) >= 9:
        return [f"n{digits[-9:]}", f"s{digits[-7:]}"]
    return [f"s{digits[-7:]}"] if len(digits) >= LEAST_DIGITS else []


def only_digits(token: str) -> str:
    return "".join([c for c in token if "0" <= c <= "9"])


def local_key(local: str) -> list[str]:
    """Key of an address by its local part; one plain word could be any word and has none."""
    local = local.lower().strip("._%+-")
    return [f"@{local}"] if re.search(r"[0-9._%+-]", local) and re.search(r"[a-z]", local) and len(local) >= 4 else []


def entity_keys(token: str) -> list[str]:
    """Tokens that share a key are mentions of the same thing."""
    bare = token.strip("\"'`.,;:!?()[]{}<>")
    if "@" in bare:
        return local_key(bare.split("@")[0])
    plain = re.sub(r"[\W_]+", "", token).lower()
    keys = number_keys(plain) if plain.isascii() and plain.isdigit() else []
    return keys or local_key(bare) + ([f"={plain}"] if len(plain) >= 6 else [])


def span_keys(text: str, span: Span) -> list[str]:
    k, a, b = span
    if KINDS[k] == "email":
        return local_key(text[a : text.rindex("@", a, b)])
    return number_keys(only_digits(text[a:b])) if KINDS[k] in ("card", "phone") else [f"={text[a:b]}"]


@dataclass
class Tokens:
    """Candidate tokens of a text, their features, base labels and edges."""

    spans: list[tuple[int, int]]
    features: list[tuple[str, ...]]
    base: list[int]
    chain: list[tuple[int, int]]
    #: Label of the observed hub, -1 without one; what other mentions say, for base tokens.
    seen: list[int]
    #: Tokens that are a mention by themselves, not as a part of a number.
    whole: list[bool]
    #: Mentions of each hub that is not observed.
    hubs: list[list[int]]


def described(token: str, before: str | None, after: str | None) -> tuple[str, ...]:
    number = only_digits(token)
    digits = len(number)
    return ("bias", "shape " + shape(token), f"digits {digits}", f"at {'@' in token}", f"card {13 <= digits <= 19 and luhn(number)}", "before " + kind_of(before), "after " + kind_of(after))


def candidates(text: str, locals_: set[str]) -> Iterator[tuple[int, int]]:
    """Tokens with a digit or an @; and words that are the local part of an address of the text."""
    if all(_hint.search(x[1:]) for x in locals_):
        yield from (m.span() for m in _token.finditer(text))
        return
    for m in _word.finditer(text):
        if _hint.search(m[0]) or not locals_.isdisjoint(local_key(m[0].strip("\"'`.,;:!?()[]{}<>"))):
            yield m.span()


def tokens_of(text: str, base: list[Span]) -> Tokens:
    spans, features, labels, chain = [], [], [], []
    cover = sorted((a, b, k, i) for i, (k, a, b) in enumerate(base))
    evidence: dict[str, dict[int, int]] = {}  # key: base span: kind
    keys_of = [span_keys(text, x) for x in base]
    reach = 0
    for a, b, k, i in sorted(cover, key=lambda x: (x[0], -x[1])):
        if b > reach:  # a span inside another, such as a card in a telephone number, says nothing of its own
            reach = b
            for key in keys_of[i]:
                evidence.setdefault(key, {})[i] = k + 1
    c, owner = 0, []
    for i, (a, b) in enumerate(candidates(text, {k for k in evidence if k[0] == "@"})):
        while c < len(cover) and cover[c][1] <= a:
            c += 1
        k, x = 0, -1
        for p, q, kind, owned in islice(cover, c, None):
            if p >= b:
                break
            if a < q:
                k, x = kind + 1, owned
                break
        labels.append(k)
        owner.append(x)
        follow = _after.match(text, b)
        features.append(described(text[a:b], word_before(text, a), follow[1] if follow else None))
        if spans and text[spans[-1][1] : a].strip(" \t\n\x0b\x0c\r") == "":
            chain.append((i - 1, i))
        spans.append((a, b))
    n = len(spans)
    seen, whole, members = [-1] * n, [False] * n, {}

    def said(keys: list[str], but: int = -1) -> int:
        """Label of the first base span, other than ``but``, that shares a key."""
        for key in keys:
            for i, k in evidence.get(key, {}).items():
                if i != but:
                    return k
        return -1

    for i, (a, b) in enumerate(spans):
        if labels[i]:
            seen[i] = said(keys_of[owner[i]], owner[i])
            continue
        keys = entity_keys(text[a:b])
        seen[i] = said(keys)
        whole[i] = seen[i] > 0
        if keys and not whole[i]:
            members.setdefault(keys[0], []).append(i)
    # Numbers written in several tokens, held against the numbers of base spans.
    if any(k[0] in "ns" for k in evidence):
        joined = {j for _, j in chain}
        digits = ["" if labels[i] or _letter.search(text, a, b) else only_digits(text[a:b]) for i, (a, b) in enumerate(spans)]
        for i in range(n):
            run = digits[i]
            for j in range(i + 1, min(n, i + MOST_JOINED) if run else 0):
                if j not in joined or not digits[j] or len(run) > MOST_DIGITS:
                    break
                run += digits[j]
                # The key has to reach into the first token, else that one is no part of the number.
                k = said([x for x in number_keys(run) if len(run) - len(digits[i]) < len(x) - 1])
                if k > 0:
                    seen[i : j + 1], whole[i : j + 1] = [k] * (j + 1 - i), [False] * (j + 1 - i)
    hubs = [kept for x in members.values() if len(kept := [i for i in x if seen[i] < 0]) > 1]
    return Tokens(spans, features, labels, chain, seen, whole, hubs)


@dataclass(frozen=True)
class Field:
    """Weights: features by label, transitions, and agreement of mentions with their hub."""

    names: dict[str, int]
    node: np.ndarray
    step: np.ndarray
    agree: np.ndarray

    def further(self, text: str, base: list[Span]) -> list[Span]:
        """Spans that the field adds to ``base``."""
        found = tokens_of(text, base)
        if not any(not y for y in found.base):
            return []
        marginal = self.marginals(found)
        best = marginal.argmax(axis=1)
        sure = marginal[np.arange(len(best)), best] >= SURE
        out: list[Span] = []
        joined = {b for _, b in found.chain}
        for i, (a, b) in enumerate(found.spans):
            if found.base[i] or not best[i] or not sure[i]:
                continue
            lead = _edge.match(text[a:b])
            a += lead.end() if lead and lead.start() == 0 else 0
            tail = re.search(r"[^0-9A-Za-z)]+$", text[a:b])
            b -= len(tail[0]) if tail else 0
            if a >= b:
                continue
            k = int(best[i]) - 1
            if out and out[-1][0] == k and i in joined and out[-1][2] >= found.spans[i - 1][0] and not (found.base[i - 1] or found.whole[i - 1] or found.whole[i]):
                out[-1] = (k, out[-1][1], b)
            else:
                out.append((k, a, b))
        taken = [(x, y) for _, x, y in base]
        return [s for s in out if not any(x < s[2] and s[1] < y for x, y in taken)]

    def marginals(self, found: Tokens) -> np.ndarray:
        """Sum-product over tokens and hubs; base labels and the hubs of base spans are clamped."""
        n, labels = len(found.spans), len(LABELS)
        logits = np.zeros((n, labels))
        for i, fs in enumerate(found.features):
            logits[i] = self.node[[self.names[f] for f in fs if f in self.names]].sum(axis=0)
        for i, (y, k) in enumerate(zip(found.base, found.seen)):
            if y:
                logits[i] = -50.0
                logits[i, y] = 0.0
            elif k > 0:
                logits[i, k] += self.agree[k]
        logits = np.concatenate([logits, np.zeros((len(found.hubs), labels))])
        unary = np.exp(logits - logits.max(axis=1, keepdims=True))
        # Without a base span, a hub speaks for all labels alike: repeats alone make nothing personal.
        spokes = [(i, n + h) for h, members in enumerate(found.hubs) for i in members]
        edges = [*found.chain, *spokes]
        if not edges:
            return unary / unary.sum(axis=1, keepdims=True)
        left, right = np.array(edges).T
        pair = np.exp(np.concatenate([np.repeat(self.step[None], len(found.chain), 0), np.repeat((self.agree.min() * np.eye(labels))[None], len(spokes), 0)]))
        source, target = np.concatenate([left, right]), np.concatenate([right, left])
        table = np.concatenate([pair, pair.transpose(0, 2, 1)])
        m = len(edges)
        reverse = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
        message = np.full((2 * m, labels), 1.0 / labels)
        for _ in range(ROUNDS):
            total = np.log(unary + 1e-300)
            np.add.at(total, target, np.log(message + 1e-300))
            out = total[source] - np.log(message[reverse] + 1e-300)
            new = np.einsum("ea,eab->eb", np.exp(out - out.max(axis=1, keepdims=True)), table)
            new /= new.sum(axis=1, keepdims=True)
            moved = np.abs(new - message).max()
            message = DAMPING * message + (1 - DAMPING) * new
            if moved < CLOSE:
                break
        belief = np.log(unary + 1e-300)
        np.add.at(belief, target, np.log(message + 1e-300))
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return (belief / belief.sum(axis=1, keepdims=True))[:n]


def short_forms(span: str, kind: str) -> list[str]:
    """Tokens by which a thing is mentioned again: an address without its domain, a number without its prefix."""
    if kind == "email":
        local = span[: span.rindex("@")]
        return [local] if local_key(local) else []
    if kind != "phone":
        return []
    digits = only_digits(span)
    return [x for n in (1, 2, 3) if len(x := digits[n:]) >= LEAST_DIGITS] + span.split()[1:]


def fit(docs: DataFrame, steps: int = 200, ridge: float = 1e-3) -> Field:
    """Pseudo-likelihood fit on the base spans of at most MOST_SAMPLED documents.

    Spark counts the distinct (features, label, neighbours' labels) contexts of the sample;
    the driver gets MOST_CONTEXTS at most, those with a label and then the most frequent.  A token without a pattern
    that shares a key with a base span has no known label and is left out.  How far mentions
    agree with their hub is learned from short forms of the base spans: linked, they are what
    the span is; alone, they are nothing.
    """
    few = docs.where("doc_id is not null").where(F.col("text").rlike("[0-9@]")).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_SAMPLED)
    sample = docs.join(F.broadcast(few), "doc_id", "left_semi").select("text")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for x in batch.column(0):
                text = x.as_py() or ""
                found = tokens_of(text, base_spans(text))
                around = [[0, 0, k] for k in found.seen]
                for i, j in found.chain:
                    around[i][1], around[j][0] = found.base[j], found.base[i]
                for members in found.hubs:
                    for i in members:
                        around[i][2] = 0
                rows += [("\n".join(f), y, *a) for f, y, a in zip(found.features, found.base, around) if y or a[2] <= 0]
                for k, a, b in base_spans(text):
                    follow = _after.match(text, b)
                    for short in short_forms(text[a:b], KINDS[k]):
                        form = "\n".join(described(short, word_before(text, a), follow[1] if follow else None))
                        rows += [(form, k + 1, 0, 0, k + 1), (form, 0, 0, 0, -1)]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int32()) for c in columns[1:])], names=["f", "y", "p", "n", "s"])

    counted = sample.mapInArrow(contexts, "f string, y int, p int, n int, s int").groupBy("f", "y", "p", "n", "s").agg(F.count(F.lit(1)).alias("times"))
    # Contexts that have a label come first, so that the bound costs only plain ones.
    rows = counted.orderBy(F.desc(F.col("y") > 0), F.desc("times"), "f", "y", "p", "n", "s").limit(MOST_CONTEXTS).collect()
    k = len(LABELS)
    names: dict[str, int] = {}
    for r in rows:
        for f in r["f"].split("\n"):
            names.setdefault(f, len(names))
    node, step, agree = np.zeros((len(names), k)), np.zeros((k, k)), np.zeros(k)
    if not rows:
        return Field(names, node, step, agree)
    which = np.array([[names[f] for f in r["f"].split("\n")] for r in rows])
    y, p, n, s = (np.array([r[c] for r in rows]) for c in "ypns")
    weight = np.array([r["times"] for r in rows], float)
    weight /= weight.sum()
    hot = np.eye(k)[y]
    has_s = (s >= 0).astype(float)
    # Few rows have a hub: steps and ridge of the agreement are scaled to the curvature that they give.
    share = np.maximum((weight * has_s) @ np.eye(k)[s], 0.01)
    speed = [np.zeros_like(node), np.zeros_like(step), np.zeros_like(agree)]
    for _ in range(steps):
        z = node[which].sum(axis=1) + step[p] + step[:, n].T
        z += has_s[:, None] * agree * np.eye(k)[s]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        error = weight[:, None] * (z / z.sum(axis=1, keepdims=True) - hot)
        g_node = ridge * node
        np.add.at(g_node, which, error[:, None, :])
        g_step = ridge * step
        np.add.at(g_step, p, error)
        np.add.at(g_step.T, n, error)
        g_agree = ridge * share * agree + (error * has_s[:, None] * np.eye(k)[s]).sum(axis=0)
        for value, grad, v in ((node, g_node, speed[0]), (step, g_step, speed[1]), (agree, g_agree / share, speed[2])):
            v *= 0.9
            v -= 0.5 * grad
            value += v
    return Field(names, node, step, np.maximum(agree, 0.0))


def find(docs: DataFrame, field: Field, keep: list[str]) -> DataFrame:
    """``keep``, counts of base spans by kind, ``base_sha256``, ``spans`` (all) and their number.

    Whole texts are read; null is the empty text and has no spans.  Rows are independent: no
    shuffle, and ties, repeated rows and columns outside ``keep`` need no rule.
    """
    keep = beside(keep, (*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), *(f"n_{k} bigint" for k in KINDS), "base_sha256 string, spans string, n_spans bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            rows = []
            for x in batch.column(len(keep)):
                text = x.as_py() or ""
                if _hint.search(text) is None:
                    rows.append((0, 0, 0, 0, nothing, "", 0))
                    continue
                base = base_spans(text)
                everything = sorted(base + field.further(text, base))
                rows.append((*(sum(s[0] == k for s in base) for k in range(4)), hashlib.sha256(written(base).encode()).hexdigest(), written(everything), len(everything)))
            columns = list(zip(*rows)) or [()] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.string()) for c in columns[4:6]] + [pa.array(columns[6], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *arrays], names=[*keep, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"])

    return docs.select(*keep, docs["text"].alias("__text")).mapInArrow(run, schema)
