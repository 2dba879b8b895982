"""BPE encoding and decoding over a contiguous rank array.

A word is a row of parts and, beside it, the merge rank of every pair of neighbouring parts.
The smallest rank is found by scanning the row, its boundary is deleted and the two
neighbouring ranks are refreshed.  Words of one length are rows of one array, so a scan, a
deletion and a refresh are each one array operation for all of them.  Words are short, so
scanning is cheaper than keeping a queue; words beyond ``LONG`` parts use a heap, which gives
the same merges without the quadratic scan.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import beside

#: Unicode white space as the vocabulary's normalizer sees it (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LONG = 96
NO_RANK = 1 << 60
#: Letters and digits that Unicode 16 added, and capitals with the small letters that Unicode
#: 16 and 17 gave them (fixed values of the Unicode standard; unicodedata is older, and the
#: regex module newer than the vocabulary's library).
ADDED = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D40-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E 11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 "
    "116D0-116E3 11BC0-11BE0 11BF0-11BF9 13460-143FA 16100-1611D 16130-16139 16D40-16D6C 16D70-16D79 18CFF-18CFF 1CCF0-1CCF9 1E5D0-1E5ED 1E5F0-1E5FA"
)
CAPITALS = "1C89-1C8A A7CB-0264 A7CC-A7CD A7CE-A7CF A7D2-A7D3 A7D4-A7D5 A7DA-A7DB A7DC-019B"
#: Most distinct chunks, and characters in them, of one generation of a worker's memory.
REMEMBERED, REMEMBERED_CHARS = 120_000, 3_000_000
#: Characters of rows that are split and encoded together, and rows of one array of words.
SLICE_CHARS, WORDS_AT_ONCE = 2_000_000, 20_000

_gap = regex.compile(f"[{SPACE}]+")
_letter = regex.compile(r"[\p{L}\p{N}]")
_added = [(int(a, 16), int(b, 16)) for a, b in (x.split("-") for x in ADDED.split())]
_small = {int(a, 16): int(b, 16) for a, b in (x.split("-") for x in CAPITALS.split())}
_small |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)} | {ord("Σ"): ord("σ")}  # letters are lowered one by one
_capital = regex.compile("[" + "".join(map(chr, _small)) + "]")
#: str.split() splits on SPACE and on these, which are no white space here.
_not_gap = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class Recent(dict):
    """Character -> whether it is a letter or digit that the vocabulary's library does not know as one."""

    def __missing__(self, c: str) -> bool:
        found = unicodedata.category(c) == "Cn" and _letter.match(c) is not None and not any(a <= ord(c) <= b for a, b in _added)
        self[c] = found
        return found


class WordBpe:
    """Encoder for a tokenizer file with word ends, read once per Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end: str = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # A pair of parts is one number, as ids are below 2**31; its rank gives the part it makes.
        pairs = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order.astype(np.int64)
        self.rank = {int(p): i for i, p in enumerate(pairs)}
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.inner, self.last = (np.array([vocab[x + e] for x in byte_letters()], np.int64) for e in ("", end))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split.replace(r"\s", SPACE))
        self.recent = Recent()
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None
        self.shown = {i: str(i) for i in self.names}
        # Chunk -> (ids, decoded) in two generations: chunks that recur outlive the rest.
        self.known: dict[str, tuple[str, str]] = {}
        self.old: dict[str, tuple[str, str]] = {}
        self.chars = 0

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of neighbouring parts, NO_RANK where there is no merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NO_RANK)

    def merged(self, pieces: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct pieces; those of one length are merged together."""
        found: dict[bytes, list[int]] = {}
        by_length: dict[int, list[bytes]] = {}
        for x in pieces:
            by_length.setdefault(len(x), []).append(x)
        for length, same in by_length.items():
            for i in range(0, len(same), WORDS_AT_ONCE):
                some = same[i : i + WORDS_AT_ONCE]
                data = np.frombuffer(b"".join(some), np.uint8).reshape(-1, length)
                parts = self.inner[data]
                parts[:, -1] = self.last[data[:, -1]]
                if length > LONG:
                    found |= {x: self._parts_of_long(p) for x, p in zip(some, parts.tolist())}
                else:
                    self._merge(some, parts, found)
        return found

    def _merge(self, pieces: list[bytes], parts: np.ndarray, found: dict[bytes, list[int]]) -> None:
        """Merge rows of parts until none has a rank; each round every row left loses one boundary."""
        names = np.array(pieces, object)
        ranks = self.rank_of(parts[:, :-1], parts[:, 1:])
        while True:
            n, width = ranks.shape
            at = ranks.argmin(axis=1) if width else np.zeros(n, np.int64)
            rows = np.arange(n)
            low = ranks[rows, at] if width else np.full(n, NO_RANK)
            done = low == NO_RANK
            if done.any():
                found.update(zip(names[done].tolist(), parts[done].tolist()))
                left = ~done
                if not left.any():
                    return
                names, parts, ranks, at, low = names[left], parts[left], ranks[left], at[left], low[left]
                rows = np.arange(len(names))
            parts[rows, at] = self.made[low]
            # Columns after the deleted boundary move up by one.
            after = np.arange(width) > at[:, None]
            parts = np.where(after, parts[:, 1:], parts[:, :-1])
            ranks = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            if width > 1:
                right = at < width - 1
                ranks[rows[right], at[right]] = self.rank_of(parts[rows[right], at[right]], parts[rows[right], at[right] + 1])
                before = at > 0
                ranks[rows[before], at[before] - 1] = self.rank_of(parts[rows[before], at[before] - 1], parts[rows[before], at[before]])

    def _parts_of_long(self, parts: list[int]) -> list[int]:
        n, rank = len(parts), self.rank
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        queue = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank.get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            low, i, left, right = heapq.heappop(queue)
            j = after[i] if parts[i] == left else -1
            if j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = int(self.made[low]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := rank.get(parts[a] << 32 | parts[b])) is not None:
                    heapq.heappush(queue, (r, a, parts[a], parts[b]))
        return [x for x in parts if x >= 0]

    def pieces_of(self, chunk: str) -> list[bytes]:
        """Pieces of a text without white space, as bytes."""
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.encode()]
            return [x.encode() for x in self.pieces.findall(chunk)]
        plain = chunk
        if any(map(self.recent.__getitem__, chunk)):
            plain = "".join(["\x00" if self.recent[c] else c for c in chunk])
        return [chunk[m.start() : m.end()].encode("utf-8", "surrogatepass") for m in self.pieces.finditer(plain)]

    def chunks_of(self, text: str) -> list[str]:
        """Chunks of a stretch of text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = text.translate(_small) if _capital.search(text) else text
        text = text.lower()
        return text.split() if _not_gap.search(text) is None else [x for x in _gap.split(text) if x]

    def split(self, text: str) -> list[str | int]:
        """Chunks, and ids of special tokens between them."""
        if self.marks is None or "<" not in text:
            return self.chunks_of(text)
        found: list[str | int] = []
        at = 0
        for m in self.marks.finditer(text):
            found += self.chunks_of(text[at : m.start()])
            found.append(self.special[m[0]])
            at = m.end()
        return found + self.chunks_of(text[at:])

    def learn(self, chunks: set[str | int]) -> None:
        """Have the ids of all these chunks in memory."""
        if len(self.known) >= REMEMBERED or self.chars >= REMEMBERED_CHARS:
            self.old, self.known, self.chars = self.known, {}, 0
        known, old = self.known, self.old
        missing: dict[str, list[bytes]] = {}
        for c in chunks:
            if c not in known:
                if c in old:
                    known[c] = old[c]
                elif isinstance(c, int):
                    known[c] = (self.shown[c], self.decode([c]))
                else:
                    missing[c] = self.pieces_of(c)
                    self.chars += len(c)
        ids_of = self.merged(list({p for ps in missing.values() for p in ps}))
        shown = self.shown
        for c, pieces in missing.items():
            ids = ids_of[pieces[0]] if len(pieces) == 1 else [i for p in pieces for i in ids_of[p]]
            known[c] = (" ".join([shown[i] for i in ids]), self.decode(ids))

    def encode_many(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Decimal ids joined by one space, and the text that they decode to, of every text."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= SLICE_CHARS):
                size += len(texts[end])
                end += 1
            split = [self.split(x) for x in texts[at:end]]
            self.learn(set().union(*split))
            for chunks in split:
                found = list(map(self.known.__getitem__, chunks))
                yield " ".join([x for x, _ in found]), " ".join([x for _, x in found])
            at = end

    def encode(self, text: str) -> tuple[str, str]:
        return next(self.encode_many([text]))

    def decode(self, ids: list[int]) -> str:
        """The vocabulary has no decoder: tokens are joined by one space."""
        return " ".join([self.names[i] for i in ids])


_loaded: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def encode_texts(docs: DataFrame, path: str, keep: list[str], text: str = "text", outputs: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Encode ``text`` of every row; add the columns named in ``outputs``.

    ``ids`` string (decimal ids joined by one space), ``n_tokens`` long, ``decoded`` string,
    ``ids_sha256`` and ``decoded_sha256`` string.  A null text is the empty text; it has no
    ids, 0 tokens and decodes to the empty text.  ``keep`` names the columns carried along;
    other columns, whatever their names, are dropped.  No shuffle: each row is independent.
    """
    keep = beside(keep, outputs)
    kinds = {"ids": "string", "n_tokens": "bigint", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [f"{x} {kinds[x]}" for x in outputs])
    arrow = {"bigint": pa.int64(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            rows: list[list] = [[] for _ in outputs]
            for ids, decoded in bpe.encode_many([x.as_py() or "" for x in batch.column(len(keep))]):
                for name, column in zip(outputs, rows):
                    if name == "ids":
                        column.append(ids)
                    elif name == "n_tokens":
                        column.append(ids.count(" ") + 1 if ids else 0)
                    elif name == "decoded":
                        column.append(decoded)
                    else:
                        column.append(hashlib.sha256((ids if name == "ids_sha256" else decoded).encode()).hexdigest())
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(c, arrow[kinds[n]]) for n, c in zip(outputs, rows)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *outputs])

    return docs.select(*keep, docs[text].alias("__text")).mapInArrow(run, schema)
