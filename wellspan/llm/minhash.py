"""b-bit MinHash near-dedup.

Documents with the same shingle set form a class first, so exact copies cost one group-by.
Every class gets 128 minima; bands of four give candidates and the two low bits of all
minima, packed into four longs, give a collision-corrected estimate by bit counts.  Links
are confirmed on full shingle sets.

Candidates of a bucket are not paired with each other by a join.  Each is linked to one
member of its bucket first, which joins most near copies.  What is left are members of one
bucket and of different components.  Tasks compare their signatures tile by tile and name
the members that may still have a link, not the pairs; the texts of these alone go by bucket
to a second pass, which compares full sets within the tile and returns only the links that
join two components.  So rows follow the number of documents, never the pairs of a group,
and no pair of different components that shares a band and whose estimate is near is left
unchecked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, mix64, text_bytes, window_hashes, word_hashes
from .graph import components

BANDS, BAND_ROWS, BITS = 32, 4, 2
MINIMA = BANDS * BAND_ROWS
#: Candidates whose estimate is below the threshold by more than this are not checked:
#: over four standard errors of an estimate from 128 two-bit minima.
SLACK = 0.2
#: A tile holds two chunks of a bucket; a chunk has about this many signatures, or texts of
#: about this many shingles in all.
CHUNK_SIGNATURES, CHUNK_SHINGLES = 2_048, 500_000
#: Pairs of signatures looked at together.
AT_ONCE = 1 << 16

_rng = np.random.default_rng(20_240_602)
_FACTOR = _rng.integers(0, 1 << 32, MINIMA, np.uint32) | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, MINIMA, np.uint32)
_BAND_KEY = _rng.integers(0, 1 << 64, (BAND_ROWS, BANDS), np.uint64) | np.uint64(1)
_LANES = np.uint64(0x5555555555555555)
_WORDS = [f"s{k}" for k in range(4)]


@dataclass(frozen=True)
class Threshold:
    """Documents are linked if ``den * intersection >= num * union`` of their shingle sets."""

    width: int = 5
    num: int = 80
    den: int = 100

    def holds(self, both, either):
        return self.den * both >= self.num * either

    def sizes_allow(self, x, y):
        """Sets of such sizes can be linked: the smaller one inside the larger is the best case."""
        return (self.den * x >= self.num * y) & (self.den * y >= self.num * x)

    @property
    def least(self) -> float:
        """The smallest estimate that is checked."""
        return self.num / self.den - SLACK


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a lower-cased (A-Z) text; empty without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(width, len(words))))


def minima(shingles: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(low), 512):
            np.minimum(best, (low[i : i + 512, None] * _FACTOR + _SHIFT).min(axis=0), out=best)
    return best


def with_row_hash(docs: DataFrame, columns: Iterable[str]) -> DataFrame:
    """128 bits, h1 and h2, of the named columns: rows are equal where these are."""
    known = [F.col(c).isNull() for c in columns]
    return docs.withColumns({"h1": F.xxhash64(*known, *columns), "h2": F.xxhash64(F.lit(2), *known, *columns)})


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, h1, h2, n_shingles, d0, d1, s0..s3, bands): a row per row, whole text read.

    d0 and d1 digest the shingle set (null without words), s0..s3 pack the low bits of the
    minima, bands holds one key per band.
    """
    keep = ["doc_id", "h1", "h2"]
    schema = "doc_id bigint, h1 bigint, h2 bigint, n_shingles bigint, d0 bigint, d1 bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint, bands array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            count, digest = np.zeros(size, np.int64), np.zeros((size, 2), np.uint64)
            least = np.zeros((size, MINIMA), np.uint32)
            for i, text in enumerate(text_bytes(batch.column(3))):
                found = shingle_set(text, width)
                count[i] = len(found)
                if len(found):
                    digest[i] = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.uint64)
                    least[i] = minima(found)
            with np.errstate(over="ignore"):
                band = (mix64(least.reshape(size, BANDS, BAND_ROWS).astype(np.uint64)) * _BAND_KEY.T).sum(axis=2, dtype=np.uint64)
                band = mix64(band + np.arange(BANDS, dtype=np.uint64))
            lanes = (least & np.uint32(3)).astype(np.uint64).reshape(size, 4, 32)
            packed = (lanes << (2 * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64)
            empty = count == 0
            whole = [pa.array(digest.view(np.int64)[:, k], pa.int64(), mask=empty) for k in range(2)] + [pa.array(packed[:, k], pa.int64(), mask=empty) for k in range(4)]
            ends = np.concatenate([[0], np.cumsum(np.where(empty, 0, BANDS))]).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(band.view(np.int64)[~empty].reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(count), *whole, keys], names=[*keep, "n_shingles", "d0", "d1", *_WORDS, "bands"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "h1", "h2", "text").mapInArrow(run, schema)


def estimate(left: str, right: str) -> Column:
    """Similarity from packed low bits: equal lanes, less the share that agrees by chance."""
    differ = F.lit(0)
    for k in range(4):
        x = F.col(f"{left}{k}").bitwiseXOR(F.col(f"{right}{k}"))
        differ += F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(F.lit(0x5555555555555555)))
    chance = 1.0 / (1 << BITS)
    return ((1.0 - differ / F.lit(float(MINIMA))) - chance) / (1.0 - chance)


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The same of one signature, as four words, against many."""
    x = one ^ many
    differ = np.bitwise_count((x | (x >> np.uint64(1))) & _LANES).sum(axis=-1, dtype=np.int64)
    chance = 1.0 / (1 << BITS)
    return ((1.0 - differ / MINIMA) - chance) / (1.0 - chance)


def confirmed(pairs: DataFrame, texts: DataFrame, rule: Threshold) -> DataFrame:
    """The pairs (a, b) whose full shingle sets meet the threshold.

    Texts join by b and then by a; the last join sorts by a, so a set shared by many pairs
    is built once per task.
    """
    schema = "a bigint, b bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, np.empty(0, np.uint64)
        for batch in batches:
            linked = []
            for a, left, right in zip(batch.column(0).to_pylist(), text_bytes(batch.column(2)), text_bytes(batch.column(3))):
                if a != last:
                    last, own = a, shingle_set(left, rule.width)
                other = shingle_set(right, rule.width)
                both = len(np.intersect1d(own, other, assume_unique=True))
                linked.append(rule.holds(both, len(own) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    right = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b")
    whole = right.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
    return whole.select("a", "b", "left", "right").mapInArrow(run, schema)


def tiled(rows: DataFrame, weight: Column, chunk: int) -> DataFrame:
    """Give the rows (band, node, ...) of each bucket the tiles (i, j) in which they meet.

    A bucket is one tile as long as its weights sum to ``chunk`` at most.  Larger ones are
    hashed to chunks, and every two chunks meet in one tile, so that a task holds two chunks
    however large the bucket is.
    """
    sums = rows.groupBy("band").agg(F.greatest(F.lit(1), F.ceil(F.sum(weight) / chunk)).cast("int").alias("chunks"))
    wide = rows.join(sums, "band")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    tile = F.explode(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(F.least(c, own).alias("i"), F.greatest(c, own).alias("j"))))
    return wide.withColumn("tile", tile).withColumns({"i": F.col("tile.i"), "j": F.col("tile.j")}).drop("chunks", "tile")


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "node")


def tiles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of the rows of one tile; the first three columns are its key, in order."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cut], [*cut, batch.num_rows]):
            own = tuple(key[:, a])
            if held and own != now:
                yield pa.Table.from_batches(held)
                held = []
            now = own
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def may_link(rows: DataFrame, rule: Threshold) -> DataFrame:
    """(band, node): members of a tile with a partner of another component that may be linked.

    ``rows`` are tiled signatures, dealt.  A pair counts in the first of its shared bands only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in tiles_of(batches):
            n = tile.num_rows
            band, own, size = (tile.column(c).to_numpy() for c in ("band", "own", "n_shingles"))
            words = np.stack([tile.column(c).to_numpy() for c in _WORDS], axis=1).view(np.uint64)
            keys = tile.column("bands").combine_chunks().flatten().to_numpy().reshape(n, BANDS)
            found = np.zeros(n, bool)
            step = max(1, AT_ONCE // n)
            for a in range(0, n, step):
                b = min(n, a + step)
                # Only later members: each pair is seen once.
                near = (own[a:b, None] != own[None, a:]) & rule.sizes_allow(size[a:b, None], size[None, a:])
                p, q = np.nonzero(near & (estimates(words[a:b, None], words[None, a:]) >= rule.least))
                p, q = (p + a)[q + a > p + a], (q + a)[q + a > p + a]
                for k in range(0, len(p), AT_ONCE // 8):
                    x, y = p[k : k + AT_ONCE // 8], q[k : k + AT_ONCE // 8]
                    same = keys[x] == keys[y]
                    here = keys[x, same.argmax(axis=1)] == band[0]
                    found[x[here]] = found[y[here]] = True
            yield pa.RecordBatch.from_arrays([pa.array(band[found]), tile.column("node").combine_chunks().filter(pa.array(found))], names=["band", "node"])

    return rows.select("band", "i", "j", "node", "own", "n_shingles", *_WORDS, "bands").mapInArrow(run, "band bigint, node bigint")


def joining_links(rows: DataFrame, rule: Threshold) -> DataFrame:
    """(a, b): pairs of components that a link between members of one tile joins.

    ``rows`` are tiled texts, dealt; full sets are compared.  Members of the tile's largest component are only compared with
    the others, and two members that links found so far have joined not at all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in tiles_of(batches):
            sets = [shingle_set(t, rule.width) for c in tile.column("text").chunks for t in text_bytes(c)]
            size = np.array([len(s) for s in sets])
            label, own = np.unique(tile.column("own").to_numpy(), return_inverse=True)
            of = label[own]
            # A shingle that only one member holds adds to no intersection.
            _, place, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            member = np.repeat(np.arange(len(sets)), size)[holders[place] > 1]
            place = place[holders[place] > 1]
            starts = np.searchsorted(member, np.arange(len(sets) + 1))
            left, right = [], []
            for m in np.flatnonzero(own != np.bincount(own).argmax()):
                mask = np.zeros(len(holders), np.int64)
                mask[place[starts[m] : starts[m + 1]]] = 1
                both = np.bincount(member, mask[place], len(sets)).astype(np.int64)
                linked = (own != own[m]) & rule.holds(both, size + size[m] - both)
                for other in np.flatnonzero(linked):
                    if own[other] != own[m]:
                        left.append(of[m])
                        right.append(of[other])
                        own[own == own[other]] = own[m]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return rows.select("band", "i", "j", "node", "own", "text").mapInArrow(run, "a bigint, b bigint")


def near_rows(docs: DataFrame, rule: Threshold = Threshold(), identity: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """(doc_id, h1, h2, n_shingles, root, component_id) for every row of ``docs`` (doc_id, text).

    ``root`` numbers the component and is null for texts without words; ``component_id`` is
    its smallest doc_id.  ``h1`` and ``h2`` are with_row_hash of the columns ``identity``.
    """
    docs = with_row_hash(docs.select(*dict.fromkeys([*identity, "doc_id", "text"])), identity)
    prints = materialize(fingerprints(docs, rule.width))
    # Of the rows of a class, the one with the smallest id stands for it.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2", "n_shingles", *_WORDS, "bands")).alias("r")
    classes = prints.where("d0 is not null").groupBy("d0", "d1").agg(first)
    heads = materialize(classes.select(F.monotonically_increasing_id().alias("node"), "d0", "d1", *(f"r.{c}" for c in ("doc_id", "h1", "h2", "n_shingles", *_WORDS, "bands"))))
    signs = heads.select("node", "n_shingles", *_WORDS)

    banded = heads.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("most")).where("hub < most").drop("most")
    buckets = materialize(banded.join(shared, "band"))
    # Whoever may be compared, so that texts are shuffled once.
    involved = heads.select("node", "h1", "h2").join(buckets.select("node").distinct(), "node", "left_semi")
    texts = docs.select("h1", "h2", "text").join(involved, ["h1", "h2"]).select("node", "text")
    repeated = prints.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    texts = materialize(texts if repeated.isEmpty() else texts.dropDuplicates(["node"]))

    left = signs.select(F.col("node").alias("a"), F.col("n_shingles").alias("n"), *(F.col(f"s{k}").alias(f"x{k}") for k in range(4)))
    right = signs.select(F.col("node").alias("b"), F.col("n_shingles").alias("m"), *(F.col(f"s{k}").alias(f"y{k}") for k in range(4)))
    stars = buckets.where("hub < node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = stars.join(right, "b").join(left, "a").where((estimate("x", "y") >= rule.least) & rule.sizes_allow(F.col("n"), F.col("m"))).select("a", "b")
    found = components(materialize(confirmed(stars, texts, rule)))

    named = buckets.select("band", "node").join(found.withColumnRenamed("component", "own"), "node", "left").withColumn("own", F.coalesce("own", "node"))
    mixed = named.groupBy("band").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low < high").select("band")
    open_ = materialize(named.join(mixed, "band"))
    asked = materialize(may_link(dealt(tiled(open_, F.lit(1), CHUNK_SIGNATURES).join(heads.select("node", "n_shingles", *_WORDS, "bands"), "node")), rule)).distinct()
    again = asked.join(open_, ["band", "node"]).join(heads.select("node", "n_shingles"), "node")
    joined = components(materialize(joining_links(dealt(tiled(again, F.col("n_shingles"), CHUNK_SHINGLES).join(texts, "node")), rule)))

    own = heads.select("node", "d0", "d1", F.col("doc_id").alias("least")).join(found.withColumnRenamed("component", "own"), "node", "left").withColumn("own", F.coalesce("own", "node"))
    root = own.join(joined.select(F.col("node").alias("own"), "component"), "own", "left").select("d0", "d1", "least", F.coalesce("component", "own").alias("root"))
    labels = root.join(root.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(F.col("d0").alias("e0"), F.col("d1").alias("e1"), "root", "component_id")
    rows = prints.join(labels, (F.col("d0") == F.col("e0")) & (F.col("d1") == F.col("e1")), "left")
    return rows.select("doc_id", "h1", "h2", "n_shingles", "root", F.when(F.col("d0").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def near_components(docs: DataFrame, rule: Threshold = Threshold()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Null and wordless texts have an empty set and are linked with nothing: each is its own
    component.  Links go by row: two rows of one doc_id with different texts are in the
    components of their texts.  Rows with a null id take part as well and are never kept;
    component_id is null where no row of a component has an id.  Other columns of ``docs``
    are not looked at.  An empty table gives an empty table.
    """
    rows = near_rows(docs, rule)
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, rule: Threshold = Threshold()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) without all but one of each component.

    The row with the smallest doc_id stays, rows without an id last; of several, the one with
    the smallest hash of all columns; of equal rows, one.  Texts without words all stay.
    """
    columns = docs.columns
    rows = materialize(near_rows(docs, rule, tuple(columns)).where("root is not null"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2")).alias("r"))
    stay = materialize(first.select("r.h1", "r.h2"))
    gone = rows.select("h1", "h2").distinct().join(stay, ["h1", "h2"], "left_anti")
    left = with_row_hash(docs, columns).join(gone, ["h1", "h2"], "left_anti")
    repeated = materialize(rows.join(stay, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    if repeated.isEmpty():
        return left.select(*columns)
    once = left.join(repeated, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])
    return left.join(repeated, ["h1", "h2"], "left_anti").unionByName(once).select(*columns)


#: All pairs that share a shingle, counted: fit for small tables, and exact.
SQL = """
with worded as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
shingles as (select distinct doc_id, array_to_string(w[i : i + 2], ' ') as s from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from worded where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as p, b.doc_id as q, count(*) as both_ from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select p, q from shared join sizes x on x.doc_id = p join sizes y on y.doc_id = q where 100 * both_ >= 85 * (x.n + y.n - both_)),
ways as (select p, q from links union all select q, p from links),
reached as (with recursive r(doc_id, other) as (select p, p from ways union select r.doc_id, ways.q from r join ways on ways.p = r.other) select doc_id, min(other) as least from r group by doc_id)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(least, d.doc_id) as component_id, coalesce(least, d.doc_id) = d.doc_id as kept
from documents d left join sizes on sizes.doc_id = d.doc_id left join reached on reached.doc_id = d.doc_id
"""
