"""Mixing sources to target weights.

Texts are packed into fixed-length blocks of words, one stream per source.  A plan gives
every output shard its multinomial counts of slots per source; a slot's running number
within its source goes through that source's pseudorandom permutation of block indices,
and slots and blocks meet in one join by (source, index).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, WORD, beside, materialize, mix64, small_side

MOST_REPEATS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
#: The plan holds at most this many counts (shards times sources); shards grow instead.
MOST_COUNTS = 2_000_000
CHUNK_ROWS = 2_500


@dataclass(frozen=True)
class Mix:
    """targets: one row per source; blocks: text segments by block; slots: the mix."""

    docs: DataFrame
    targets: DataFrame
    blocks: DataFrame
    slots: DataFrame
    block_words: int


def water_fill(sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Share sum(sizes) by weight; no target above MOST_REPEATS times its size.

    Excess is shared anew by weight until no target is above its limit.
    """
    limit, total = MOST_REPEATS * sizes.astype(float), float(sizes.sum())
    full = np.zeros(len(sizes), bool)
    target = np.zeros(len(sizes))
    while True:
        rest = total - limit[full].sum()
        share = weights * rest / max(weights[~full].sum(), 1e-300)
        target = np.where(full, limit, share)
        over = ~full & (target > limit)
        if not over.any():
            return target
        full |= over


def shard_counts(slots: np.ndarray, seed: int) -> np.ndarray:
    """Slots per (shard, source): multinomial draws, then balanced to the exact totals.

    Each full shard draws its counts from the multinomial of the target shares.  Column
    sums of independent draws miss the totals by a few standard deviations, so surplus
    slots are handed to the sources that lack them, spread evenly over the shards.
    """
    total = int(slots.sum())
    per_shard = max(SHARD_SLOTS, -(-total * max(len(slots), 1) // MOST_COUNTS))
    shards = max(1, -(-total // per_shard))
    room = np.full(shards, per_shard, np.int64)
    room[-1] = total - per_shard * (shards - 1)
    if not total:
        return np.zeros((shards, len(slots)), np.int64)
    rng = np.random.default_rng(seed)
    counts = rng.multinomial(room, slots / total)
    vacant = []
    for s, surplus in enumerate(counts.sum(axis=0) - slots):
        if surplus > 0:
            ends = np.cumsum(counts[:, s])
            drop = np.searchsorted(ends, (np.arange(surplus) + 0.5) * ends[-1] / surplus, side="right")
            np.subtract.at(counts[:, s], drop, 1)
            vacant.append(drop)
    free = rng.permutation(np.concatenate(vacant)) if vacant else np.empty(0, np.int64)
    lacking = slots - counts.sum(axis=0)
    taker = np.repeat(np.arange(len(slots)), np.maximum(lacking, 0))
    np.add.at(counts, (free, taker), 1)
    return counts


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of range(size): a Feistel network that walks out-of-range values."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            h, m, k = half[todo], mask[todo], key[todo]
            left, right = out[todo] >> h, out[todo] & m
            for turn in range(4):
                mixed = mix64(right + mix64(k + np.uint64(turn))) & m
                left, right = right, left ^ mixed
            out[todo] = (left << h) | right
            todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def with_offsets(docs: DataFrame) -> DataFrame:
    """Number documents' words through each source's stream, in two levels.

    Running sums within hashed chunks of about CHUNK_ROWS rows and one running sum over
    the chunks of a source: no task holds a whole source.  Rows are in order of their chunk,
    doc_id and a hash of their text, so reruns agree; equal rows may change places.
    """
    rows = docs.count()
    chunks = max(1, rows // CHUNK_ROWS)
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "row"), F.lit(chunks)).cast("int"))
    sums = docs.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_size"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("source_"), F.col("chunk").alias("chunk_"), F.coalesce(F.sum("chunk_size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(small_side(materialize(starts)), F.col("source").eqNullSafe(F.col("source_")) & (F.col("chunk") == F.col("chunk_"))).withColumn("offset", F.col("base") + F.col("within")).drop("source_", "chunk_", "base", "within", "chunk", "row")


def mix(docs: DataFrame, seed: int = 20_240_601, block_words: int = BLOCK_WORDS, keep: tuple[str, ...] = (), texts: bool = True) -> Mix:
    """Plan a mix of the sources of ``docs`` (doc_id, text, source).

    Without ``texts`` the plan has no words to give, only counts; each text is read once then.

    Sources are ranked by code point, null last, and weigh 1, 2, 3, repeating.  A null or
    wordless text has size 0 and is never taken.  Rows that share a doc_id are separate
    rows of their source.  An empty table gives an empty mix.  Sources' totals (one row a
    source) are collected to plan; texts, blocks and slots stay distributed.
    """
    spark = docs.sparkSession
    own = ["doc_id", "source", "text", *beside(keep, ("doc_id", "source", "text", "size", "row", "chunk", "within", "offset", "source_id", "source_size", "target", "block", "start", "n_words"))]
    docs = docs.select(*own).withColumns({"size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"), "row": F.xxhash64("text")})
    if not texts:
        docs = materialize(docs.drop("text"))
    totals = docs.groupBy("source").agg(F.sum("size").alias("n")).collect()
    totals.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
    sizes = np.array([r["n"] for r in totals], np.int64)
    targets = water_fill(sizes, np.arange(len(sizes)) % 3 + 1.0)
    n_blocks = -(-sizes // block_words)
    slots = np.rint(np.divide(targets * n_blocks, sizes, out=np.zeros(len(sizes)), where=sizes > 0)).astype(np.int64)
    slots = np.minimum(slots, MOST_REPEATS * n_blocks)
    plan = spark.createDataFrame(
        [(i, r["source"], int(r["n"]), float(t), int(b), int(k)) for i, (r, t, b, k) in enumerate(zip(totals, targets, n_blocks, slots))],
        "source_id int, source string, source_size long, target double, n_blocks long, n_slots long",
    )
    counts = shard_counts(slots, seed)
    first = np.cumsum(counts, axis=0) - counts
    shard, source = np.nonzero(counts)
    runs = spark.createDataFrame(pa.table({"shard": shard, "source_id": source.astype(np.int32), "first": first[shard, source], "n": counts[shard, source], "n_blocks": n_blocks[source]}))
    wide = spark.conf.get("spark.sql.shuffle.partitions")
    numbered = runs.repartition(int(wide), "shard").select("shard", "source_id", "n_blocks", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("slot"))

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard_, source_id, size, slot = (batch.column(i).to_numpy() for i in range(4))
            turn, at = np.divmod(slot, size)
            with np.errstate(over="ignore"):
                key = mix64((source_id.astype(np.uint64) << np.uint64(32)) + turn.astype(np.uint64) + np.uint64(seed))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(permuted(at, size, key))], names=["shard", "source_id", "slot", "block"])

    taken = numbered.mapInArrow(blocks_of, "shard long, source_id int, slot long, block long")

    placed = with_offsets(docs).join(small_side(plan.select("source_id", F.col("source").alias("source_"), "source_size", "target")), F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    width = F.lit(block_words)
    last = F.expr(f"(offset + size - 1) div {block_words}")
    spread = F.when(F.col("size") > 0, F.sequence(F.expr(f"offset div {block_words}"), last))
    start = F.greatest(F.lit(0), F.col("block") * width - F.col("offset"))
    end = F.least(F.col("size"), (F.col("block") + 1) * width - F.col("offset"))
    blocks = placed.withColumn("block", F.explode_outer(spread)).withColumns({"start": start, "n_words": F.coalesce(end - start, F.lit(0))})
    return Mix(placed, plan, blocks, taken, block_words)


def mixed_texts(planned: Mix) -> DataFrame:
    """The mix itself: shard, slot order, source and the words of each taken segment."""
    width, docs = planned.block_words, planned.docs.where("size > 0")
    # Words are split once a row, and cut into the pieces that fall into each block.
    docs = docs.withColumn("words_", F.split(F.regexp_replace("text", f"^{GAP}", ""), GAP)).drop("text")
    first, last = F.expr(f"offset div {width}"), F.expr(f"(offset + size - 1) div {width}")

    def piece(b):
        start = F.greatest(F.lit(0), b * width - F.col("offset"))
        n = F.least(F.col("size"), (b + 1) * width - F.col("offset")) - start
        return F.struct(b.alias("block"), F.array_join(F.slice("words_", (start + 1).cast("int"), n.cast("int")), " ").alias("text"))

    pieces = docs.withColumn("piece_", F.explode(F.transform(F.sequence(first, last), piece))).select(*[c for c in docs.columns if c != "words_"], "piece_.block", "piece_.text")
    return planned.slots.hint("merge").join(pieces, ["source_id", "block"])


def taken_words(planned: Mix, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document row, the words that the mix takes of it (``taken``, repeats counted).

    A row of ``docs`` is a row here, whatever it shares with others.
    """
    uses = planned.slots.groupBy("source_id", "block").agg(F.count(F.lit(1)).alias("uses"))
    # Slots grow out of a small plan, so the planner takes them for small; they are not.
    found = planned.blocks.where("size > 0").join(uses.hint("merge"), ["source_id", "block"], "left")
    # Offsets tell the rows of a source apart, but for rows without words, which are in no block.
    key = ["doc_id", "source_id", "offset", "size", "source_size", "target", *keep]
    taken = found.groupBy(*key).agg(F.sum(F.col("n_words") * F.coalesce("uses", F.lit(0))).cast("long").alias("taken"))
    return taken.unionByName(planned.docs.where("size = 0").select(*key, F.lit(0).cast("long").alias("taken")))
