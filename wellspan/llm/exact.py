"""Exact dedup: two passes over a Bloom filter find texts that may repeat, only their rows shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, materialize, prepared, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Cells a document has in the filter, at least, and cells that it marks.
CELLS, MARKS = 16, 4
#: A segment of 65,536 cells is a row; a filter has at most so many (2 GB of cells in 256 MB of
#: bits), and hashes beyond that go through further filters, one range of hashes after the other.
SEGMENT_BITS, MOST_SEGMENT_BITS = 16, 15
#: Rows whose marks a task holds at once.
MOST_ROWS = 1 << 20
#: A group of more than a ten-thousandth of all rows is hot; there are fewer than 10,000 of these.
HOT_SHARE, HOT_LEAST = 10_000, 1_000

_SEGMENT = 1 << SEGMENT_BITS
_PARTIAL = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])
_PLANE = pa.schema([("segment", pa.int32()), ("words", pa.list_(pa.int64()))])


def text_sha256() -> Column:
    """SHA-256 of the text, A-Z lower-cased, as hex; null is the empty text."""
    return F.sha2(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).cast("binary"), 256)


def _packed(cells: np.ndarray) -> bytes:
    """Places within a segment: two bytes each, or a bit for every place if these take less."""
    if len(cells) < _SEGMENT // 16:
        return cells.astype("<u2").tobytes()
    bits = np.zeros(_SEGMENT, bool)
    bits[cells] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    if len(data) < _SEGMENT // 8:
        return np.frombuffer(data, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))


def _marks(spot: np.ndarray, cells: np.ndarray, bits: int) -> np.ndarray:
    """Cell numbers over all segments, ``MARKS`` a row."""
    segment = spot.astype(np.uint64) >> np.uint64(64 - bits) if bits else np.zeros(len(spot), np.uint64)
    c = cells.astype(np.uint64)
    return np.concatenate([(segment << np.uint64(SEGMENT_BITS)) | ((c >> np.uint64(16 * k)) & np.uint64(_SEGMENT - 1)) for k in range(MARKS)])


def _marked(bits: int):
    """The marks of a task's rows: by segment, cells marked once and cells marked more often."""

    def out(marks: list[np.ndarray]) -> pa.RecordBatch:
        cell, n = np.unique(np.concatenate(marks), return_counts=True)
        segment = (cell >> np.uint64(SEGMENT_BITS)).astype(np.int64)
        place = (cell & np.uint64(_SEGMENT - 1)).astype(np.int64)
        names, starts = np.unique(segment, return_index=True)
        parts = [(place[a:b], n[a:b] > 1) for a, b in zip(starts, [*starts[1:], len(cell)], strict=True)]
        return pa.record_batch([pa.array(names.astype(np.int32)), pa.array([_packed(p[~m]) for p, m in parts], pa.binary()), pa.array([_packed(p[m]) for p, m in parts], pa.binary())], schema=_PARTIAL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, rows = [], 0
        for b in batches:
            marks.append(_marks(b["spot"].to_numpy(), b["cells"].to_numpy(), bits))
            rows += b.num_rows
            if rows >= MOST_ROWS:
                yield out(marks)
                marks, rows = [], 0
        if rows:
            yield out(marks)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments come in order: cells that were marked at least twice, over all tasks."""

    def out(segment: int, more: np.ndarray) -> pa.RecordBatch:
        words = np.packbits(more, bitorder="little").view(np.int64)
        return pa.record_batch([pa.array([segment], pa.int32()), pa.array([words], pa.list_(pa.int64()))], schema=_PLANE)

    now, once, more = None, np.zeros(_SEGMENT, bool), np.zeros(_SEGMENT, bool)
    for b in batches:
        for segment, some, others in zip(*(b[c].to_pylist() for c in ("segment", "once", "more")), strict=True):
            if segment != now:
                if more.any():
                    yield out(now, more)
                now, once, more = segment, np.zeros(_SEGMENT, bool), np.zeros(_SEGMENT, bool)
            some, others = _unpacked(some), _unpacked(others)
            more[some[once[some]]] = True
            once[some] = True
            more[others] = True
    if more.any():
        yield out(now, more)


def _possible(bits: int) -> Column:
    """Whether all marks of a row lie on cells that were marked twice."""
    hit = F.lit(True)
    for k in range(MARKS):
        cell = f"(shiftrightunsigned(cells, {16 * k}) & {_SEGMENT - 1})"
        hit = hit & F.coalesce(F.expr(f"(shiftrightunsigned(get(words, cast({cell} div 64 as int)), cast({cell} % 64 as int)) & 1) = 1"), F.lit(False))
    return hit


def flagged(digests: DataFrame, n: int, most_bits: int = MOST_SEGMENT_BITS) -> list[DataFrame]:
    """``digests`` (spot, cells, ...) with ``possible``: false only where no other row is equal.

    A filter has 16 to 32 cells a row, in a power of two of segments by the first bits of
    ``spot``.  First pass: each task marks the cells of its rows, and what tasks have marked is
    merged segment by segment into the cells marked twice.  Second pass: those are broadcast
    (at most 2 ** ``most_bits`` segments of 8 KB), and a row is possible where all its cells
    are marked twice; of single rows fewer than 0.3 % are.  Where that many segments do not
    do, ranges of ``spot`` are taken one after the other, each read through the sorted table.
    """
    bits = max(0, (max(n, 1) * CELLS - 1).bit_length() - SEGMENT_BITS)
    ranges = max(0, bits - most_bits)
    segment = F.expr(f"cast(shiftrightunsigned(spot, {64 - bits}) as int)") if bits else F.lit(0)
    done = []
    for k in range(1 << ranges):
        rows = digests
        if ranges:  # unsigned ranges are signed ones with the first bit turned
            low = (k << (64 - ranges)) - (1 << 64 if k >> (ranges - 1) else 0)
            rows = digests.where(F.col("spot").between(low, low + (1 << (64 - ranges)) - 1))
        partial = rows.select("spot", "cells").mapInArrow(_marked(bits), "segment int, once binary, more binary")
        plane = materialize(partial.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merged, "segment int, words array<bigint>"))
        met = rows.withColumn("segment", segment).join(F.broadcast(plane), "segment", "left")
        done.append(stored(met.withColumn("possible", _possible(bits)).drop("segment", "words", "spot", "cells")))
    return done


def judged(docs: DataFrame, keep: Iterable[str] = ("doc_id",), most_bits: int = MOST_SEGMENT_BITS) -> DataFrame:
    """Every row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``, beside ``keep``.

    Texts are equal when they are identical after lower-casing A-Z; a null text is the empty
    one.  Of equal texts the row with the largest doc_id stays (null is smaller than any), and
    of rows that share that id exactly one.  An empty table gives an empty one.  Texts are
    read once: what is held is a digest a row.  Rows that cannot have a copy pass straight
    through with themselves as ``keep_id``; others are grouped by digest with map-side
    combining, and the groups that hold more than a ten-thousandth of all rows are answered
    by a broadcast of at most 10,000 rows, so that no task gets a hot group.
    """
    prepared(docs.sparkSession)
    names = beside(keep, ("keep_id", "group_size", "kept", "text_sha256"))
    carried = F.struct(*(F.col(c) for c in names)) if names else F.struct(F.lit(True).alias("none"))
    digests = docs.select("doc_id", carried.alias("carried"), text_sha256().alias("text_sha256")).withColumns({"spot": F.xxhash64("text_sha256"), "cells": F.xxhash64(F.lit("cells"), "text_sha256"), "row": F.monotonically_increasing_id()})
    digests = stored(digests.sortWithinPartitions("spot"))
    n = digests.count()
    parts = flagged(digests, n, most_bits)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    some = rows.where("possible").select("doc_id", "carried", "text_sha256", "row")
    groups = materialize(some.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row")).alias("top"), F.count(F.lit(1)).alias("group_size")))
    large = F.col("group_size") > max(HOT_LEAST, n // HOT_SHARE)
    hot = groups.where(large)
    met = some.join(F.broadcast(hot), "text_sha256", "left")
    cold = met.where("group_size is null").drop("top", "group_size").join(groups.where(~large), "text_sha256")
    out = lambda keep_id, size, kept: [*(F.col(f"carried.`{c}`").alias(c) for c in names), keep_id.alias("keep_id"), size.alias("group_size"), kept.alias("kept"), F.col("text_sha256")]
    first = F.col("top.row") == F.col("row")
    both = [x.select(*out(F.col("top.doc_id"), F.col("group_size"), first)) for x in (met.where("group_size is not null"), cold)]
    alone = rows.where("not possible").select(*out(F.col("doc_id"), F.lit(1).cast("long"), F.lit(True)))
    return alone.unionByName(both[0]).unionByName(both[1])


SQL = f"""
with d as (select doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) as text_sha256 from documents)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size, row_number() over w = 1 as kept, text_sha256
from d window w as (partition by text_sha256 order by doc_id desc nulls last)
"""
