"""Prefix tries of conversations: succinct level-order shards, rolled up and merged.

Conversations are sorted by their turns as bytes and cut into contiguous shards, so that no
first turn, common prefix or repeated conversation is ever one task's: whatever it is that a
million conversations share lies on the border of the shards that hold them.  A shard's trie
is complete but for the nodes on its first and its last path, the heavy upper levels, which
other shards may have too.  Those paths with their partial sums are the rows of the next,
much smaller trie, up to a last one of a single shard; what it knows goes down again to the
shards below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, prepared, stored
from .resample import CRC_SQL

#: Bytes of a turn in a path: MD5 of role and text, and the number of words.
MD5, LABEL = 16, 24
#: A shard ends when it has so many nodes, but not before it has so many paths.
SHARD_NODES, SHARD_PATHS = 1 << 16, 8

FAMILY, HEAD = 20, 4
NOTHING = hashlib.sha256(b"").digest()
_BIG = np.iinfo(np.int64).max

_SUMS = ("convs", "low", "children", "leaves", "saved")
_TRIE = pa.schema([("shard", pa.int64()), ("nodes", pa.int64()), ("louds", pa.binary()), ("labels", pa.binary()), *[(c, pa.binary()) for c in _SUMS], ("ends", pa.binary()), ("row_end", pa.binary()), ("origin", pa.binary()), ("last", pa.bool_()), ("piece_first", pa.binary()), ("piece_last", pa.binary())])
_TRIE_SQL = "shard long, nodes long, louds binary, labels binary, " + ", ".join(f"{c} binary" for c in _SUMS) + ", ends binary, row_end binary, origin binary, last boolean, piece_first binary, piece_last binary"
_NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_OPEN = "origin long, path binary, " + ", ".join(f"{c} binary" for c in _SUMS) + ", ends binary"


def _label() -> Column:
    """A turn as 48 hex digits: MD5 of (role, text), where the role's length marks its end, and words."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")), F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 16, "0"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): each conversation with the head of its family's first one.

    Turns are in order of (turn, digest), null turns first.  One shuffle, by family, of 48
    characters a turn; a conversation's digests are one row, its texts never are.
    """
    turns = conversations.where("conv_id is not null").select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), F.struct("turn", _label().alias("label")).alias("t"))
    own = turns.repartition("family").groupBy("family", "conv_id").agg(F.array_sort(F.collect_list("t"))["label"].alias("labels"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD
    head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("labels", 1, HEAD - 1))).over(Window.partitionBy("family"))
    whole = F.concat(F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h")), F.slice("labels", F.col("h") + 1, F.greatest(F.size("labels"), F.lit(1))))
    return own.withColumn("head", head).withColumn("h", h.cast("int")).select("conv_id", F.unhex(F.array_join(whole, "")).alias("path"))


@dataclass
class Trie:
    """Level-order nodes: degrees in unary (LOUDS), a label a node, and sums that nodes carry."""

    louds: np.ndarray
    labels: np.ndarray
    sums: dict[str, np.ndarray]
    ends: np.ndarray
    row_end: np.ndarray

    @property
    def parents(self) -> np.ndarray:
        """Parent of every node but the root: the zeros before the node's own one."""
        ones = np.flatnonzero(self.louds)
        return ones - np.arange(len(ones))

    def levels(self, parents: np.ndarray) -> list[tuple[int, int]]:
        """Nodes of each depth, as ranges."""
        out, low, high = [], 0, 1
        while low < high:
            out.append((low, high))
            low, high = high, int(np.searchsorted(parents, high)) + 1
        return out

    def path(self, row: int, parents: np.ndarray) -> np.ndarray:
        """Nodes from the root to where a row ends."""
        out = [int(self.row_end[row])]
        while out[-1]:
            out.append(int(parents[out[-1] - 1]))
        return np.array(out[::-1])


def grown(paths: list[bytes], carried: list[dict[str, np.ndarray]] | None, sums: dict[str, np.ndarray] | None, ends: list[bytes]) -> Trie:
    """The trie of sorted ``paths``.

    Either ``sums`` has each path's own values, which its last node gets, or ``carried`` has
    the values of all nodes along each path.  ``ends`` are digests, alike.
    """
    m = len(paths)
    sizes = np.array([len(p) // LABEL for p in paths], np.int64)
    flat = np.frombuffer(b"".join(paths), ">u8").reshape(-1, LABEL // 8)
    offset = np.cumsum(sizes) - sizes
    node, shared = np.zeros(m, np.int64), np.ones(m, bool)
    shared[0] = False
    parents, labels, count = [], [np.zeros((1, LABEL // 8), flat.dtype)], 1
    along, rows = [np.zeros(m, np.int64)], [np.arange(m)]
    for depth in range(1, int(sizes.max(initial=0)) + 1):
        at = np.flatnonzero(sizes >= depth)
        before = np.maximum(at - 1, 0)
        mine = flat[offset[at] + depth - 1]
        theirs = flat[np.minimum(offset[before] + depth - 1, len(flat) - 1)]
        same = shared[at] & (sizes[before] >= depth) & (mine == theirs).all(axis=1)
        shared[:] = False
        shared[at] = same
        parents.append(node[at[~same]])
        labels.append(mine[~same])
        node[at] = count + np.cumsum(~same) - 1
        count += int((~same).sum())
        along.append(node[at])
        rows.append(at)
    parent = np.concatenate([np.empty(0, np.int64), *parents])
    degree = np.bincount(parent, minlength=count)
    louds = np.ones(2 * count - 1, bool)
    louds[np.cumsum(degree + 1) - 1] = False
    total = {c: np.full(count, _BIG) if c == "low" else np.zeros(count, np.int64) for c in _SUMS}
    digests = np.frombuffer(NOTHING * count, "V32").copy()
    empty = np.frombuffer(NOTHING, "V32")[0]
    for depth, (nodes, who) in enumerate(zip(along, rows, strict=True)):
        if carried is None:
            last = sizes[who] == depth
            nodes, who = nodes[last], who[last]
            values = {c: sums[c][who] for c in _SUMS}
            found = [ends[i] for i in who]
        else:
            values = {c: np.array([carried[i][c][depth] for i in who], np.int64) for c in _SUMS}
            found = [ends[i][32 * depth : 32 * depth + 32] for i in who]
        for c in _SUMS:
            (np.minimum if c == "low" else np.add).at(total[c], nodes, values[c])
        known = np.array(found, "V32") if found else np.empty(0, "V32")
        real = known != empty
        digests[nodes[real]] = known[real]
    return Trie(louds, np.concatenate(labels), total, digests, node.copy())


def rolled_up(t: Trie, closed: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over subtrees, deepest level first; nodes that are not ``closed`` keep theirs to themselves."""
    parents = t.parents
    s = {c: v.copy() for c, v in t.sums.items()}
    words = t.labels[:, -1].astype(np.int64)
    for low, high in reversed(t.levels(parents)):
        at = np.arange(low, high)[closed[low:high]]
        s["leaves"][at] = np.where(s["children"][at] == 0, 1, s["leaves"][at])
        s["saved"][at] += (s["convs"][at] - 1) * words[at]
        if low:
            above = parents[at - 1]
            for c in ("convs", "leaves", "saved"):
                np.add.at(s[c], above, s[c][at])
            np.add.at(s["children"], above, 1)
            np.minimum.at(s["low"], above, s["low"][at])
    return s


def _written(shard: int, t: Trie, origin: np.ndarray, last: bool, pieces: tuple[bytes, bytes]) -> pa.RecordBatch:
    packed = lambda a: a.astype("<i8").tobytes()
    row = [shard, len(t.labels), np.packbits(t.louds).tobytes(), t.labels.astype(">u8").tobytes(), *(packed(t.sums[c]) for c in _SUMS), t.ends.tobytes(), packed(t.row_end), packed(origin), last, *pieces]
    return pa.record_batch([pa.array([x], f.type) for x, f in zip(row, _TRIE, strict=True)], schema=_TRIE)


def _read(r: dict) -> tuple[Trie, np.ndarray]:
    n = r["nodes"]
    numbers = lambda c: np.frombuffer(r[c], "<i8")
    louds = np.unpackbits(np.frombuffer(r["louds"], np.uint8), count=2 * n - 1).astype(bool)
    t = Trie(louds, np.frombuffer(r["labels"], ">u8").reshape(-1, LABEL // 8), {c: numbers(c) for c in _SUMS}, np.frombuffer(r["ends"], "V32"), numbers("row_end"))
    return t, numbers("origin")


def _open_nodes(t: Trie, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which nodes are closed, and those on the first and on the last path; the top trie has no open ones."""
    closed, parents = np.ones(len(t.labels), bool), t.parents
    first, final = t.path(0, parents), t.path(len(t.row_end) - 1, parents)
    if not last:
        closed[first] = closed[final] = False
    return closed, first, final


def _from_members(most: int):
    """Shards from (path, conv_id) in order; equal paths are one row of the trie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        paths, count, low, ends, nodes, now, ids = [], [], [], [], 0, None, bytearray()

        def shard() -> pa.RecordBatch:
            single = len(paths) == 1
            sums = {c: np.zeros(len(paths), np.int64) for c in _SUMS} | {"convs": np.array(count), "low": np.array(low)}
            t = grown(paths, None, sums, [NOTHING, *ends[1:-1], *([] if single else [NOTHING])])
            return _written(base + made, t, np.empty(0, np.int64), False, (ends[0], b"" if single else ends[-1]))

        for b in batches:
            for path, conv in zip(b["path"].to_pylist(), b["conv_id"].to_pylist(), strict=True):
                if path != now:
                    if paths:
                        ends.append(bytes(ids) if len(paths) == 1 else hashlib.sha256(ids).digest())
                        if nodes >= most and len(paths) >= SHARD_PATHS:
                            ends[-1] = bytes(ids)
                            yield shard()
                            made += 1
                            paths, count, low, ends, nodes = [], [], [], [], 0
                    paths.append(path)
                    count.append(0)
                    low.append(conv)
                    nodes += len(path) // LABEL
                    now, ids = path, bytearray()
                count[-1] += 1
                ids += b",%d" % conv if ids else b"%d" % conv
        if paths:
            ends.append(bytes(ids))
            yield shard()

    return run


def _from_open(most: int, last: bool):
    """Shards of a next level: rows of the open paths of the one below, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        rows, nodes = [], 0

        def shard() -> pa.RecordBatch:
            carried = [{c: np.frombuffer(r[c], "<i8") for c in _SUMS} for r in rows]
            t = grown([r["path"] for r in rows], carried, None, [r["ends"] for r in rows])
            return _written(base + made, t, np.array([r["origin"] for r in rows]), last, (b"", b""))

        for b in batches:
            for r in b.to_pylist():
                if not last and nodes >= most and len(rows) >= SHARD_PATHS:
                    yield shard()
                    made, rows, nodes = made + 1, [], 0
                rows.append(r)
                nodes += len(r["path"]) // LABEL + 1
        if rows:
            yield shard()

    return run


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and last path of each shard with what their nodes know; what both share counts once."""
    for b in batches:
        for r in b.to_pylist():
            t, _ = _read(r)
            closed, first, final = _open_nodes(t, False)
            s = rolled_up(t, closed)
            for side, nodes in enumerate((first, final)[: min(2, len(t.row_end))]):
                twice = np.isin(nodes, first) if side else np.zeros(len(nodes), bool)
                sums = [np.where(twice, _BIG if c == "low" else 0, s[c][nodes]).astype("<i8").tobytes() for c in _SUMS]
                ends = t.ends[nodes].copy()
                ends[twice] = np.frombuffer(NOTHING, "V32")[0]
                row = [2 * r["shard"] + side, t.labels[nodes[1:]].tobytes(), *sums, ends.tobytes()]
                yield pa.record_batch([pa.array([x]) for x in row], names=["origin", "path", *_SUMS, "ends"])


def _settled(t: Trie, last: bool, lows: tuple[bytes | None, bytes | None]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Final sums of closed nodes; of open ones only ``low`` is known, from the level above."""
    closed, first, final = _open_nodes(t, last)
    s = rolled_up(t, closed)
    for nodes, known in ((first, lows[0]), (final, lows[1])):
        if known is not None:
            s["low"][nodes] = np.frombuffer(known, "<i8")
    return s, closed


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every closed node of each shard."""
    for b in batches:
        for r in b.to_pylist():
            t, _ = _read(r)
            s, closed = _settled(t, r["last"], (r["low_0"], r["low_1"]))
            parents = np.concatenate([[-1], t.parents])
            depth = np.zeros(len(closed), np.int64)
            for d, (low, high) in enumerate(t.levels(t.parents)):
                depth[low:high] = d
            at = np.flatnonzero(closed)
            above = pa.array(s["low"][parents[at]], mask=at == 0)
            ends = pa.array([x.tobytes().hex() for x in t.ends[at]], pa.string())
            columns = [pa.array(s["low"][at]), pa.array(depth[at]), above, *(pa.array(s[c][at]) for c in ("convs", "children", "leaves", "saved")), ends]
            yield pa.record_batch(columns, names=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"])


def _lows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every row of a shard, the smallest member of each node along its path."""
    for b in batches:
        for r in b.to_pylist():
            t, origin = _read(r)
            s, _ = _settled(t, r["last"], (r["low_0"], r["low_1"]))
            parents = t.parents
            out = [s["low"][t.path(i, parents)].astype("<i8").tobytes() for i in range(len(origin))]
            yield pa.record_batch([pa.array(origin), pa.array(out, pa.binary())], names=["origin", "low"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined pieces of each path, which come in order."""
    now, digest, schema = None, None, pa.schema([("path", pa.binary()), ("digest", pa.binary())])
    for b in batches:
        for path, piece in zip(b["path"].to_pylist(), b["piece"].to_pylist(), strict=True):
            if path != now:
                if digest is not None:
                    yield pa.record_batch([pa.array([now]), pa.array([digest.digest()])], schema=schema)
                now, digest = path, hashlib.sha256(piece)
            else:
                digest.update(b"," + piece)
    if digest is not None:
        yield pa.record_batch([pa.array([now]), pa.array([digest.digest()])], schema=schema)


def _with_ends(rows: DataFrame, tries: DataFrame) -> DataFrame:
    """Open paths with the digest of the ids that end there.

    A path at a shard's border may go on in the next: its ids come as joined pieces, in the
    order of shards, and one task hashes them piece by piece.
    """
    pieces = tries.select(F.explode(F.array(*(F.struct((F.col("shard") * 2 + k).alias("origin"), F.col(c).alias("piece")) for k, c in enumerate(("piece_first", "piece_last"))))).alias("p")).select("p.*").where(F.length("piece") > 0)
    known = materialize(rows.select("origin", "path").join(pieces, "origin").repartition("path").sortWithinPartitions("path", "origin").select("path", "piece").mapInArrow(_digests, "path binary, digest binary"))
    own = F.concat(F.expr("substring(ends, 1, length(ends) - 32)"), F.col("digest"))
    return rows.join(known, "path").withColumn("ends", own).select(*rows.columns)


def tries(members: DataFrame, most: int = SHARD_NODES) -> list[DataFrame]:
    """Levels of succinct tries over (conv_id, path), from the shards to the single top one.

    One row a shard: LOUDS bits, labels of 24 bytes, sums and end digests in level order.
    """
    ordered = members.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").select("path", "conv_id")
    levels = [stored(ordered.mapInArrow(_from_members(most), _TRIE_SQL))]
    rows = stored(_with_ends(stored(levels[0].mapInArrow(_opened, _OPEN)), levels[0]))
    before = None
    while True:
        n, nodes = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("path") / LABEL + 1), F.lit(0))).first()
        last = nodes <= most or n < 2 * SHARD_PATHS
        # Few rows are one sorted stream; more are dealt out by ranges, unless that does not shrink them.
        if last or nodes <= 16 * most or (before is not None and 2 * n > before):
            ordered = rows.coalesce(1)
        else:
            ordered = rows.repartitionByRange("path")
        levels.append(stored(ordered.sortWithinPartitions("path", "origin").mapInArrow(_from_open(most, last), _TRIE_SQL)))
        if last:
            return levels
        before, rows = n, stored(levels[-1].mapInArrow(_opened, _OPEN))


def nodes(levels: list[DataFrame]) -> DataFrame:
    """A row for every node of the tries: see ``prefix_nodes``."""
    above, out = None, None
    for k, level in reversed(list(enumerate(levels))):
        if above is None:
            known = level.withColumns({"low_0": F.lit(None).cast("binary"), "low_1": F.lit(None).cast("binary")})
        else:
            sides = above.groupBy(F.shiftright("origin", 1).alias("shard")).agg(*(F.max(F.when(F.col("origin") % 2 == side, F.col("low"))).alias(f"low_{side}") for side in (0, 1)))
            known = level.join(sides, "shard", "left")
        found = known.mapInArrow(_nodes, _NODES)
        out = found if out is None else out.unionByName(found)
        if k:
            above = stored(known.mapInArrow(_lows, "origin long, low binary"))
    return out


def prefix_nodes(conversations: DataFrame, most: int = SHARD_NODES) -> DataFrame:
    """One row for each distinct sequence of the first d turns of the rebuilt conversations.

    ``conversations`` has (conv_id, turn, role, text), a row a turn; rows without a conv_id
    belong to no conversation and are left out, nulls in role and text are empty, turns that
    tie are put in order of a digest, and equal rows count as turns each.  A node has the
    smallest ``conv_id`` of its members, its ``depth`` (the root's is 0 and it has no text),
    ``parent_conv_id`` (root: null), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.  An empty table has no members and no node.

    Members are sorted in ranges of (path, conv_id), so many equal conversations spread over
    ranges as well; a task holds a shard of at most ``most`` nodes (and eight paths more).
    """
    prepared(conversations.sparkSession)
    return nodes(tries(stored(rebuilt(conversations)), most))


SQL = rf"""
with recursive ids as (select distinct conv_id as c, conv_id - conv_id % 20 as base from conversations where conv_id is not null),
crc_words as (select c::varchar as word from ids), {CRC_SQL.strip()},
turns as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as label from conversations),
ordered as (select conv_id, label, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words, row_number() over (partition by conv_id order by turn nulls first, label) as place from turns),
heads as (select c, base, crc % 4 as h from ids join crc on word = c::varchar),
parts as (select c, place, 0 as own, label, words from heads join ordered on conv_id = base and place <= h union all select c, place, 1, label, words from heads join ordered on conv_id = c and place > h),
paths as (select c, words, row_number() over w as depth, md5(string_agg(label, '') over w) as node, label from parts window w as (partition by c order by own, place)),
members as (select c, 0 as depth, '' as node, null::varchar as parent, 0 as words from ids union all select c, depth, node, coalesce(lag(node) over (partition by c order by depth), ''), words from paths),
nodes as (select node, depth, parent, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(words) as saved from members group by 1, 2, 3),
kids as (select parent, count(*) as n_children from nodes where parent is not null group by 1),
above as (select distinct a.node as top, b.node from members a join members b on a.c = b.c and a.depth <= b.depth),
rolled as (select top, sum(saved)::bigint as saved_tokens, count(*) filter (k.parent is null) as n_leaves from above a join nodes n using (node) left join kids k on k.parent = a.node group by 1),
ended as (select node, string_agg(c::varchar, ',' order by c) as ids from (select c, node, depth, max(depth) over (partition by c) as deepest from members) where depth = deepest group by 1)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from nodes n left join nodes p on p.node = n.parent left join kids k on k.parent = n.node join rolled r on r.top = n.node left join ended e on e.node = n.node
"""
