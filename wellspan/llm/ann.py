"""Approximate nearest neighbours by cross-polytope hashing.

Fast Hadamard pseudo-rotations turn each unit vector; the signed axis nearest to it is its
hash, and two hashes side by side are its bucket in a table.  A query probes the buckets whose
axes are nearest to it, over all tables by one measure: the sum of its components along the
bucket's two axes.  Everything found is reranked exactly.  How near a bucket has to be is
fitted on a bounded sample of queries, each held against all vectors.  For largest inner
products of vectors with different norms, one more component makes all norms equal before
hashing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import materialize

TABLES, TURNS = 8, 3
#: Buckets of a table are dealt to groups of about half of TILE_BYTES of vectors, and to
#: MOST_GROUPS at most; a group beyond TILE_BYTES is cut into blocks.
TILE_BYTES, MOST_GROUPS = 1 << 25, 4_096
#: Probes are fitted on at most this many queries, by brute force over all vectors, to this recall.
SAMPLE_QUERIES, RECALL = 128, 0.94


@dataclass(frozen=True)
class Hashing:
    """dim of vectors, padded width, largest norm, whether norms differ; buckets nearer than ``least`` are probed."""

    dim: int
    width: int
    norm: float
    uneven: bool
    least: float = -np.inf

    @property
    def axes(self) -> int:
        return 2 * self.width

    def rotated(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Components along all signed axes, for either hash of a table."""
        out = []
        for part in range(2):
            rng, y = np.random.default_rng([table, part, self.width]), x
            for _ in range(TURNS):
                y = hadamard(y * rng.choice([-1.0, 1.0], self.width))
            out.append(np.concatenate([y, -y], axis=1))
        return out[0], out[1]

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Unit vectors of ``width`` components whose nearest axes are alike for large products."""
        out = np.zeros((len(x), self.width))
        norms = np.sqrt(np.einsum("ij,ij->i", x, x))
        if query or not self.uneven:
            out[:, : self.dim] = x / norms[:, None]
        else:
            out[:, : self.dim] = x / self.norm
            out[:, self.dim] = np.sqrt(np.maximum(0.0, 1.0 - (norms / self.norm) ** 2))
        return out

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        x = self.lifted(x, False)
        codes = np.empty((len(x), TABLES), np.int64)
        for t in range(TABLES):
            one, two = self.rotated(x, t)
            codes[:, t] = one.argmax(axis=1) * self.axes + two.argmax(axis=1)
        return codes

    def probes(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Buckets that a query probes in a table, from its components along the axes."""
        i, j = np.flatnonzero(one >= self.least - two.max()), np.flatnonzero(two >= self.least - one.max())
        p, q = np.nonzero(one[i, None] + two[None, j] >= self.least)
        return i[p] * self.axes + j[q]


def hadamard(x: np.ndarray) -> np.ndarray:
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(-1, n // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(-1, n)
        h *= 2
    return x / np.sqrt(n)


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after another."""
    n = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def nearest_of_sample(classes: DataFrame, queries: np.ndarray, own: np.ndarray, k: int) -> DataFrame:
    """(q, vector): the k nearest classes of each of a few queries, all vectors compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, ids, held = np.empty((len(queries), 0)), np.empty((len(queries), 0), np.int64), None
        for batch in batches:
            for i in range(0, batch.num_rows, 2_000):
                part = batch.slice(i, 2_000)
                x, who = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1), part.column(0).to_numpy()
                new = np.where(own[:, None] == who[None], -np.inf, queries @ x.T)
                score, ids = np.concatenate([score, new], axis=1), np.concatenate([ids, np.broadcast_to(who, new.shape)], axis=1)
                x = np.broadcast_to(x, (len(queries), *x.shape))
                held = x if held is None else np.concatenate([held, x], axis=1)
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                score, ids, held = np.take_along_axis(score, best, 1), np.take_along_axis(ids, best, 1), np.take_along_axis(held, best[:, :, None], 1)
        if held is not None:
            q, at = np.nonzero(score > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(ids[q, at]), pa.array(score[q, at]), pa.array(list(held[q, at]), pa.list_(pa.float64()))], names=["q", "class", "score", "vector"])

    found = classes.select("class", "vector").mapInArrow(run, "q int, class long, score double, vector array<double>")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "class"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("q", "vector")


def fitted(hashing: Hashing, classes: DataFrame, k: int) -> Hashing:
    """Probe the buckets that reach RECALL for a sample of queries; all buckets if there is no sample."""
    sample = classes.where("asked").orderBy(F.xxhash64("class"), "class").limit(SAMPLE_QUERIES).select("class", "vector").collect()
    if not sample:
        return hashing
    queries = np.array([r["vector"] for r in sample], float)
    near = nearest_of_sample(classes, queries, np.array([r["class"] for r in sample]), k).collect()
    if not near:
        return hashing
    q, x = np.array([r["q"] for r in near]), np.array([r["vector"] for r in near], float)
    codes, lifted, best = hashing.buckets(x), hashing.lifted(queries, True), np.full(len(q), -np.inf)
    for t in range(TABLES):
        one, two = hashing.rotated(lifted, t)
        best = np.maximum(best, one[q, codes[:, t] // hashing.axes] + two[q, codes[:, t] % hashing.axes])
    return replace(hashing, least=float(np.sort(best)[int((1 - RECALL) * len(best))]))


def search(coded: DataFrame, hashing: Hashing, tables: list[int], k: int, kind: str) -> DataFrame:
    """(asker, class, score): the best k + 1 classes of each asking class in each tile.

    ``coded`` has (class, vector, codes, asked).  A tile is a group of neighbouring buckets of
    a table, or a block of a group that is too large.  Queries go to the tiles that hold
    buckets which they probe, and look at these buckets alone.
    """
    dim, n_codes, wire = hashing.dim, hashing.axes**2, np.dtype(kind)
    most = max(1_024, TILE_BYTES // (8 * dim))
    groups = int(min(MOST_GROUPS, n_codes, max(1, -(-coded.count() * 2 // most))))
    width = -(-n_codes // groups)
    numbered = coded.select(F.explode(F.array(*(F.struct(F.lit(t).alias("t"), F.floor(F.col("codes")[t] / width).alias("g")) for t in tables))).alias("x")).select("x.*")
    # One row for a group of a table: TABLES * MOST_GROUPS rows at most.
    blocks = np.zeros((TABLES, groups), np.int64)
    for r in numbered.groupBy("t", "g").agg(F.count(F.lit(1)).alias("n")).collect():
        blocks[r["t"], r["g"]] = -(-r["n"] // most)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                ids, codes = part.column(0).to_numpy(), part.column(2).flatten().to_numpy().reshape(part.num_rows, -1)
                x = part.column(1).flatten().to_numpy().reshape(-1, dim)
                asks = np.flatnonzero(part.column(3).fill_null(False).to_numpy(zero_copy_only=False))
                lifted = hashing.lifted(x[asks], True)
                tile, block, kinds, rows, code = [], [], [], [], []
                for t in tables:
                    g = codes[:, t] // width
                    tile.append(t * groups + g)
                    block.append(ids % np.maximum(blocks[t, g], 1))
                    kinds.append(np.zeros(len(ids), np.int64))
                    rows.append(np.arange(len(ids)))
                    code.append(codes[:, t])
                    one, two = hashing.rotated(lifted, t)
                    for at, a, b in zip(asks, one, two):
                        to = np.unique(hashing.probes(a, b) // width)
                        to, n = np.repeat(to, blocks[t, to]), blocks[t, to].sum()
                        tile.append(t * groups + to)
                        block.append(ranges(np.zeros(len(np.unique(to)), np.int64), blocks[t, np.unique(to)]))
                        kinds.append(np.ones(n, np.int64))
                        rows.append(np.full(n, at))
                        code.append(np.zeros(n, np.int64))
                tile, block, kinds, rows, code = map(np.concatenate, (tile, block, kinds, rows, code))
                data = [v.tobytes() for v in x.astype(wire)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tile), pa.array(block), pa.array(kinds), pa.array(ids[rows]), pa.array([data[r] for r in rows], pa.binary()), pa.array(code)], names=["tile", "block", "kind", "class", "vector", "code"]
                )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by tile, vectors before queries; at most one tile's vectors are held."""
        now, held, data = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows]):
                part, own, kind_ = batch.slice(a, b - a), tuple(key[:2, a]), key[2, a]
                if own != now:
                    now, held, data = own, [], None
                ids, code = part.column(3).to_numpy(), part.column(5).to_numpy()
                x = np.frombuffer(b"".join(part.column(4).to_pylist()), wire).reshape(-1, dim)
                if kind_ == 0:
                    held.append((ids, code, x))
                    continue
                if not held:
                    continue
                first = int(own[0]) % groups * width
                if data is None:
                    ids_, code_, x_ = (np.concatenate(c) for c in zip(*held))
                    order = np.lexsort((ids_, code_))
                    data = ids_[order], np.searchsorted(code_[order], first + np.arange(width + 1)), x_[order].astype(float)
                    held = []
                yield from best(int(own[0]) // groups, first, ids, x.astype(float), *data)

    def best(table: int, first: int, askers: np.ndarray, x: np.ndarray, ids: np.ndarray, starts: np.ndarray, data: np.ndarray) -> Iterator[pa.RecordBatch]:
        one, two = hashing.rotated(hashing.lifted(x, True), table)
        out: list[tuple] = []
        for asker, q, a, b in zip(askers, x, one, two):
            probed = hashing.probes(a, b) - first
            probed = probed[(probed >= 0) & (probed < width)]
            at = ranges(starts[probed], starts[probed + 1])
            if not len(at):
                continue
            score = data[at] @ q
            if len(at) > k + 5:
                at = at[np.argpartition(-score, k + 4)[: k + 5]]
            # The product is summed anew, in one order, so that equal vectors score alike in all tiles.
            score = np.einsum("d,nd->n", q, data[at], optimize=False)
            place = np.lexsort((ids[at], -score))[: k + 1]
            out.append((np.full(len(place), asker), ids[at[place]], score[place]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["asker", "class", "score"])

    dealt = coded.select("class", "vector", "codes", "asked").mapInArrow(deal, "tile long, block long, kind long, class long, vector binary, code long")
    return dealt.repartition("tile", "block").sortWithinPartitions("tile", "block", "kind").mapInArrow(found, "asker long, class long, score double")


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, nearest first.

    ``vectors`` has (vec_id, embedding); ``queries`` has (query_id), ids of vectors whose rows
    are the queries.  Score is the inner product in double precision; ties go to the smaller
    vec_id; a query never finds its own id.  Vectors that are null, zero, of another length
    than most, or hold null or non-finite components take no part, nor do rows without an id.
    Repeated rows count once.  Equal vectors form a class that is hashed and compared once and
    of which the k + 1 smallest ids are known, which is all that ``k`` neighbours can use.
    A query that its probes leave with fewer than ``k`` neighbours is held against all
    vectors.  An empty table gives an empty table.  Pairs leave a tile only as a query's best
    k + 1.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    kind = "f4" if isinstance(vectors.schema["embedding"].dataType.elementType, FloatType) else "f8"
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).where(F.col("vec_id").isNotNull() & x.isNotNull() & fine)
    sizes = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not sizes:
        return empty
    dim = sizes[0]["dim"]
    rows = rows.where(F.size("embedding") == dim).withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), F.reverse("embedding"))})
    by_class = Window.partitionBy("h1", "h2").orderBy("vec_id")
    first = rows.withColumn("place", F.dense_rank().over(by_class)).where(F.col("place") <= k + 1)
    classes = first.groupBy("h1", "h2").agg(F.min("vec_id").alias("class"), F.array_sort(F.collect_set("vec_id")).alias("ids"), F.min(F.struct("vec_id", "embedding"))["embedding"].alias("vector"))
    asked = rows.join(queries.select(F.col("query_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    classes = materialize(classes.join(asked.select("h1", "h2", F.lit(True).alias("asked")).distinct(), ["h1", "h2"], "left"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v)
    seen = classes.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("most"), F.min(square).alias("least"), F.sum(F.size("ids")).alias("n_ids")).collect()[0]
    uneven = seen["least"] < seen["most"] * (1 - 1e-5)
    hashing = Hashing(dim, 1 << max(0, dim + uneven - 1).bit_length(), float(np.sqrt(seen["most"])), bool(uneven))
    hashing = fitted(hashing, classes, k)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2_000):
                part = batch.slice(i, 2_000)
                found = hashing.buckets(part.column(1).flatten().to_numpy().reshape(-1, dim))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(list(found), pa.list_(pa.int64())), part.column(2)], names=["class", "vector", "codes", "asked"])

    coded = materialize(classes.select("class", "vector", "asked").mapInArrow(codes, "class long, vector array<double>, codes array<long>, asked boolean"))
    pairs = materialize(search(coded, hashing, list(range(TABLES)), k, kind).groupBy("asker", "class").agg(F.max("score").alias("score")))
    # The ids that a query found; its own is one of them.
    enough = pairs.join(classes.select("class", F.size("ids").alias("n")), "class").groupBy("asker").agg(F.sum("n").alias("n")).where(F.col("n") > F.lit(min(k, seen["n_ids"] - 1)))
    short = coded.where("asked").join(enough.select(F.col("asker").alias("class")), "class", "left_anti").select("class")
    short = materialize(short)
    if not short.isEmpty():
        again = coded.drop("asked").join(short.select("class", F.lit(True).alias("asked")), "class", "left")
        whole = search(again, replace(hashing, least=-np.inf), [0], k, kind)
        pairs = pairs.join(short.select(F.col("class").alias("asker")), "asker", "left_anti").unionByName(whole)
    ranked = pairs.withColumn("place", F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "class"))).where(F.col("place") <= k + 1)
    members = ranked.join(classes.select("class", "ids"), "class").select("asker", "score", F.explode("ids").alias("vec_id"))
    short_list = members.withColumn("place", F.row_number().over(Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= k + 1)
    lists = short_list.groupBy("asker").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    who = asked.join(classes.select("h1", "h2", F.col("class").alias("asker")), ["h1", "h2"]).select("query_id", "asker")
    own = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return who.join(lists, "asker").select("query_id", F.posexplode(own).alias("at", "f")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
