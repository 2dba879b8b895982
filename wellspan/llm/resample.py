"""Resampling of documents towards a target corpus, with importance weights from hashed n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import beside, prepared, stored, text_bytes

BUCKETS = 10_000
#: Documents of fewer words take no part, the best-scored share is drawn.
LEAST_WORDS, PERCENT, SEED = 20, 25, 7
#: Longest word, in bytes, that tables hash together with others.
SHORT = 64

#: Lower-cases A-Z and turns every ASCII character that is no letter or digit into a space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_STEP = np.array([zlib.crc32(bytes([c])) ^ zlib.crc32(b"\0") for c in range(256)], np.uint32)


@lru_cache(maxsize=4096)
def _shift(length: int) -> np.ndarray:
    """Tables that carry a CRC over ``length`` further bytes: four of 256, one for each byte.

    A CRC is linear over bits, so powers of two of the length are composed; words seldom vary
    by more than some dozens of lengths.
    """
    if length == 0:
        return np.array([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    if length == 1:
        x = _shift(0)
        return (x >> np.uint32(8)) ^ _STEP[x & np.uint32(255)]
    half = _shift(length // 2)
    return _carried(_carried(_shift(length % 2), half), half)


def _carried(crc: np.ndarray, tables: np.ndarray) -> np.ndarray:
    c = crc.astype(np.uint32)
    return tables[0][c & np.uint32(255)] ^ tables[1][(c >> np.uint32(8)) & np.uint32(255)] ^ tables[2][(c >> np.uint32(16)) & np.uint32(255)] ^ tables[3][c >> np.uint32(24)]


#: Tables of all short lengths: a CRC carried over so many bytes, a byte so far from a word's end.
_SHIFTS = np.stack([_shift(k) for k in range(SHORT + 1)])
_FAR = np.stack([_carried(_STEP, _SHIFTS[k]) for k in range(SHORT)])
_ZEROS = np.array([zlib.crc32(bytes(k)) for k in range(SHORT + 1)], np.uint32)


def _word_crcs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and CRC of every word of a text that ``_TABLE`` was applied to.

    The CRC of a word is the exclusive or of an entry for each byte, by its distance from the
    word's end, and of the CRC of as many zero bytes.  Longer words are hashed one by one.
    """
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], data != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    length = end - start
    places = np.flatnonzero(inside[1:-1])
    first = np.cumsum(length) - length
    far = np.repeat(end - 1, length) - places
    long = np.flatnonzero(length > SHORT)
    if len(long):
        far = np.minimum(far, SHORT - 1)
    crc = (np.bitwise_xor.reduceat(_FAR[far, data[places]], first) if len(first) else np.empty(0, np.uint32)) ^ _ZEROS[np.minimum(length, SHORT)]
    for k in long:
        crc[k] = zlib.crc32(text[start[k] : end[k]])
    return start, length, crc


def buckets_of(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, text after text, and each text's number of words.

    The CRC of ``a b`` follows from those of ``a`` and ``b``, for all pairs at once.
    """
    parts = list(texts)
    stops = np.cumsum([len(t) + 1 for t in parts])
    start, length, crc = _word_crcs(b" ".join(parts).translate(_TABLE))
    n = np.bincount(np.searchsorted(stops, start, side="right"), minlength=len(parts))
    first = np.zeros(len(crc), bool)
    first[(np.cumsum(n) - n)[n > 0]] = True
    second = np.flatnonzero(~first)
    sizes = length[second]
    # crc(x + y) is crc(x) carried over len(y) bytes, and crc(y).
    spaced = _carried(crc[second - 1], _SHIFTS[1]) ^ np.uint32(zlib.crc32(b" "))
    t = np.minimum(sizes, SHORT)
    pair = _SHIFTS[t, 0, spaced & 255] ^ _SHIFTS[t, 1, (spaced >> 8) & 255] ^ _SHIFTS[t, 2, (spaced >> 16) & 255] ^ _SHIFTS[t, 3, spaced >> 24]
    for k in np.flatnonzero(sizes > SHORT):
        pair[k] = _carried(spaced[k : k + 1], _shift(int(sizes[k])))[0]
    # Each pair goes beside its second word, so that texts stay apart.
    both = np.full((len(crc), 2), -1, np.int64)
    both[:, 0] = crc % BUCKETS
    both[second, 1] = (pair ^ crc[second]) % BUCKETS
    flat = both.ravel()
    return flat[flat >= 0], n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for b in batches:
        total += np.bincount(buckets_of(text_bytes(b["text"]))[0], minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all ``texts`` by bucket: summed in tasks, then by bucket; 10,000 numbers come back."""
    counts = texts.select("text").mapInArrow(_counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in counts.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log of each bucket's share in the target over that in the source, floored."""
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def _weighed(gain: np.ndarray, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buckets, n_words = buckets_of(text_bytes(b["text"]))
            n = np.maximum(2 * n_words - 1, 0)
            ends = np.concatenate([[0], np.cumsum(gain[buckets])])
            stop = np.cumsum(n)
            weight = (ends[stop] - ends[stop - n]) // np.maximum(n, 1)
            yield pa.record_batch([*(b[c] for c in names), pa.array(n_words), pa.array(n), pa.array(weight)], names=[*names, "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a document, in thousandths, floored: the same on every run."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Features are words and pairs of neighbouring words, counted by bucket over all ``docs``
    and all ``target`` texts; the gains of 10,000 buckets are an array in every task.  Texts
    are read twice and never shuffled.  A quarter of the documents of at least 20 words is
    drawn, by score and then by smaller doc_id: scores are whole numbers of a range that does
    not grow with the table (logs of counts and of 32-bit fractions, so some ten thousand at
    most), so their counts, summed from the top, give the cutoff and every score's first
    rank, and rows are numbered within their own score only.  Of one score there are few:
    the noise spreads even equal texts so that none holds more than 0.04 % of them.

    A null text has no words: weight 0.  A null doc_id hashes as the empty string and comes
    last among ties; rows that agree in doc_id and score take their ranks in any order.
    Undrawn documents have a null rank.
    """
    prepared(docs.sparkSession)
    made = ("n_words", "n_features", "weight", "score", "rank")
    names = list(dict.fromkeys([*beside(keep, made), "doc_id"]))
    gain = gains(bucket_counts(docs), bucket_counts(target))
    carried = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(names)), F.col("text"))
    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    weighed = carried.mapInArrow(_weighed(gain, [f"c{i}" for i in range(len(names))]), f"{kinds}, n_words long, n_features long, weight long")
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col(f"c{names.index('doc_id')}"))))
    able = scored.where(F.col("n_words") >= LEAST_WORDS)
    histogram = able.groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    scores, counts = (np.array([r[k] for r in histogram], np.int64) for k in ("score", "n"))
    order = np.argsort(-scores)
    scores, above = scores[order], np.cumsum(counts[order]) - counts[order]
    wanted = PERCENT * int(counts.sum()) // 100
    reached = scores[above < wanted]
    out = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)] + [F.col(c) for c in made[:-1]]
    unranked = F.lit(None).cast("long").alias("rank")
    if not len(reached):
        return scored.select(*out, unranked)
    cut = int(reached[-1])
    first = docs.sparkSession.createDataFrame([(int(s), int(a)) for s, a in zip(scores, above, strict=True) if s >= cut], "score long, above long")
    drawn = (F.col("n_words") >= LEAST_WORDS) & (F.col("score") >= cut)
    surviving = scored.where(drawn).join(F.broadcast(first), "score")
    doc_id = F.col(f"c{names.index('doc_id')}")
    place = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy(doc_id.asc_nulls_last()))
    ranked = surviving.select(*out, F.when(place <= wanted, place).alias("rank"))
    return scored.where(~drawn).select(*out, unranked).unionByName(ranked)


#: CRC-32 in SQL: a message's CRC is the exclusive or of one table entry a byte, which depends
#: on the byte and its distance from the end, and of the CRC of as many zero bytes.
CRC_SQL = """
bits(b, k, c) as (select b, 0, b from (select unnest(range(256)) as b) union all select b, k + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where k < 8),
crc_step as (select b, c from bits where k = 8),
crc_far(far, b, c) as (select 0, b, c from crc_step union all select far + 1, f.b, xor(f.c >> 8, s.c) from crc_far f join crc_step s on s.b = f.c & 255 where far < (select max(strlen(word)) from crc_words)),
crc_zero(len, c) as (select 0, 4294967295 union all select len + 1, xor(z.c >> 8, s.c) from crc_zero z join crc_step s on s.b = z.c & 255 where len < (select max(strlen(word)) from crc_words)),
crc_hex as (select word, strlen(word) as len, hex(encode(word)) as h from crc_words),
crc_bytes as (select word, len, len - i as far, ('0x' || substr(h, 2 * i - 1, 2))::int as b from (select word, len, h, unnest(range(1, len + 1)) as i from crc_hex)),
crc as (select w.word, xor(bit_xor(f.c), xor(any_value(z.c), 4294967295)) as crc from crc_bytes w join crc_far f on w.far = f.far and w.b = f.b join crc_zero z on z.len = w.len group by w.word)
"""

SQL = rf"""
with recursive texts as (select 'd' as side, row_number() over () as row, doc_id, text from documents union all select 't', row_number() over (), null, text from benchmark),
worded as (select side, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts),
features as (select side, row, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) as word from worded),
crc_words as (select distinct word from features), {CRC_SQL.strip()},
counted as (select side, row, crc % 10000 as bucket, count(*) as n from features join crc using (word) group by all),
sums as (select bucket, coalesce(sum(n) filter (side = 'd'), 0)::double as s, coalesce(sum(n) filter (side = 't'), 0)::double as t from counted group by 1),
gain as (select bucket, floor(1000 * ln((t + 1) * ((select sum(s) from sums) + 10000) / ((s + 1) * ((select sum(t) from sums) + 10000))))::bigint as gain from sums),
weights as (select row, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n))::bigint as weight from counted join gain using (bucket) where side = 'd' group by 1),
scored as (select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, len(w) as n_words,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5) / 4294967296)))::bigint as score
  from worded left join weights using (row) where side = 'd'),
ranked as (select doc_id, row_number() over (order by score desc, doc_id nulls last) as rank, count(*) over () as n from scored where n_words >= 20)
select s.doc_id, n_features, weight, score, case when rank <= 25 * n // 100 then rank end as rank from scored s left join ranked r on s.doc_id = r.doc_id
"""
