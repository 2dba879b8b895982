"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import with_code

#: Words are runs of anything but space and U+0009..U+000D.  ``bytes.split()``
#: splits on exactly this set, so Python code counts words on UTF-8 bytes.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Most rows of a lookup side that are broadcast; larger sides are shuffled.
BROADCAST_ROWS = 100_000

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


#: Texts vary from a word to megabytes: batches to Python are bounded by bytes, not rows.
BATCH_BYTES = "8m"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with this package known to its workers and batches to them kept small.

    The bound on batches stays set for the session: it is read when a result is computed,
    which is after these functions have returned.  A bound that the caller has set stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # its default
        spark.conf.set(key, BATCH_BYTES)
    return with_code(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, below the cluster's ``spark.checkpoint.dir``.

    Where that is unset a temporary folder will do in local mode, and nowhere else: executors
    do not see folders of the driver.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="wellspan-"))
    return context._jsc.sc().getCheckpointDir().get()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Written as Parquet in the shared folder and read again: later reads take only the columns
    and, by the files' statistics, the ranges that they need."""
    path = f"{_shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a materialized lookup side for broadcast if its row count allows it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def beside(keep: Iterable[str], outputs: Iterable[str]) -> list[str]:
    """Columns to carry along; an operator's own outputs win over columns of their names."""
    own = {x.lower() for x in outputs}
    return [c for c in dict.fromkeys(keep) if c.lower() not in own]


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash per window of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n < 1:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for i in range(width):
            total = total * np.uint64(0x9E3779B97F4A7C15) + mix64(hashes[i : i + n] + np.uint64(i))
        return mix64(total)


def text_bytes(texts: Iterable) -> Iterable[bytes]:
    """UTF-8 bytes of an Arrow string column; null is the empty text."""
    for x in texts:
        yield (x.as_py() or "").encode("utf-8", "surrogatepass")
