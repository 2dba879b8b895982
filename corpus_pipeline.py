"""Corpus pipeline: quality rules, line dedup, near-dedup, source mixing, encoding.

Counted as part of subpackage ``wellspan.llm``.  Every stage takes (spark, docs, sf_dir) and
returns what it keeps; the first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspan.llm import bpe, lines, minhash, mixing, quality
from wellspan.llm.common import materialize, prepared, table
from wellspan.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORDED = r"[^\x20\x09-\x0D]"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or leave their group's fences go.

    Rows are judged one by one, repeats and null ids too; null and empty texts go.
    """
    prepared(spark)
    return quality.judged(docs, COLUMNS).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line passages go, and documents of which no word is left.

    Rows that nothing was cut from pass as they are, null and empty texts too.
    """
    cut = lines.dedup_lines(docs.select(*COLUMNS))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    left = (F.col("n_removed") == 0) | F.col("text").rlike(WORDED)
    return cut.where(left).withColumn("n_chars", n_chars).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays: the one with the smallest id.

    Rows count, not ids: of rows without an id, of equal rows and of rows that share an id,
    one of each component stays too.  Texts without words are no copies of anything.
    """
    prepared(spark)
    return minhash.one_of_each(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each stretch of a document in a taken block, repeats included.

    Null and wordless texts have no words to take and leave no row.
    """
    prepared(spark)
    planned = mixing.mix(docs, keep=("lang",))
    return mixing.mixed_texts(planned).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every stretch, with the digest of what they decode to; null is the empty text."""
    prepared(spark)
    return bpe.encode_texts(docs, tokenizer_path(), ["doc_id", "lang", "source"], outputs=("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("encoding", encode),
]

#: Sketches, signatures and permutations have no SQL form; tests hold run() to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each cut off through the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
