"""Queries over the synthetic tables, one per training-data operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, exact, html, lines, minhash, mixing, pii, preference, quality, resample, toxicity, trie
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring conversations, 2k and 2k + 1, are pair k: the even id is chosen, the odd one rejected."""
    conv = F.col("conv_id")
    return preference.preference_pairs(table(spark, sf_dir, "conversations"), F.shiftright("conv_id", 1), conv % 2 == 0)


def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.neighbours(vectors, vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id")), 20)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.mix(table(spark, sf_dir, "documents"), texts=False)
    return mixing.taken_words(planned).select("doc_id", "size", "source_size", "target", "taken")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = toxicity.fit(docs, labels.where(~held_out).select("doc_id", "toxic"))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), tokenizer_path(), ["doc_id"], outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(table(spark, sf_dir, "documents"), minhash.Threshold(width=3, num=85, den=100))


def op9_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs), ["doc_id"])


def op10_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.judged(table(spark, sf_dir, "documents"), ["doc_id"]).select(*names)


def op11_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.judged(table(spark, sf_dir, "documents"))


def op12_louds_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_nodes(table(spark, sf_dir, "conversations"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample.resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


_OPERATORS = (
    op1_preference_format, op2_cross_polytope, op3_line_dedup, op4_source_mix, op5_html, op6_toxicity, op7_bpe, op8_minhash, op9_skip_chain_pii,
    op10_adaptive_quality, op11_bloom_dedup, op12_louds_trie, op13_target_resampling,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _OPERATORS}
ORACLES: dict[str, str] = {
    "op1_preference_format": preference.SQL, "op3_line_dedup": lines.SQL, "op8_minhash": minhash.SQL,
    "op11_bloom_dedup": exact.SQL, "op12_louds_trie": trie.SQL, "op13_target_resampling": resample.SQL,
}
