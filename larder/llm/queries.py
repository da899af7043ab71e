"""The operators as queries over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import importlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, counts, divergence, infill, language, lines, mixing, order, passages, quality, search, simhash, suffix
from larder.sources import new_path

TOKEN_LIMIT = 2048
#: The least score that is predicted as quality 1.
GOOD = 0.3
#: Free in the vocabulary of byte_bpe_multi_50k.tiktoken.
PAD = 50256

# Spark's own settings, safe on a running session. Batches to Python are bounded
# in bytes, as documents differ in length by orders of magnitude.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for setting, value in SETTINGS.items():
        spark.conf.set(setting, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def round_trip_digests(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """Counts and digests of ``(doc_id, ids)`` and of the decoded ids."""
    return ids.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), path, pattern), 256).alias("decoded_sha256"),
    )


def op1_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of what they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return round_trip_digests(bpe.encode(table(spark, sf_dir, "documents"), path, pattern), path, pattern)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    profiles = language.learn(docs.where(~held_out))
    predicted = docs.select("doc_id", held_out.alias("held_out"), language.predict(F.col("text"), profiles).alias("p"))
    return predicted.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the bytes of repeated 400-byte strings."""
    done = suffix.remove_repeats(table(spark, sf_dir, "documents"), length=400, keep="none")
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return done.select(
        "row.doc_id",
        "n_bytes",
        n_removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("removed") > 0).alias("has_repeats"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many repeat others, and the digest of the rest."""
    done = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op7_exact_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest inner products of every fiftieth vector with all others."""
    rows = table(spark, sf_dir, "embeddings")
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double"))
    vectors = rows.where(search.usable(F.col("embedding").cast("array<double>"))).select("vec_id", whole.alias("vector"))
    best = search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)
    return best.select("query_id", "rank", F.col("id").alias("vec_id"), F.col("score").cast("long").alias("score"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    mix = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mix.select("row.doc_id", "size", "source_size", "target", taken)


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of token sequences in training order, and the digest of each record as read back."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    tokens = bpe.encode(table(spark, sf_dir, "documents"), path, pattern)
    shards = new_path(spark, "training-order")
    index = order.materialise(tokens, shards, seed=9, pad=PAD)
    records = order.read_records(spark, shards).select("slot", order.digest(F.col("record")).alias("record_sha256"))
    return index.join(records, "slot")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return counts.count_tokens(table(spark, sf_dir, "documents"), path).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every document's fill-in-the-middle example, and of the text restored from it."""
    return infill.digests(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ from each other, and their most overused terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from labels that aren't held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    model = passages.fit(docs.where(~held_out), labels.where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), passages.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


OPERATORS = (
    op1_simhash_groups,
    op2_bpe_round_trip,
    op3_language,
    op4_repeated_bytes,
    op5_quality_rules,
    op6_fuzzy_lines,
    op7_exact_top5,
    op8_source_mix,
    op9_training_order,
    op10_token_counts,
    op11_infill,
    op12_source_divergence,
    op13_quality_score,
    pipeline,
)
QUERIES = {f.__name__: f for f in OPERATORS}
ORACLES = {
    "op5_quality_rules": quality.oracle_sql(),
    "op7_exact_top5": search.oracle_sql(),
    "op8_source_mix": mixing.oracle_sql(),
    "op11_infill": infill.oracle_sql(),
    "op12_source_divergence": divergence.oracle_sql(),
}
