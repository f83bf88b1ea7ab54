"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, fingerprints, hmm, licenses, line_dedup, mixing, near_dups, neighbours, packing, secrets, sharding, spelling, toxicity
from .common import table

SHARDS = 40


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shards(table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.copies(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of op4's base kinds, which SQL can express."""
    return secrets.secret_spans(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex")


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes and targets of op5, which SQL can express."""
    return mixing.sized(table(spark, sf_dir, "documents"))


OPERATORS = (op1_language_model, op2_sharding, op3_fingerprints, op4_secret_scan, op5_mixing, op6_near_duplicates, op7_toxicity, op8_line_dedup, op9_nearest, op10_packing, op11_spelling_variants, op12_conversation_repair, op13_license_scan)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (*OPERATORS, secret_counts, mixing_targets)}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_near_duplicates": near_dups.SQL, "op8_line_dedup": line_dedup.SQL, "op9_nearest": neighbours.SQL,
        "op11_spelling_variants": spelling.SQL, "op12_conversation_repair": conversations.SQL, "op13_license_scan": licenses.SQL,
        "secret_counts": secrets.COUNTS_SQL, "mixing_targets": mixing.TARGETS_SQL,
    }
