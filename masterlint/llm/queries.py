"""The operators over their whole tables: one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterlint.llm import conversations, decontamination, jaccard_join, language, lines, mixing, passages, quality, sharding, spelling, token_counts, token_files, toxicity
from masterlint.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.cluster(documents(spark, sf_dir))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "n_copies")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, current = quality.POLICIES[0], quality.POLICIES[-1]
    decided = quality.decide(quality.ledger(documents(spark, sf_dir)))
    return decided.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~F.col(f"kept_{base.version}")).alias("base_failed"),
        F.col(f"kept_{current.version}").alias("kept"),
        F.col("failed").alias("failed_rules"),
    )


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_lines(documents(spark, sf_dir))


def sharding_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", F.expr("coalesce(crc32(CAST(doc_id AS string)) % 3 = 1, false)"))
    prototypes = language.learn(docs.where("NOT held_out"))
    return language.identify(docs, prototypes, ["doc_id", "held_out"])


def token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_tokens(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return token_files.checksums(token_files.read_tokens(spark, folder))


def token_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.removals(documents(spark, sf_dir))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", F.expr("coalesce(crc32(CAST(doc_id AS string)) % 5 = 0, false)"))
    model = toxicity.learn(docs.where("NOT held_out"), documents(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, ["doc_id", "held_out"])


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired(documents(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": ngram_jaccard_join,
    "op2_source_mixing": source_mixing,
    "op3_quality_rules": quality_rules,
    "op4_line_dedup": line_dedup,
    "op5_sharding": sharding_minimax,
    "op6_decontamination": benchmark_decontamination,
    "op7_language_id": language_id,
    "op8_token_output": token_id_output,
    "op9_token_counts": token_counting,
    "op10_substring_dedup": substring_dedup,
    "op11_spelling_variants": spelling_variants,
    "op12_toxicity": toxic_documents,
    "op13_conversation_repair": conversation_repair,
}
