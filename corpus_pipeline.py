"""Raw documents to token files: language, near duplicates, benchmark leaks, mixture, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterlint.llm import decontamination, jaccard_join, language, mixing, token_files
from masterlint.llm.common import documents, written
from masterlint.llm.queries import tokenizer


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that have a language; those without a letter, null texts too, go. The score is no ground: it
    grows with length. Repeated rows stay; an empty table stays empty; other columns may have any names."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("others"), "text")
    scored = language.identify(rows, language.learn(docs), ["others", "text"]).where(F.col("lang_pred") != language.UNKNOWN)
    return scored.select(*[F.col("text") if c == "text" else F.col("others")[c].alias(c) for c in docs.columns])


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: see one_of_each."""
    return jaccard_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item; null and empty texts hold none, repeated rows go or stay alike."""
    return decontamination.without_leaks(docs, documents(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it: a null text or one without a word is taken like others."""
    return mixing.mix(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' rows, read back: doc_id, start, n_tokens and ids."""
    folder = token_files.write_tokens(docs, tokenizer("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, folder)


STAGES = [
    ("language ID", identified),
    ("n-gram Jaccard join", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("source mixing", mixed),
    ("token output", tokenized),
]

# The first and last stage have no SQL form: vectors, and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
