"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableaudit.llm import decontam, langid, mixing, neardedup, tokens
from tableaudit.llm.common import staged, table
from tableaudit.llm.queries import tokenizer_path

# A document whose language is less certain than this is rejected, as is one without letters.
LEAST_SCORE = 0.5
# Near duplicates share this share of their five-word shingles; with so many tables
# a pair at the threshold is missed with probability 9e-5.
NEAR_PERCENT, NEAR_TABLES = 80, 14


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known."""
    model = langid.train(langid.training_rows(docs))
    found = langid.languages(docs, model, carry=True)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return neardedup.one_of_each(docs, NEAR_PERCENT, tables=NEAR_TABLES)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without a benchmark window."""
    return decontam.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix asks; a document taken twice is two rows."""
    return mixing.mixed_rows(mixing.mix(docs)).select("row.*")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and describes each document from them."""
    return tokens.token_digest(docs, tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("source_mix", mixing_stage),
    ("token_files", token_stage),
]

# Languages are predicted by a trained model and ids by a tokenizer: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
