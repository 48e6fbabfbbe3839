"""The corpus pipeline: language ID, toxicity, near duplicates, secrets, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works
on every row that its predecessor kept. All but the last return the columns of
``documents``; the last returns the bins (one row per piece of a document).
``run`` writes each stage's result as Parquet to the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobmart.llm import language, ngram_join, packing, secrets, toxicity
from jobmart.llm.common import read_table, saved


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: rows whose language is rejected go."""
    return language.drop_rejected(docs)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: rows that are predicted toxic go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one row of each group of linked documents stays."""
    return ngram_join.one_of_each_group(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: every secret is replaced by its kind; no row goes."""
    return secrets.redact(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: conflict-constrained best-fit bins."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", remove_toxic),
    ("ngram_jaccard_join", remove_near_duplicates),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_bins),
]

# Trained models and a seeded join: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bins of ``documents`` after all stages."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
