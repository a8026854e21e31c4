"""A corpus in five stages: language, near-duplicates, benchmark passages, personal data, packing.

Every stage works on all that the one before has kept and returns the columns of ``documents``, the last one the packed
pieces. ``run`` writes each stage's result to the shared folder and reads it again. There is no SQL
for it: code lengths, fingerprints and token ids have no SQL form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanweave.llm import bin_slack, pii_bootstrap, ppm_language, simhash_groups, wu_manber
from loanweave.llm.common import unpacked
from loanweave.llm.queries import table, tokenizer_path
from loanweave.session import stage

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null texts and texts that no learned language fits better than the rest."""
    return ppm_language.keep_recognised(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group."""
    return simhash_groups.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth of the words or more lie in benchmark passages."""
    columns = docs.columns
    found = wu_manber.benchmark_passages(docs, table(spark, sf_dir, "benchmark"), columns)
    return unpacked(found.withColumn("n_hit", wu_manber.covered()).where(~wu_manber.contaminated()), columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return pii_bootstrap.mask(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return bin_slack.packed_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii_masking", personal_data),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


