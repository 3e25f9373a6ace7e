"""The training-corpus pipeline: five stages over the documents table.

Every stage takes all rows its predecessor kept and gives rows with the columns of `documents`, the last one pieces
of sequences. Rows with a null id are kept by the stages that tell rows by id (near duplicates, decontamination);
null and letterless texts go with the first stage; repeated rows share a fate, except that near duplicates keep all
rows of a kept id; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostrum.llm import decontaminate, language, near_dedup, packing, spans
from rostrum.llm.common import table
from rostrum.session import materialize, with_package


@with_package
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; learnt from `docs` themselves."""
    return language.keep_known(docs)


@with_package
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by sets of five-word shingles at 0.8."""
    return near_dedup.keep_one(docs)


@with_package
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with passages that an earlier one has cut from their texts."""
    return spans.remove_repeats(docs)


@with_package
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@with_package
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1,024 tokens."""
    return packing.pack_sequences(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can't express the walks, trees and bins of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
