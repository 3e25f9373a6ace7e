"""Registered queries of the training-data operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rostrum.llm import (
    decontaminate, language, licences, near_dedup, packing, periods, perplexity, prefix_trie, quality_rules,
    recurrent, sharding, spans, toxicity)
from rostrum.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_documents(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rule_verdicts(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_sharding, decontaminate.op2_decontamination, toxicity.op3_toxicity, spans.op4_substring_dedup, op5_licences, op6_packing,
        language.op7_language_id, near_dedup.op8_minhash, op9_quality_rules,
        perplexity.op10_kneser_ney, periods.op11_periodic_runs, prefix_trie.op12_prefix_trie,
        recurrent.op13_recurrent_lm)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op5_licences": licences.SQL, "op9_quality_rules": quality_rules.SQL, "op12_prefix_trie": prefix_trie.SQL}
