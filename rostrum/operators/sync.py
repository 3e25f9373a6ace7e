"""Sync state: P2, P7, D9, S18, R2."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.operators.marts import ANALYZED
from rostrum.operators.queue import with_analysis, with_speaker
from rostrum.sinks.upsert import split_valid, upsert_by_key

MEMBER_COLUMNS = (
    "id", "bank_code", "name", "role", "status", "term_start", "term_end", "last_speech_date",
    "last_verified_at", "avg_stance_score", "last_updated",
)
SPEECH_COLUMNS = (
    "id", "bank_code", "speaker", "speaker_id", "title", "date", "url", "full_text", "speech_type", "language",
    "fetched_at", "created_at", "stance_score", "stance_reason", "keywords", "main_risk",
)
ANALYSIS_COLUMNS = (
    "url", "speech_id", "stance_score", "stance_reason", "keywords", "main_risk", "analysis_attempts",
    "analysis_status", "analyzed_at",
)


def unsynced_members(members: DataFrame) -> DataFrame:
    """Members never synced or changed since."""
    return members.where(
        F.col("synced_at").isNull() | (F.col("last_updated") > F.col("synced_at"))
    ).select(*MEMBER_COLUMNS)


def unsynced_speeches(speeches: DataFrame, members: DataFrame, analysis: DataFrame, limit: int | None = None) -> DataFrame:
    """Speeches not synced yet, with speaker and result, newest first if limited."""
    open_rows = speeches.where(F.col("synced_at").isNull())
    wide = with_speaker(
        with_analysis(
            open_rows,
            analysis.select("speech_id", "stance_score", "stance_reason", "keywords", "main_risk", "synced_at"),
        ),
        members,
    ).select(*SPEECH_COLUMNS)
    return wide if limit is None else wide.orderBy(F.col("date").desc_nulls_last(), "id").limit(limit)


def unsynced_analysis(analysis: DataFrame, speeches: DataFrame) -> DataFrame:
    """Results not synced yet, with the URL of their speech."""
    open_rows = analysis.where(F.col("synced_at").isNull() & F.col("analysis_status").isin(*ANALYZED))
    return open_rows.join(speeches.select(F.col("id").alias("speech_id"), "url"), "speech_id").select(*ANALYSIS_COLUMNS)


def mark_synced(df: DataFrame, ids: DataFrame, key: str, now: Column) -> DataFrame:
    """Set the sync time of the rows whose key is in `ids`."""
    hit = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    return df.join(hit, key, "left").select(*[
        F.when(F.col("_hit"), now).otherwise(F.col(c)).alias(c) if c == "synced_at" else F.col(c) for c in df.columns
    ])


def synced_rows(ids: DataFrame, key: str, now: Column) -> DataFrame:
    """D9 as a change (see `sinks.deltas`): the keys and their sync time, once each."""
    return ids.select(key).distinct().select(key, now.alias("synced_at"))


def reset_synced(df: DataFrame) -> DataFrame:
    """Everything syncs again."""
    return df.withColumn("synced_at", F.lit(None).cast("timestamp_ntz"))


class Synced(NamedTuple):
    target: DataFrame
    source: DataFrame
    rejected: DataFrame


def incremental_sync(
    source: DataFrame, outgoing: DataFrame, target: DataFrame, keys: list[str], source_key: str, now: Column,
    required: tuple[str, ...],
) -> Synced:
    """Unsynced rows into a target table.

    Rows that break the target's constraints are set aside, the rest are upserted, and
    only rows that landed are marked as synced. One job, whatever the number of rows.
    """
    good, bad = split_valid(outgoing, required)
    return Synced(
        upsert_by_key(target, good, keys),
        mark_synced(source, good.select(F.col(source_key)), source_key, now),
        bad,
    )
