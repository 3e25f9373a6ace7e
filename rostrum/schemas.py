"""Explicit schemas of the tables at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYWORDS = T.ArrayType(
    T.StructType([T.StructField("category", T.StringType()), T.StructField("detail", T.StringType())])
)

SPEECHES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("bank_code", T.StringType()),
    T.StructField("speaker_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("url", T.StringType()),
    T.StructField("full_text", T.StringType()),
    T.StructField("speech_type", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("synced_at", T.TimestampNTZType()),
])

ANALYSIS = T.StructType([
    T.StructField("speech_id", T.LongType()),
    T.StructField("stance_score", T.DoubleType()),
    T.StructField("stance_reason", T.StringType()),
    T.StructField("keywords", T.StringType()),
    T.StructField("main_risk", T.StringType()),
    T.StructField("analysis_attempts", T.IntegerType()),
    T.StructField("analysis_status", T.StringType()),
    T.StructField("analyzed_at", T.TimestampNTZType()),
    T.StructField("synced_at", T.TimestampNTZType()),
])

MEMBERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("bank_code", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("term_start", T.DateType()),
    T.StructField("term_end", T.DateType()),
    T.StructField("last_speech_date", T.DateType()),
    T.StructField("last_verified_at", T.DateType()),
    T.StructField("last_updated", T.TimestampNTZType()),
    T.StructField("avg_stance_score", T.DoubleType()),
    T.StructField("synced_at", T.TimestampNTZType()),
])

STAGE_RUNS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("stage_name", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("finished_at", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("item_count", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("details_json", T.StringType()),
])

STATUS_EVENTS = T.StructType([
    T.StructField("service", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("event_at", T.TimestampNTZType()),
    T.StructField("new_items", T.LongType()),
    T.StructField("refreshed_items", T.LongType()),
    T.StructField("analyzed_items", T.LongType()),
    T.StructField("synced_items", T.LongType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """P5: columns of `schema` in order; absent ones are added as typed nulls."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])
