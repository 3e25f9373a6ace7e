"""Run logs and status events: S4, S5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum import schemas
from rostrum.functions import dates, logs


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Text logs as (source, block, seq, value).

    Line order survives the split of a file: `block` is the offset of the split in the
    file and `seq` grows within it.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def parse_log(lines: DataFrame) -> DataFrame:
    """Structured lines; blank lines and lines with fewer than four parts are dropped.

    Keeps every other column of `lines`; adds ts_text, ts, level, logger, message,
    extra_text, extra and raw.
    """
    keep = [c for c in lines.columns if c != "value"]
    # `inline` keeps the filter above the parser; pushed down, it would parse again.
    parsed = lines.select(*keep, F.trim("value").alias("raw"), F.inline(F.array(logs.parse_line(F.col("value")))))
    return parsed.where(F.col("ts_text").isNotNull()).select(
        *parsed.columns,
        dates.log_time(F.col("ts_text")).alias("ts"),
        logs.parse_kv(F.col("extra_text")).alias("extra"),
    )


def read_status_events(spark: SparkSession, path: str) -> DataFrame:
    """Append-only status events, one JSON object per line."""
    return spark.read.schema(schemas.STATUS_EVENTS).json(path)
