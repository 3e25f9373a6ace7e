"""Writers: S14, S19, S20, S21."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.sinks import manifest

TABLE = "table"
SUMMARY_COLUMNS = (
    "run_id", "started_at", "status", "duration_sec", "total_new", "total_refreshed", "analyzed_items",
    "synced_items", "failed_steps",
)


def replace_table(df: DataFrame, root: str, version: int) -> None:
    """Publish a full rebuild as a new version below `root`.

    Readers keep the version they started with, a lost executor only repeats tasks, and a
    job may read the version before the one it writes. A retry replaces its own version
    and nothing else; what a writer that died has left is never read.
    """
    manifest.publish_tables({TABLE: df}, root, version)


def read_latest(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest published version (below `before`)."""
    return manifest.tables_of(spark, root, before=before)[TABLE].read(spark)


def append_summary(summary: DataFrame, path: str) -> None:
    """One CSV row per run, one folder per month of its start."""
    rows = summary.select(
        *[
            F.round("duration_sec", 3).alias(c) if c == "duration_sec"
            else F.coalesce(c, F.lit("")).alias(c) if c == "failed_steps" else F.col(c)
            for c in SUMMARY_COLUMNS
        ],
        F.date_format("started_at", "yyyy-MM").alias("month"),
    )
    rows.write.mode("append").partitionBy("month").option("header", True).csv(path)


def export_snapshot(tables: dict[str, DataFrame], root: str, version: int) -> None:
    """The whole store, every table as it is now, as one version below `root`."""
    manifest.publish_tables(tables, root, version)


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """All tables of one version, the newest without one given."""
    return {name: table.read(spark) for name, table in manifest.tables_of(spark, root, version).items()}


def write_log(df: DataFrame, line: Column, path: str) -> None:
    """Formatted log lines as text files."""
    df.select(line.alias("value")).write.mode("append").text(path)
