"""One-off table changes: P4, P5."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum import schemas

MOVED = ("stance_score", "stance_reason", "keywords", "main_risk", "analysis_attempts", "analysis_status")


def split_columns(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A speeches table with analysis columns -> (speeches, analysis).

    Only rows with a status get an analysis row.
    """
    analysis = wide.where(F.col("analysis_status").isNotNull()).select(
        F.col("id").alias("speech_id"), *[c for c in MOVED if c in wide.columns]
    )
    return wide.drop(*MOVED), analysis


def add_missing_columns(df: DataFrame, table: str) -> DataFrame:
    """P5: the table with every declared column; absent ones are null."""
    declared = {
        "speeches": schemas.SPEECHES, "analysis": schemas.ANALYSIS,
        "members": schemas.MEMBERS, "stage_runs": schemas.STAGE_RUNS,
    }[table]
    return schemas.conform(df, declared)
