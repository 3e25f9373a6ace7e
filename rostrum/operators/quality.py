"""Data-quality checks: Q1-Q5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.text import MOJIBAKE_MARKER
from rostrum.operators.members import orphan_speakers


def check_orphans(speeches: DataFrame, members: DataFrame) -> DataFrame:
    """Q1: number of speeches whose speaker is no member."""
    return orphan_speakers(speeches, members).agg(F.count(F.lit(1)).alias("n"))


def check_duplicates(speeches: DataFrame) -> DataFrame:
    """Q2: number of groups of copies by bank, date, title and speaker."""
    groups = speeches.groupBy("bank_code", "date", "title", "speaker_id").agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.count_if(F.col("copies") > 1).alias("n"))


def check_mojibake(speeches: DataFrame, marker: str = MOJIBAKE_MARKER) -> DataFrame:
    """Q3: number of rows whose text or title carries the marker."""
    def has(column: str) -> Column:
        return F.coalesce(F.col(column).contains(marker), F.lit(False))

    return speeches.agg(F.count_if(has("full_text") | has("title")).alias("n"))


def check_member_unique(members: DataFrame) -> DataFrame:
    """Q4: number of (bank, name) pairs with more than one member."""
    pairs = members.groupBy("bank_code", "name").agg(F.count(F.lit(1)).alias("copies"))
    return pairs.agg(F.count_if(F.col("copies") > 1).alias("n"))


def quality_report(speeches: DataFrame, members: DataFrame, marker: str = MOJIBAKE_MARKER) -> DataFrame:
    """Q5: one row per check. Copies are a warning, the rest are errors."""
    checks = (
        ("orphan_speakers", "error", check_orphans(speeches, members)),
        ("duplicate_speeches", "warning", check_duplicates(speeches)),
        ("mojibake", "error", check_mojibake(speeches, marker)),
        ("duplicate_members", "error", check_member_unique(members)),
    )
    rows = [
        df.select(F.lit(name).alias("check"), F.lit(level).alias("severity"), "n", (F.col("n") == 0).alias("passed"))
        for name, level, df in checks
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out
