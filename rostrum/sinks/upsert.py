"""Keyed upserts and row constraints: S10, S17."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FROZEN = ("url", "bank_code", "name", "id", "speech_id")  # fixed values: never updated


def default_keys(columns: list[str], table: str) -> list[str]:
    """Members by id, or bank and name without one; everything else by URL."""
    if table.endswith("members"):
        return ["id"] if "id" in columns else ["bank_code", "name"]
    return ["url"]


def upsert_by_key(target: DataFrame, incoming: DataFrame, keys: list[str], frozen: tuple[str, ...] = FROZEN) -> DataFrame:
    """Insert, or update on equal key.

    Columns in `frozen` keep their old value on update; columns the incoming rows do not
    have keep theirs too. Keys are unique on both sides, so the full outer join has no hot
    key. The result goes to a new directory (see `sinks.tables`), never over its input.
    """
    old = target.withColumn("_old", F.lit(True))
    new = incoming.select(*keys, F.struct(*incoming.columns).alias("_new"))
    have = set(incoming.columns)

    def merged(column: str):
        if column in keys:
            return F.col(column)
        if column not in have:
            return F.col(column)
        value = F.col("_new")[column]
        if column.lower() in frozen:
            return F.when(F.col("_old"), F.col(column)).otherwise(value).alias(column)
        return F.when(F.col("_new").isNotNull(), value).otherwise(F.col(column)).alias(column)

    return old.join(new, keys, "full_outer").select(*[merged(c) for c in target.columns])


def split_valid(df: DataFrame, required: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy the sink, rows that do not). A row is bad if a required
    column is null, which includes values a cast could not read."""
    ok = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True))
    return df.where(ok), df.where(~ok)
