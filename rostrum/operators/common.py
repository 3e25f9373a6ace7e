"""Helpers shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.basic import strip  # noqa: F401  (re-exported for operator modules)


def as_date(value: str | dt.date) -> Column:
    """The explicit 'today' of a job."""
    return F.lit(str(value)[:10]).cast("date")


def as_time(value: str | dt.datetime) -> Column:
    """The explicit 'now' of a job, zone-free."""
    return F.lit(str(value)).cast("timestamp_ntz")


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first by `order`.

    An aggregate, not a ranking window: copies are reduced before the shuffle, so a key
    holding a third of all rows costs one row per input partition. Rows that tie in `order`
    must be equal.
    """
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def keep_first_by_id(df: DataFrame, keys: list[str], row_id: str, *order: Column) -> DataFrame:
    """As `first_per_key` where rows have a unique id and many copies are wide: the choice is
    made on key, order and id only, and the rows are then selected by a semi join."""
    narrow = df.select(*keys, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("_order"), row_id)
    kept = narrow.groupBy(*keys).agg(F.min_by(row_id, "_order").alias(row_id))
    return df.join(kept.select(row_id), row_id, "left_semi").select(*df.columns)


def left_join_spread(left: DataFrame, right: DataFrame, key: str, spread: str) -> DataFrame:
    """A left join on a key that is null in a large part of `left`. Such rows meet nothing; they are dealt to
    tasks by `spread` instead of all going to the task of the null key."""
    dealt = left.withColumn("_none", F.when(F.col(key).isNull(), F.xxhash64(spread)).otherwise(F.lit(0)))
    return dealt.join(right.withColumn("_none", F.lit(0).cast("long")), [key, "_none"], "left").drop("_none")


def settle_ids(rows: DataFrame, keys: list[str], taken: DataFrame | None = None) -> DataFrame:
    """Hash ids made unique: `rows` has `id` and `_new` (true where the id is a new hash).

    With some billions of rows two 64-bit hashes can be expected to meet once. Ids that
    occur more than once, here or in `taken`, are found by a count on the id alone, and the
    new ones among them are hashed again with a mark.
    """
    ids = rows.select("id") if taken is None else rows.select("id").unionByName(taken.select("id"))
    clashes = ids.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(
        "id", F.lit(True).alias("_clash")
    )
    again = F.col("_new") & F.col("_clash").isNotNull()
    return rows.join(clashes, "id", "left").withColumn(
        "id", F.when(again, F.xxhash64(*keys, F.lit("again"))).otherwise(F.col("id"))
    ).select(*[c for c in rows.columns if c != "_new"])


def split_rows(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the condition, all others). An update that can only concern the
    first part joins that part alone; the others pass through without a shuffle."""
    meets = F.coalesce(condition, F.lit(False))
    return df.where(meets), df.where(~meets)
