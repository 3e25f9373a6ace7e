"""Running counts over long ordered sequences without one task per sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_count(
    df: DataFrame, source: str, block: str, seq: str, flag: Column, name: str, total: str | None = None
) -> DataFrame:
    """`name` becomes the number of flagged rows up to and including each row, in (block, seq) order, and `total`
    (if given) the number in the whole source; see `running_sum`."""
    return running_sum(df, source, block, seq, F.coalesce(flag, F.lit(False)).cast("int"), name, total)


def running_sum(
    df: DataFrame, source: str, block: str, seq: str, value: Column, name: str, total: str | None = None
) -> DataFrame:
    """Rows of a source are cut into blocks of bounded size; `name` becomes the sum of `value` (null: 0) up to
    and including each row, in (block, seq) order, and `total` (if given) that of the whole source.

    Values are summed per block, the blocks (far fewer than rows) are summed up in order,
    and the sum inside a block starts from the one before it. A source of any length is
    spread over as many tasks as it has blocks.
    """
    one = F.coalesce(value, F.lit(0)).cast("long")
    per_block = df.groupBy(source, block).agg(F.sum(one).alias("_in_block"))
    blocks = Window.partitionBy(source)
    before = blocks.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_block.select(
        source, block, F.coalesce(F.sum("_in_block").over(before), F.lit(0)).alias("_start"),
        F.sum("_in_block").over(blocks).alias("_total"),
    )
    inside = Window.partitionBy(source, block).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn("_count", F.sum(one).over(inside)).join(starts, [source, block])
    extra = [F.col("_total").alias(total)] if total else []
    return out.select(*df.columns, (F.col("_start") + F.col("_count")).alias(name), *extra)
