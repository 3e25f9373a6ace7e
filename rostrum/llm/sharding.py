"""Sharding by vector bin packing (operator 1).

Groups of equal texts are vectors (bytes, tokens, rows). Each is placed in the shard where the dot
product of its vector with the shard's residual capacity is highest, so that a group heavy
in one resource goes where that resource is left over.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import SPACE, add_slots
from rostrum.session import materialize

LOADS = ("bytes", "tokens", "n_rows")


def place(loads: np.ndarray, bins: int, share: np.ndarray | None = None) -> np.ndarray:
    """Bin per vector of `loads` (n x d), taken in the given order.

    A bin's capacity is an equal part of the sum, in units of which all loads are measured.
    The bin with the highest dot product of item and residual wins, the lowest number on
    ties; a bin that is full in some dimension counts with a negative residual there.
    """
    total = loads.sum(axis=0)
    unit = np.where(total > 0, total / bins, 1.0)
    items = loads / unit
    left = np.ones((bins, loads.shape[1])) if share is None else share.copy()
    out = np.empty(len(items), dtype=np.int32)
    for i, item in enumerate(items):
        best = int(np.argmax(left @ item))
        left[best] -= item
        out[i] = best
    return out


def _descending(frame: pd.DataFrame) -> pd.DataFrame:
    loads = frame[list(LOADS)].to_numpy(float)
    total = loads.sum(axis=0)
    top = (loads / np.where(total > 0, total, 1.0)).max(axis=1)
    keys = [frame[c] for c in ("part", "key") if c in frame] + [-top]
    return frame.iloc[np.lexsort(keys)].reset_index(drop=True)


def _lots(lots: int, tail: float):
    """Pack one slice into `lots` large lots and, from its lightest items, `lots` small ones.

    The small lots, together `tail` of the slice, let the last step level out what the
    large ones leave uneven.
    """
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = _descending(frame)
        loads = frame[list(LOADS)].to_numpy(float)
        after = loads[::-1].cumsum(axis=0)[::-1] / np.where(loads.sum(axis=0) > 0, loads.sum(axis=0), 1.0)
        light = (after <= tail).all(axis=1)
        lot = np.empty(len(frame), dtype=np.int64)
        lot[~light] = place(loads[~light], lots)
        lot[light] = lots + place(loads[light], lots)
        return pd.DataFrame({"slice": frame["slice"], "key": frame["key"], "part": frame["part"], "lot": lot})

    return run


def _shards(shards: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = _descending(frame)
        return pd.DataFrame({
            "key": frame["key"], "part": frame["part"], "shard": place(frame[list(LOADS)].to_numpy(float), shards)})

    return run


def pack_shards(
    docs: DataFrame, shards: int = 16, text_col: str = "text", id_col: str = "doc_id", slice_items: int = 8192,
    lots: int = 64, tail: float = 0.03, block_rows: int = 10_000,
) -> DataFrame:
    """Place all rows: (id, size, text_crc32, tokens, text_key, part, shard, slot).

    `size` is the UTF-8 bytes of the text (null: none) plus 1, tokens are space-separated words,
    and the sums of bytes, tokens and rows are balanced together. Rows of equal text go to one
    shard, except that a group larger than half a shard in any of the three is cut into parts of
    about an eighth of a shard by the hash of the id: there are at most 6 * shards such
    groups, whose list is therefore broadcast. Null and empty texts are groups like others.
    Repeated rows, and rows that share an id, are all placed. An empty table gives no rows.

    More than `slice_items` groups are packed in steps: slices of about that many, dealt by
    hash, are packed into lots by the same rule, and lots are packed in turn, until few
    enough are left for one step into shards. Every task holds one slice, whatever the
    size of the table; slots are counted by blocks.
    """
    text = F.col(f"`{text_col}`")
    narrow = docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.when(F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]"),
               F.size(F.split(F.trim(F.translate(text, "\t\n\u000b\f\r", "     ")), SPACE))).otherwise(0).cast("long").alias("tokens"),
        F.xxhash64(text, text.isNull()).alias("key"),
    )
    narrow = materialize(narrow, "shard-rows")
    sums = narrow.agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")).first()
    load = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")]
    # How many half shards a group fills, in its largest dimension.
    halves = F.greatest(*[
        F.col(c) * 2.0 * shards / float(max(sums[c] or 0, 1)) for c in LOADS
    ])
    groups = narrow.groupBy("key").agg(*load)
    large = groups.where((halves > 1.0) & (F.col("n_rows") > 1)).select("key", F.ceil(halves * 4).cast("int").alias("_parts"))
    parted = narrow.join(F.broadcast(large), "key", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64(id_col), "_parts"), F.lit(0)).cast("int")).drop("_parts")
    units = materialize(parted.groupBy("key", "part").agg(*load), "shard-units")

    maps: list[DataFrame] = []
    level, count = units, units.count()
    while count > slice_items:
        slices = -(-count // slice_items)
        sliced = level.withColumn("slice", F.pmod(F.xxhash64("key", "part", F.lit(len(maps))), F.lit(slices)).cast("int"))
        in_lots = sliced.groupBy("slice").applyInPandas(_lots(lots, tail), "slice int, key long, part int, lot long")
        in_lots = materialize(in_lots.select(
            "key", "part", F.col("slice").cast("long").alias("up_key"), F.col("lot").cast("int").alias("up_part")), "shard-lots")
        maps.append(in_lots)
        level = materialize(level.join(in_lots, ["key", "part"]).groupBy(
            F.col("up_key").alias("key"), F.col("up_part").alias("part")).agg(
                *[F.sum(c).alias(c) for c in LOADS]), "shard-level")
        if (fewer := level.count()) >= count:
            raise ValueError("slice_items must be well above 2 * lots")
        count = fewer
    # At most slice_items rows: one task by construction.
    placed = level.groupBy(F.lit(0).alias("all")).applyInPandas(_shards(shards), "key long, part int, shard int")
    placed = reduce(
        lambda top, lower: lower.join(
            top.select(F.col("key").alias("up_key"), F.col("part").alias("up_part"), "shard"), ["up_key", "up_part"],
        ).select("key", "part", "shard"),
        reversed(maps), materialize(placed, "shard-placed"))
    out = parted.join(materialize(placed, "shard-map") if maps else placed, ["key", "part"])
    blocks = max(1, (sums["n_rows"] or 0) // shards // block_rows * 2)
    spread = F.pmod(F.xxhash64(id_col, "text_crc32", "size"), F.lit(blocks)).cast("int")
    out = add_slots(out.withColumn("_block", spread), "shard", "_block", id_col, "text_crc32", "size", "key")
    return out.select(id_col, "size", "text_crc32", "tokens", F.col("key").alias("text_key"), "part", "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The query's form: law 'bytes', sizes near equal; no shard is added."""
    return pack_shards(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens", "text_key", "part")
