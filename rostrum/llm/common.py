"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.session import materialize

SLICE_BYTES = 4 << 20

#: Words of the contracts: runs of characters other than the six ASCII spaces.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """True where crc32 of the id as text leaves `part`; an id that is null is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in row ranges whose text stays near `limit` bytes, so that a worker's memory
    does not follow the batch size setting. One longer text is a range of its own."""
    if batch.num_rows == 0:
        return
    values = batch.column(batch.schema.get_field_index(column))
    sizes = np.asarray(pa.compute.binary_length(values).fill_null(0)).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


_TYPES = {"long": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "string": T.StringType,
          "boolean": T.BooleanType, "binary": T.BinaryType}


def fields(ddl: str) -> T.StructType:
    """A flat schema from 'name type, ...'; unlike Spark's own parser it needs no session, so
    modules can be imported before one exists, and by workers."""
    return T.StructType([T.StructField(n, _TYPES[t]()) for n, t in map(str.split, ddl.split(","))])


def record_batch(schema: T.StructType, columns: dict[str, object]) -> pa.RecordBatch:
    """Columns (arrays or lists) as a batch with the Arrow types of `schema`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(schema)
    arrays = [
        v if isinstance(v := columns[f.name], pa.Array) and v.type == f.type else pa.array(v, type=f.type, from_pandas=True)
        for f in fields
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=fields)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values (the public splitmix64 finalizer)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def components(edges: DataFrame, purpose: str, rounds: int = 40) -> DataFrame:
    """Connected components of undirected `edges` (a, b): rows (id, component), where the
    component is the smallest id. Only ids that have an edge are returned.

    Alternating large-star and small-star contraction: every round replaces edges by edges
    to smaller neighbours, so a path of n ids needs about log n rounds and a star one. Only
    two ids per row are moved, neighbours are never gathered, and the smallest neighbour of a
    hub is a map-side aggregate. Each round is written to the shared folder.
    """
    kind = edges.schema["a"].dataType.simpleString()
    now = edges.where(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
    ).distinct()
    now = materialize(now, purpose)
    seen = None
    for _ in range(rounds):
        both = now.select(F.inline(F.array(
            F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")), F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")))))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(smallest, "u").select(
            F.col("m").alias("lo"), F.col("v").alias("hi")).where(F.col("lo") != F.col("hi")).distinct()
        # Written, as both sides of the next join would otherwise plan and run all of it.
        large = materialize(large, purpose)
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select("m", F.explode(F.array("lo", "hi")).alias("v")).where(
            F.col("m") != F.col("v")).select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        now = materialize(small, purpose)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    pairs = now.groupBy("hi").agg(F.min("lo").alias("lo"))
    roots = pairs.select(F.col("lo").alias("id")).distinct().select("id", F.col("id").alias("component"))
    found = pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots)
    return found.select(F.col("id").cast(kind), F.col("component").cast(kind))


def add_slots(df: DataFrame, group: str, block: str, *order: str, name: str = "slot") -> DataFrame:
    """`name`: gapless positions from 0 inside each `group`.

    Rows are numbered inside (group, block) and shifted by the rows of the group's earlier
    blocks, so a group of any size uses as many tasks as it has blocks. Blocks must be of
    bounded size; the table of block counts is far smaller than the rows.
    """
    from pyspark.sql import Window

    counts = df.groupBy(group, block).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, block).orderBy(*order)
    out = df.withColumn("_row", F.row_number().over(inside) - 1).join(starts, [group, block])
    return out.select(*df.columns, (F.col("_start") + F.col("_row")).cast("long").alias(name))
