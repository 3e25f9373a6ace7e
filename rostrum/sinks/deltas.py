"""Merge on read: a wide table and narrow files of changes.

Changing one column of some rows writes these rows' keys and that column, not the table. A reader folds
the changes by key and joins them to the base; without inserts the base isn't shuffled if the changes are
small enough for the optimizer to broadcast. `compact` writes a new base when the changes have grown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.sinks import manifest
from rostrum.sinks.manifest import Published
from rostrum.sinks.upsert import FROZEN

BASE, CHANGES = "base", "changes"
INSERTS = "insert"
UPDATES = "update"


def _change_schema(schema: T.StructType) -> T.StructType:
    """The base's columns, the names of those a change sets, its number, and whether it may add a row."""
    columns = [T.StructField(f.name, f.dataType) for f in schema]
    return T.StructType([*columns, T.StructField("_set", T.ArrayType(T.StringType())), T.StructField("_seq", T.LongType()),
                         T.StructField("_insert", T.BooleanType())])


def create(df: DataFrame, root: str, version: int = 0) -> None:
    """A table without changes."""
    base = Published(df.schema, (manifest.write_part(df, root),))
    manifest.publish(df.sparkSession, root, version, {BASE: base, CHANGES: Published(_change_schema(df.schema), ())})


def write_change(rows: DataFrame, root: str, keys: list[str], insert: bool = False) -> int:
    """Publish one change: the columns of `rows` beside `keys` get their values there. Returns the new version.

    Keys are unique in `rows`. With `insert` a key that the table doesn't have becomes a row, whose other columns
    are null; without it such a key changes nothing. Nothing but `rows` is read or written.
    """
    spark = rows.sparkSession
    version = manifest.versions(spark, root)[-1]
    tables = manifest.tables_of(spark, root, version)
    schema, sets = tables[BASE].schema, [c for c in rows.columns if c not in keys]
    given = set(rows.columns)
    change = rows.select(
        *[(F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema],
        F.array(*[F.lit(c) for c in sets]).cast("array<string>").alias("_set"), F.lit(version + 1).cast("long").alias("_seq"),
        F.lit(insert).alias("_insert"))
    part = manifest.write_part(change, root, INSERTS if insert else UPDATES)
    changes = Published(tables[CHANGES].schema, (*tables[CHANGES].parts, part))
    manifest.publish(spark, root, version + 1, {BASE: tables[BASE], CHANGES: changes})
    return version + 1


def _folded(changes: DataFrame, schema: T.StructType, keys: list[str], frozen: tuple[str, ...]) -> DataFrame:
    """One row per key: per column its last value as a struct (null where never set)."""
    others = [f.name for f in schema if f.name not in keys]

    def last(c: str) -> Column:
        sets = F.when(F.array_contains("_set", c), F.col("_seq"))
        # A frozen column is what the insert said first.
        return (F.min_by if c.lower() in frozen else F.max_by)(F.struct(F.col(c).alias("v")), sets).alias(f"_new_{c}")

    return changes.groupBy(*keys).agg(F.bool_or("_insert").alias("_insert"), *[last(c) for c in others])


def read(spark: SparkSession, root: str, keys: list[str], version: int | None = None, frozen: tuple[str, ...] = FROZEN) -> DataFrame:
    """The table with its changes, the newest version without one given. Columns in `frozen` are not updated."""
    tables = manifest.tables_of(spark, root, version)
    base, changes = tables[BASE], tables[CHANGES]
    rows = base.read(spark)
    if not changes.parts:
        return rows
    columns = base.schema.names
    folded = _folded(changes.read(spark), base.schema, keys, frozen)

    def updated(c: str) -> Column:
        if c in keys or c.lower() in frozen:
            return F.col(c)
        return F.when(F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}")["v"]).otherwise(F.col(c)).alias(c)

    merged = rows.join(folded, keys, "left").select(*[updated(c) for c in columns])
    if all(p.key == UPDATES for p in changes.parts):
        return merged
    new = folded.where("_insert").join(rows.select(*keys), keys, "left_anti")
    return merged.unionByName(new.select(*[F.col(c) if c in keys else F.col(f"_new_{c}")["v"].alias(c) for c in columns]))


def compact(spark: SparkSession, root: str, keys: list[str], frozen: tuple[str, ...] = FROZEN) -> int:
    """Publish a version with the changes folded into a new base."""
    version = manifest.versions(spark, root)[-1]
    create(read(spark, root, keys, version, frozen), root, version + 1)
    return version + 1


def upsert(incoming: DataFrame, root: str, keys: list[str]) -> int:
    """Insert, or update on equal key, as one change."""
    return write_change(incoming, root, keys, insert=True)


def changed_keys(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """The keys that any change since the last compaction names."""
    tables = manifest.tables_of(spark, root)
    return tables[CHANGES].read(spark).select(*keys).distinct()
