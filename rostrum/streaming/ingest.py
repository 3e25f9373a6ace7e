"""Candidates that arrive again and again enter once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rostrum import schemas
from rostrum.functions.basic import strip
from rostrum.functions.urls import normalize_url
from rostrum.operators.common import as_time
from rostrum.operators.ingest import enter_selected, select_new
from rostrum.session import materialize
from rostrum.sinks import manifest
from rostrum.sinks.manifest import Part, Published

BATCHED = T.StructType([*schemas.SPEECHES.fields, T.StructField("batch", T.LongType())])
VERSIONED = T.StructType([*schemas.MEMBERS.fields, T.StructField("version", T.LongType())])
#: What is known of the stored speeches: a row per normalized URL, per title and date, and per id.
KEYS = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("bank_code", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("date", T.DateType()), T.StructField("id", T.LongType())])
KEYS_TABLE = "keys"
BUCKETS = 64


def _part(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A partitioned table that may have no data yet."""
    return spark.read.schema(schema).option("ignoreMissingFiles", True).parquet(root)


def _keys_root(speeches_root: str) -> str:
    """The key table lies below the speeches, in a folder that their readers skip."""
    return f"{speeches_root}/_keys"


def with_bucket(keys: DataFrame, buckets: int) -> DataFrame:
    """Key rows with the bucket of what is compared: URLs are stored as they came and compared normalized."""
    value = F.when(F.col("kind") == "url", normalize_url(F.col("value"))).otherwise(F.col("value"))
    return keys.withColumn("bucket", F.pmod(F.xxhash64("kind", "bank_code", value, "date", "id"), F.lit(buckets)).cast("int"))


def known_keys(rows: DataFrame, buckets: int, ident: Column) -> DataFrame:
    """The key rows of speeches or candidates, with the bucket that each belongs to."""
    def row(kind: str, bank: Column, value: Column, date: Column, number: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), bank.cast("string").alias("bank_code"), value.cast("string").alias("value"),
            date.cast("date").alias("date"), number.cast("long").alias("id"))

    bank, none = F.col("bank_code"), F.lit(None)
    kinds = F.array(
        row("url", bank, F.col("url"), none, none), row("title", bank, strip(F.col("title")), F.col("date"), none),
        row("id", none, none, none, ident))
    return with_bucket(rows.select(F.explode(kinds).alias("k")).select("k.*"), buckets)


def as_speeches(keys: DataFrame) -> DataFrame:
    """Key rows in the shape that `select_new` compares candidates with."""
    def of(kind: str, column: str) -> Column:
        return F.when(F.col("kind") == kind, F.col(column))

    return keys.select(of("id", "id").alias("id"), "bank_code", of("url", "value").alias("url"), of("title", "value").alias("title"), "date")


def touched_buckets(candidates: DataFrame, buckets: int) -> list[str]:
    """The buckets that can hold a key of a candidate; at most `buckets` numbers."""
    ident = F.xxhash64("bank_code", normalize_url(F.col("url")))
    rows = known_keys(candidates, buckets, ident).select("bucket").distinct().collect()
    return sorted(str(r["bucket"]) for r in rows)


def read_keys(spark: SparkSession, speeches_root: str, version: int, buckets: list[str]) -> DataFrame:
    """The key rows of some buckets; no other folder is listed and no stored text is read."""
    return manifest.tables_of(spark, _keys_root(speeches_root), version)[KEYS_TABLE].read(spark, buckets)


def _publish_keys(spark: SparkSession, speeches_root: str, version: int, new: DataFrame, buckets: int, most_parts: int) -> None:
    """The key table with a batch's rows; buckets of more than `most_parts` folders are written as one."""
    root = _keys_root(speeches_root)
    old = manifest.tables_of(spark, root, version - 1)[KEYS_TABLE]
    parts = [*old.parts, *manifest.write_parts(new.repartition("bucket"), root, "bucket")]
    counts: dict[str, int] = {}
    for p in parts:
        counts[p.key] = counts.get(p.key, 0) + 1
    full = [key for key, n in counts.items() if n > most_parts]
    if full:
        rows = Published(KEYS, tuple(parts)).read(spark, full)
        merged = with_bucket(rows, buckets)
        parts = [p for p in parts if p.key not in full]
        parts += manifest.write_parts(merged.repartition("bucket"), root, "bucket")
    manifest.publish(spark, root, version, {KEYS_TABLE: Published(KEYS, tuple(parts))})


def ingest_stream(
    candidates: DataFrame, speeches_root: str, members_root: str, checkpoint: str, now: str, buckets: int = BUCKETS, most_parts: int = 8,
) -> StreamingQuery:
    """D1 per micro-batch, exactly once.

    Speeches are only appended. What is known of them is a narrow key table in `buckets` folders by the hash of
    bank and URL, of bank, title and date, and of the id: a batch reads the buckets of its own keys and never the
    stored speeches. Batch N reads version N of the key table and publishes version N + 1, so a replay gives the
    same rows; no stream state grows. The roots must exist, made with the same number of buckets; see
    `create_roots`.
    """
    def enter(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = materialize(batch, "arrived")
        known = as_speeches(read_keys(spark, speeches_root, batch_id, touched_buckets(rows, buckets)))
        people = _part(spark, members_root, VERSIONED).where(F.col("version") == batch_id - 1).drop("version")
        selected = materialize(select_new(rows, known), "selected")
        result = enter_selected(selected, known, people, as_time(now))
        schemas.conform(result.inserted, schemas.SPEECHES).write.mode("overwrite").parquet(
            f"{speeches_root}/batch={batch_id}"
        )
        schemas.conform(result.members, schemas.MEMBERS).write.mode("overwrite").parquet(
            f"{members_root}/version={batch_id}"
        )
    
        entered = selected.select("bank_code", "url", "title", "date", "id")
        _publish_keys(spark, speeches_root, batch_id + 1, known_keys(entered, buckets, F.col("id")), buckets, most_parts)

    return (
        candidates.writeStream.foreachBatch(enter).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def create_roots(spark: SparkSession, speeches_root: str, members_root: str) -> None:
    """Empty first parts, so that the first batch has something to read."""
    spark.createDataFrame([], schemas.SPEECHES).write.mode("overwrite").parquet(f"{speeches_root}/batch=-1")
    spark.createDataFrame([], schemas.MEMBERS).write.mode("overwrite").parquet(f"{members_root}/version=-1")
    manifest.publish(spark, _keys_root(speeches_root), 0, {KEYS_TABLE: Published(KEYS, ())})


def key_parts(spark: SparkSession, speeches_root: str, version: int) -> tuple[Part, ...]:
    """The folders of a version of the key table."""
    return manifest.tables_of(spark, _keys_root(speeches_root), version)[KEYS_TABLE].parts


def stored_speeches(spark: SparkSession, speeches_root: str) -> DataFrame:
    return _part(spark, speeches_root, BATCHED).drop("batch")
