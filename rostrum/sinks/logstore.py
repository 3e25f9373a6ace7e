"""Parsed logs at rest: P17, P18.

Lines are stored in a folder per level and day, with the character grams that each folder holds beside them. A filter
by level opens the folders of its levels; a search opens those that hold every gram of the keyword.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import grams, logs
from rostrum.sinks import manifest
from rostrum.sinks.manifest import Part, Published

LINES, GRAMS = "lines", "grams"
GRAM = 3


def _part() -> F.Column:
    """The level and day of a line."""
    return F.concat_ws("|", F.coalesce("level", F.lit("")), F.coalesce(F.to_date("ts").cast("string"), F.lit("")))


def _grams(batches):
    """The distinct grams of each folder among some lower-cased lines (part, low)."""
    for batch in batches:
        for piece in grams.slices(batch, 4 * grams.ROWS):
            parts = piece.column(0).dictionary_encode()
            for number, found in grams.triples(piece.column(1).to_pylist(), np.asarray(parts.indices)):
                name = parts.dictionary[number].as_py()
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(found)), pa.array(found)], names=["part", "gram"])


def store_log(parsed: DataFrame, root: str, version: int = 0) -> None:
    """Publish parsed lines (see `sources.runlogs.parse_log`); with `version` above 0 they are added to those before.

    A line without a readable time is in the folder of its level without a day. The grams of a folder are as many as
    there are different ones, however long the log is. They are taken from the stored lines, which are as many tasks
    as their size asks for, so that nothing is parsed twice.
    """
    spark = parsed.sparkSession
    keyed = parsed.drop("extra").withColumn("_part", _part())
    parts = manifest.write_parts(keyed.repartition("_part", F.col("block")), root, "_part")
    schema = keyed.drop("_part").schema
    # Which folder a line went to is its level and day; the manifest knows the folder by that key and version.
    low = Published(schema, parts).read(spark).where(F.col("raw").isNotNull()).select(_part().alias("part"), F.lower("raw").alias("low"))
    found = low.mapInArrow(_grams, "part string, gram string").distinct().withColumn("version", F.lit(version))
    gram_part = manifest.write_part(found, root)
    tagged = tuple(Part(p.path, f"{version}|{p.key}") for p in parts)
    old = manifest.tables_of(spark, root, version - 1) if version else {}
    before = {n: old[n].parts if old else () for n in (LINES, GRAMS)}
    gram_schema = spark.read.parquet(gram_part.path).schema
    manifest.publish(spark, root, version, {
        LINES: Published(schema, before[LINES] + tagged), GRAMS: Published(gram_schema, (*before[GRAMS], gram_part))})


def _level(key: str) -> str:
    return key.split("|")[1]


def stored_issues(spark: SparkSession, root: str) -> DataFrame:
    """Warnings and errors; only their folders are opened."""
    lines = manifest.tables_of(spark, root)[LINES]
    return lines.read(spark, [p.key for p in lines.parts if _level(p.key) in logs.ISSUE_LEVELS])


def matching_parts(spark: SparkSession, root: str, level: str | None = None, keyword: str | None = None) -> list[str]:
    """The folders that can hold a line of the level with the keyword. A keyword below three characters rules out none."""
    tables = manifest.tables_of(spark, root)
    keys = [p.key for p in tables[LINES].parts if level is None or _level(p.key) == level]
    word = (keyword or "").strip().lower()
    wanted = sorted({word[i:i + GRAM] for i in range(len(word) - GRAM + 1)})
    if not wanted:
        return keys
    found = tables[GRAMS].read(spark).where(F.col("gram").isin(wanted)).groupBy("version", "part").agg(
        F.count_distinct("gram").alias("n")).where(F.col("n") == len(wanted)).collect()
    holds = {f"{r['version']}|{r['part']}" for r in found}
    return [k for k in keys if k in holds]


def search_stored(spark: SparkSession, root: str, level: str | None = None, keyword: str | None = None) -> DataFrame:
    """Lines of a level whose raw text contains a keyword, in any case."""
    lines = manifest.tables_of(spark, root)[LINES].read(spark, matching_parts(spark, root, level, keyword))
    word = (keyword or "").strip().lower()
    return lines.where(F.lower("raw").contains(word)) if word else lines
