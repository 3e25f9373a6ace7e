"""Scores that arrive late land on their speech's day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rostrum.operators import marts
from rostrum.session import materialize
from rostrum.sinks import manifest
from rostrum.sinks.manifest import Published
from rostrum.sinks.tables import TABLE


def publish_daily(daily: DataFrame, root: str, version: int, period: str = "month") -> None:
    """Publish a daily mart in a folder per bank and period."""
    keyed = daily.withColumn("_part", marts.part_of(F.col("bank_code"), F.col("date"), period))
    parts = manifest.write_parts(keyed.repartition("_part"), root, "_part")
    manifest.publish(daily.sparkSession, root, version, {TABLE: Published(daily.schema, parts)})


def update_daily(
    spark: SparkSession, root: str, version: int, events: DataFrame, late: DataFrame, previous_as_of: str, as_of: str, period: str = "month",
) -> list[str]:
    """Publish `version` of a daily mart from the one before: touched parts are computed and written anew, all
    others keep their folders. Returns the keys of the touched parts.

    From the old version only the parts that hold a day before a run are read. The touched keys come to the driver,
    as many as banks and periods at most.
    """
    old = manifest.tables_of(spark, root, before=version)[TABLE]
    if any(not p.key for p in old.parts):
        raise ValueError(f"{root} was not published by bank and period; see publish_daily")
    touched = materialize(
        marts.touched_parts(marts.changed_segments(events, late, previous_as_of, as_of), as_of, period), "touched-parts")
    keys = touched.select("part", marts.part_of(F.col("bank_code"), F.date_sub("run_first", 1), period).alias("before")).distinct().collect()
    if not keys:
        manifest.publish(spark, root, version, {TABLE: old})
        return []
    replaced = {r["part"] for r in keys}
    seeds = old.read(spark, [r["before"] for r in keys if r["before"] not in replaced])
    new = marts.recompute_parts(seeds, events, touched, as_of)
    keyed = new.withColumn("_part", marts.part_of(F.col("bank_code"), F.col("date"), period))
    written = manifest.write_parts(keyed.repartition("_part"), root, "_part")
    kept = tuple(p for p in old.parts if p.key not in replaced)
    manifest.publish(spark, root, version, {TABLE: Published(old.schema, kept + written)})
    return sorted(replaced)


def late_stream(
    changes: DataFrame, all_events: Callable[[], DataFrame], daily_root: str, checkpoint: str, as_of: str, period: str = "month",
) -> StreamingQuery:
    """Each micro-batch of changed events (bank_code, date) brings the published daily mart up to date.

    `all_events` gives the events as stored when the batch runs. Version 0 is the first
    full build (`publish_daily`); batch N publishes version N + 1.
    """
    def update(batch: DataFrame, batch_id: int) -> None:
        late = materialize(batch.select("bank_code", "date").distinct(), "late")
        update_daily(batch.sparkSession, daily_root, batch_id + 1, all_events(), late, as_of, as_of, period)

    return (
        changes.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
