"""Live status from an append-only stream of run events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rostrum import schemas
from rostrum.sinks.tables import replace_table


def status_event_stream(spark: SparkSession, path: str) -> DataFrame:
    """S5 as a stream: JSON lines appended below `path`."""
    return spark.readStream.schema(schemas.STATUS_EVENTS).json(path)


def live_status(events: DataFrame, key: str, order: tuple[str, ...] = ("event_at", "event_id")) -> DataFrame:
    """Latest state per bank or stage. The state holds one row per key; a late event with an
    older time changes nothing, so no watermark is needed."""
    newest = F.max(F.struct(*order, "state")).alias("s")
    return events.groupBy(key).agg(newest).select(key, "s.state", "s.event_at")


def publish_status(events: DataFrame, key: str, root: str, checkpoint: str) -> StreamingQuery:
    """Keep a published table of the latest states. Each trigger writes one new version; a
    replayed trigger writes the same version again."""
    def publish(batch: DataFrame, batch_id: int) -> None:
        replace_table(batch, root, batch_id)

    return (
        live_status(events, key).writeStream.outputMode("complete").foreachBatch(publish)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
