"""Streaming operators, run to the end of what is available."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.plans.queries_ingest import NORM
from rostrum.plans.queries_runlog import STATUS_SQL
from rostrum.plans.registry import query
from rostrum.plans.views import AS_OF_O, NOW_D
from rostrum.session import materialize, work_folder
from rostrum.sinks.tables import read_latest

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
])


@query(STATUS_SQL.format("bank_code"))
def latest_status_stream(v):
    """T1 over the events table read as a stream; equals `latest_status`."""
    from rostrum.streaming.status import publish_status

    stream = v.spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(v.folder)
    states = stream.select(
        "event_id", F.when(F.col("user_id") % 3 == 0, "B0").otherwise(F.concat(F.lit("B"), F.col("user_id") % 6)).alias("bank_code"),
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "partial")
        .when(F.col("event_type") == "click", "running").when(F.col("event_type") == "view", "success")
        .otherwise("skipped").alias("state"), F.col("ts").alias("event_at"),
    )
    root = work_folder(v.spark, "status")
    publish_status(states, "bank_code", root, work_folder(v.spark, "status-checkpoint")).awaitTermination()
    return read_latest(v.spark, root)


@query(f"""
    SELECT bank_code, norm FROM (SELECT bank_code, norm, row_number() OVER (PARTITION BY bank_code, title, date ORDER BY position) AS rn2
      FROM (SELECT bank_code, trim(title) AS title, date, position, {NORM.format('url')} AS norm,
          row_number() OVER (PARTITION BY bank_code, {NORM.format('url')} ORDER BY position) AS rn FROM candidates_p) WHERE rn = 1)
    WHERE rn2 = 1""")
def incremental_dedupe(v):
    """The same candidates arrive in two batches and enter once."""
    from rostrum.functions.urls import normalize_url
    from rostrum.streaming.ingest import create_roots, ingest_stream, stored_speeches

    source = work_folder(v.spark, "arrivals")
    arrivals = materialize(v.candidates_p, "arrival")
    arrivals.write.mode("append").parquet(source)
    files = len(v.spark.read.parquet(source).inputFiles())  # a batch is one arrival, read by as many tasks as it has files
    arrivals.write.mode("append").parquet(source)
    speeches, members = work_folder(v.spark, "speeches"), work_folder(v.spark, "members")
    create_roots(v.spark, speeches, members)
    stream = v.spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", max(1, files)).parquet(source)
    ingest_stream(stream, speeches, members, work_folder(v.spark, "ingest-checkpoint"), NOW_D).awaitTermination()
    return stored_speeches(v.spark, speeches).select("bank_code", normalize_url(F.col("url")).alias("norm"))


@query("""
    SELECT bank_code, CAST(date AS VARCHAR) AS date, round(level, 6) AS stance_level_locf,
      CAST(total AS BIGINT) AS daily_total_speech_count FROM daily_o""")
def late_recompute_stream(v):
    """T3 fed by a stream of late scores; equals a full rebuild."""
    from rostrum.operators import marts
    from rostrum.streaming.late import late_stream, publish_daily

    is_late = (F.col("speech_id") % 7 == 0) & (F.col("date") > "2001-03-01")
    root, source = work_folder(v.spark, "daily"), work_folder(v.spark, "late")
    publish_daily(marts.daily_mart(v.events_at_rest.where(~is_late), AS_OF_O), root, 0, "year")
    late = v.events_at_rest.where(is_late).select("bank_code", "date")
    late.write.parquet(source)
    stream = v.spark.readStream.schema(late.schema).parquet(source)
    late_stream(stream, lambda: v.events_at_rest, root, work_folder(v.spark, "late-checkpoint"), AS_OF_O, "year").awaitTermination()
    return read_latest(v.spark, root).select("bank_code", "date", "stance_level_locf", "daily_total_speech_count")

