"""Streams equal their batch forms, also after a restart."""

import datetime as dt

from pyspark.sql import functions as F

from rostrum.operators import marts
from rostrum.sinks.tables import read_latest
from rostrum.streaming.ingest import create_roots, ingest_stream, stored_speeches
from rostrum.streaming.late import late_stream, publish_daily
from rostrum.streaming.status import publish_status, status_event_stream

CANDIDATE = "bank_code string, position long, title string, date date, url string, speaker string, full_text string, speech_type string"


def test_live_status_over_restarts(spark, tmp_path):
    source = tmp_path / "events"
    source.mkdir()
    (source / "1.json").write_text(
        '{"stage": "sync", "status": "running", "event_at": "2026-01-01T00:00:00"}\n{"stage": "scan", "status": "failed", "event_at": "2026-01-01T00:00:00"}\n')
    stream = status_event_stream(spark, str(source)).withColumnRenamed("status", "state").withColumn("event_id", F.lit(0))
    root, checkpoint = str(tmp_path / "status"), str(tmp_path / "cp")
    publish_status(stream, "stage", root, checkpoint).awaitTermination()
    (source / "2.json").write_text(
        '{"stage": "sync", "status": "success", "event_at": "2026-01-01T00:01:00"}\n{"stage": "scan", "status": "running", "event_at": "2025-12-31T00:00:00"}\n')
    publish_status(stream, "stage", root, checkpoint).awaitTermination()
    assert {r["stage"]: r["state"] for r in read_latest(spark, root).collect()} == {"sync": "success", "scan": "failed"}


def test_ingest_over_batches(spark, frame, tmp_path):
    source, speeches, people = str(tmp_path / "in"), str(tmp_path / "speeches"), str(tmp_path / "members")
    day = dt.date(2024, 1, 1)
    create_roots(spark, speeches, people)

    def arrive(*rows):
        frame(CANDIDATE, *rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(CANDIDATE).option("maxFilesPerTrigger", 1).parquet(source)
        ingest_stream(stream, speeches, people, str(tmp_path / "cp"), "2024-02-01 00:00:00").awaitTermination()

    arrive(("A", 0, "One", day, "http://a/1", "Jane Doe", "t", "speech"))
    arrive(("A", 0, "One", day, "https://a/1/", "Jane Doe", "t", "speech"), ("A", 1, "Two", day, "https://a/2", "Jane Doe", "t", "speech"))
    rows = stored_speeches(spark, speeches).collect()
    assert sorted(r["url"] for r in rows) == ["http://a/1", "https://a/2"]
    assert len({r["speaker_id"] for r in rows}) == 1
    newest = spark.read.parquet(people).where("version = 1")
    assert [r["name"] for r in newest.collect()] == ["Jane Doe"]


def test_late_scores(spark, frame, tmp_path):
    schema = "speech_id long, bank_code string, date date, analysis_status string, stance_score double"
    first = [(1, "A", dt.date(2024, 1, 1), "scored", 0.5), (2, "B", dt.date(2024, 1, 3), "scored", -0.5)]
    late = [(3, "A", dt.date(2024, 1, 5), "scored", 1.0), (4, "A", dt.date(2023, 12, 30), "no_signal", None)]
    everything = frame(schema, *first, *late)
    root, source = str(tmp_path / "daily"), str(tmp_path / "late")
    publish_daily(marts.daily_mart(frame(schema, *first), "2024-01-10"), root, 0)
    frame(schema, *late).select("bank_code", "date").write.parquet(source)
    stream = spark.readStream.schema("bank_code string, date date").parquet(source)
    late_stream(stream, lambda: everything, root, str(tmp_path / "cp"), "2024-01-10").awaitTermination()
    got = sorted((tuple(r) for r in read_latest(spark, root).drop("updated_at").collect()), key=str)
    want = sorted((tuple(r) for r in marts.daily_mart(everything, "2024-01-10").drop("updated_at").collect()), key=str)
    assert [str(r) for r in got] == [str(r) for r in want]
