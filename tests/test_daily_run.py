"""The composite run from empty tables to marts, and a second run that changes nothing."""

import datetime as dt
import json
import os
import subprocess
import sys
from pathlib import Path

from rostrum import schemas
from rostrum.plans import daily_run
from rostrum.session import work_folder

CANDIDATE = "bank_code string, position long, title string, date date, url string, speaker string, full_text string, speech_type string"


def scorer(inputs):
    return inputs.map(lambda t: json.dumps({"stance_score": 0.5 if "hawk" in t else None, "stance_reason": "r", "keywords": []}))


def test_daily_run(spark, frame):
    day = dt.date(2024, 1, 20)
    batch = frame(
        CANDIDATE,
        ("A", 0, "One", day, "https://a/1", "Jane Doe", "hawk " * 200, "speech"),
        ("A", 1, "Two", day, "https://a/2", "Jane Doe", "plain " * 200, "speech"),
        ("A", 2, "Three", day, "https://a/3", None, "to be published", "speech"),
    )
    store = daily_run.Store(
        spark.createDataFrame([], schemas.SPEECHES), spark.createDataFrame([], schemas.ANALYSIS), spark.createDataFrame([], schemas.MEMBERS)
    )
    no_text = spark.createDataFrame([], "url string, full_text string")
    first = daily_run.run(store, batch, no_text, scorer, "2024-01-31", "2024-01-31 20:00:00", partitions=2)
    status = {r["analysis_status"] for r in first.store.analysis.collect()}
    assert status == {"scored", "no_signal", "skipped"}
    assert first.marts.events.count() == 2 and first.marts.daily.count() == 12 and first.marts.plot.count() == 13
    assert first.store.members.first()["avg_stance_score"] == 0.5

    fetched = frame("url string, full_text string", ("https://a/3", "hawk " * 200))
    second = daily_run.run(first.store, batch, fetched, scorer, "2024-01-31", "2024-02-01 20:00:00")
    assert second.inserted.count() == 0
    third = second.store.analysis.join(second.store.speeches.where("url LIKE '%/3'").selectExpr("id AS speech_id"), "speech_id").first()
    assert (third["analysis_status"], third["analysis_attempts"], third["stance_score"]) == ("scored", 1, 0.5)
    assert second.store.analysis.where("analysis_attempts > 1").count() == 0


def test_work_folder_uses_the_session_setting(spark):
    assert work_folder(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_workers_of_a_session_from_another_folder_have_the_package(tmp_path):
    root = Path(__file__).resolve().parents[1]
    job = (
        f"import sys; sys.path.insert(0, {str(root)!r})\n"
        "from rostrum.session import build_session, ship_package\n"
        "from rostrum.functions.basic import words\n"
        "spark = build_session('away', 'local[1]', **{'spark.ui.enabled': 'false'})\n"
        "ship_package(spark)\n"
        "def names(batches):\n"
        "    import rostrum.session\n"
        "    yield from batches\n"
        "print('rows', spark.range(3).mapInArrow(names, 'id long').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", job], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "rows 3" in said.stdout, said.stderr[-2000:]
