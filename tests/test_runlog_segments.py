"""Run numbers by segments and job spans with open ends, against plain passes over the lines."""

import datetime as dt
import random

import pytest

from rostrum.functions import logs
from rostrum.operators import runlog
from rostrum.sources.runlogs import parse_log

LINES = "source string, block long, seq long, message string"


def plain_runs(lines):
    """{(source, seq): (run_no, is_latest)} in one pass per source."""
    out = {}
    for source in {r[0] for r in lines}:
        rows = sorted((r for r in lines if r[0] == source), key=lambda r: (r[1], r[2]))
        run, closed, found = 0, False, []
        starts = sum(r[3] == logs.RUN_START for r in rows)
        for r in rows:
            if r[3] == logs.RUN_START:
                run, closed = run + 1, False
            if not starts or (run and not closed):
                found.append((r, run))
            if r[3] == logs.RUN_FINISH:
                closed = True
        out |= {(source, r[2]): (run, run == starts) for r, run in found}
    return out


@pytest.mark.parametrize("seed", range(5))
def test_segments_equal_one_pass(spark, frame, seed):
    rng, lines = random.Random(seed), []
    for s in range(8):
        odds = rng.choice([(1, 1, 8), (0, 1, 5), (1, 0, 20), (3, 3, 1), (0, 0, 1)])
        for seq in range(rng.randint(1, 60)):
            message = rng.choices([logs.RUN_START, logs.RUN_FINISH, None if rng.random() < 0.1 else "x"], odds)[0]
            lines.append((f"s{s}", seq // 4, seq, message))
    got = {(r["source"], r["seq"]): (r["run_no"], r["is_latest"]) for r in runlog.split_runs(frame(LINES, *lines)).collect()}
    assert got == plain_runs(lines)


def test_no_step_gathers_a_run(spark, frame):
    """No shuffle of lines is by source or run: only block sums are."""
    df = frame(LINES, ("a", 0, 0, logs.RUN_START), ("a", 1, 1, "x"))
    plan = runlog.split_runs(df)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and all("run_no" not in j and "block" in j for j in joins)


def line(seq, message, ts="2024-01-01 00:00:{:02d},000", level="INFO", **extra):
    pairs = ", ".join(f"{k}={v}" for k, v in extra.items())
    return " | ".join([ts.format(seq), level, "x", message, *([pairs] if pairs else [])])


def job_table(spark, frame, *texts):
    rows = [("a", i // 3, i, t) for i, t in enumerate(texts)]
    return runlog.split_runs(parse_log(frame("source string, block long, seq long, value string", *rows)))


def test_states_that_no_line_tells(spark, frame):
    job, soon = logs.JOB_MESSAGE, "soon{}"
    runs = job_table(
        spark, frame,
        line(0, logs.RUN_START),
        line(1, job, job_name="collect_frb"), line(2, "bad", level="ERROR"), line(3, job, job_name="collect_frb"),
        line(4, job, job_name="collect_ecb"), line(5, "careful", level="WARNING"), line(6, job, job_name="collect_ecb"),
        line(7, job, job_name="collect_boe"), line(8, job, job_name="collect_boe", status="running"),
        line(9, job, job_name="collect_boj", status=""),
        line(10, job, ts=soon, job_name="collect_rba", status="running"), line(11, job, job_name="collect_rba"),
        line(12, job, job_name="postgres_sync", status="partial", tableau_mart_items=7, source_synced_items=5))
    got = {r["job"]: r for r in runlog.jobs(runs).collect()}
    assert {j: r["status"] for j, r in got.items()} == {
        "collect_frb": "failed", "collect_ecb": "warning",
        "collect_boe": "success",  # running, then a line without status before it: the last that is not running decides
        "collect_boj": "unknown",  # an empty status is a status
        "collect_rba": "failed",  # its start can't be read: open to the past
        "postgres_sync": "warning"}
    assert (got["postgres_sync"]["tableau_mart_items"], got["postgres_sync"]["source_synced_items"]) == (7, 5)


def test_a_job_without_lines_in_its_span_has_its_own(spark, frame):
    job = logs.JOB_MESSAGE
    runs = job_table(
        spark, frame, line(0, logs.RUN_START, ts="soon{}"),
        # The end is before the start, so that nothing is between them.
        line(1, job, ts="2024-01-01 00:00:30,000", job_name="collect_frb", status="running"),
        line(2, job, ts="2024-01-01 00:00:10,000", level="WARNING", job_name="collect_frb", status="success"),
        line(3, "other", ts="2024-01-01 00:00:20,000", level="ERROR"))
    rows = runlog.jobs(runs)
    assert sorted(r["seq"] for r in runlog.events_in_jobs(runs, rows).collect()) == [1, 2]
    assert [r["seq"] for r in runlog.issues_in_jobs(runs, rows).collect()] == [2]
    assert [tuple(r)[3:] for r in runlog.job_counts(runs, rows).collect()] == [(2, 1)]


@pytest.mark.parametrize("seed", range(4))
def test_open_spans_equal_all_pairs(spark, frame, seed):
    rng = random.Random(seed)
    names = ["collect_frb", "collect_ecb", "postgres_sync"]
    texts = [line(0, logs.RUN_START)]
    for i in range(40):
        ts = "never" if rng.random() < 0.3 else f"2024-01-01 00:{rng.randint(0, 20):02d}:{i % 60:02d},000"
        if rng.random() < 0.5:
            given = {"status": rng.choice(["running", "success", "fail"])} if rng.random() < 0.7 else {}
            texts.append(line(0, logs.JOB_MESSAGE, ts=ts, job_name=rng.choice(names), **given))
        else:
            texts.append(line(0, rng.choice(["x", logs.RUN_START]), ts=ts, level=rng.choice(["INFO", "ERROR", "WARNING"])))
    runs = job_table(spark, frame, *texts)
    rows, lines = runlog.jobs(runs).collect(), runs.collect()
    want = []
    for j in rows:
        same = [r for r in lines if r["run_no"] == j["run_no"]]
        low, high = j["start_ts"] or dt.datetime.min, j["end_ts"] or dt.datetime.max
        inside = [r for r in same if r["ts"] and low <= r["ts"] <= high]
        own = [r for r in same if r["message"] == logs.JOB_MESSAGE and r["extra"].get("job_name") == j["job"]]
        want += [(j["run_no"], j["job"], r["seq"]) for r in inside or own]
    got = [(r["run_no"], r["job"], r["seq"]) for r in runlog.events_in_jobs(runs, runlog.jobs(runs)).collect()]
    assert sorted(got) == sorted(want)


def test_closing_row(spark, frame):
    runs = job_table(
        spark, frame, line(0, logs.RUN_START), line(1, "x", level="ERROR"), line(2, logs.RUN_FINISH, duration_sec=3.5, total_new=4),
        line(3, logs.RUN_START), line(4, "note", text="Everything is up-to-date"), line(5, logs.RUN_START), line(6, "y"))
    got = {r["run_no"]: (r["status"], r["duration"], r["total_new"], r["end_ts"] and r["end_ts"].second) for r in runlog.finish_rows(runs).collect()}
    assert got == {1: ("failed", 3.5, 4, 2), 2: ("unknown", 0.0, None, 4), 3: ("unknown", 0.0, None, None)}
