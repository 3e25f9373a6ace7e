"""Intake, queue, people, logs, search and sinks on small tables."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from rostrum import schemas
from rostrum.operators import ingest, members, queue, runlog, search, sync
from rostrum.operators.blocked import running_count
from rostrum.operators.common import as_time, first_per_key, keep_first_by_id, settle_ids
from rostrum.sinks import casts, tables, upsert

NOW = "2024-01-31 12:00:00"
CANDIDATE = "bank_code string, position long, title string, date string, url string, speaker string, full_text string, speech_type string"


@pytest.fixture
def empty(spark):
    return lambda schema: spark.createDataFrame([], schema)


def candidates(frame, *rows):
    return frame(CANDIDATE, *rows).withColumn("date", F.col("date").cast("date"))


def test_revive_skipped(frame):
    speeches = frame("id long, full_text string", (1, "short"), (2, "x" * 501))
    old = frame(
        "speech_id long, stance_score double, stance_reason string, keywords string, main_risk string, analysis_attempts int, "
        "analysis_status string, analyzed_at string, synced_at string",
        (1, None, "Skipped: Text too short.", "[]", None, 1, "skipped", "2026-01-01", None),
        (2, None, "Skipped: Text too short.", "[]", None, 1, "skipped", "2026-01-01", "2026-01-02"),
    )
    rows = queue.revive_skipped(old, speeches).select(
        "speech_id", "analysis_status", "analysis_attempts", "stance_reason", "keywords", "analyzed_at", "synced_at"
    ).orderBy("speech_id").collect()
    assert tuple(rows[0]) == (1, "skipped", 1, "Skipped: Text too short.", "[]", "2026-01-01", None)
    assert tuple(rows[1]) == (2, "pending", 0, None, None, None, None)


def test_text_of_exactly_500_is_skipped_but_not_refetched(frame, empty):
    speeches = frame("id long, full_text string, date date, synced_at timestamp_ntz", (1, "x" * 500, dt.date(2024, 1, 30), None))
    assert queue.skippable(speeches, empty(schemas.ANALYSIS)).count() == 1
    assert speeches.where(ingest.is_incomplete("2024-01-31")).count() == 0


def test_insert_new_is_idempotent(frame, empty):
    batch = candidates(
        frame,
        ("A", 0, "One", "2024-01-01", "http://a/1/", "Jane Doe", "t", "speech"),
        ("A", 1, "One again", "2024-01-02", "https://A/1?x=1", "Jane Doe", "t", "speech"),
        ("A", 2, " One ", "2024-01-01", "https://a/2", None, "t", "speech"),
        ("B", 3, "One", "2024-01-01", "https://a/1", "", "t", "speech"),
        ("A", 4, "Undated", None, "https://a/4", "Ann Bee", "__DATE__:2024-01-09\nbody", "speech"),
        ("A", 5, "Undated", None, "https://a/5", "Jane Doe", None, "speech"),
    )
    first = ingest.insert_new(batch, empty(schemas.SPEECHES), empty(schemas.MEMBERS), as_time(NOW))
    urls = sorted((r["bank_code"], r["url"]) for r in first.inserted.collect())
    assert urls == [("A", "http://a/1/"), ("A", "https://a/4"), ("A", "https://a/5"), ("B", "https://a/1")]
    people = {r["name"]: str(r["last_speech_date"]) for r in first.members.collect()}
    assert people == {"Jane Doe": "2024-01-01", "Ann Bee": "2024-01-09"}
    dated = first.inserted.where("url = 'https://a/4'").first()
    assert dated["full_text"] == "body" and str(dated["date"]) == "2024-01-09"
    assert ingest.select_new(batch, first.speeches).count() == 0


def test_last_speech_date_never_moves_back(frame):
    people = frame("id long, bank_code string, name string, last_speech_date date, last_updated timestamp_ntz",
                   (1, "A", "x", dt.date(2024, 5, 1), None), (2, "A", "y", None, None))
    new = frame("speaker_id long, date date", (1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1)), (2, None))
    got = {r["id"]: str(r["last_speech_date"]) for r in ingest.bump_last_speech(people, new, as_time(NOW)).collect()}
    assert got == {1: "2024-05-01", 2: "2024-01-01"}


def test_apply_scores_attempts(frame):
    speeches = frame("id long, synced_at timestamp_ntz", *[(i, dt.datetime(2024, 1, 1)) for i in range(1, 5)])
    analysis = schemas.conform(
        frame("speech_id long, stance_score double, analysis_attempts int, analysis_status string", (1, None, 2, "pending"), (2, 0.3, 1, "scored")),
        schemas.ANALYSIS,
    )
    responses = frame(
        "speech_id long, response string", (1, '{"stance_score": 5, "stance_reason": "r", "keywords": []}'),
        (2, None), (3, "garbage"), (4, '{"stance_score": null, "stance_reason": "none"}'),
    )
    new, marked = queue.apply_scores(speeches, analysis, responses, as_time(NOW))
    got = {r["speech_id"]: (r["stance_score"], r["analysis_attempts"], r["analysis_status"]) for r in new.collect()}
    assert got == {1: (1.0, 3, "scored"), 2: (0.3, 2, "scored"), 3: (None, 1, "pending"), 4: (None, 1, "no_signal")}
    assert {r["id"] for r in marked.where("synced_at IS NULL").collect()} == {1, 4}


def test_empty_roster_retires_nobody(frame, empty):
    people = schemas.conform(frame("id long, bank_code string, name string, status string", (1, "A", "x", "active")), schemas.MEMBERS)
    none = empty("bank_code string, name string")
    assert members.apply_roster(people, none, "2024-01-31", as_time(NOW)).first()["status"] == "active"
    assert members.not_in_roster(people, none).count() == 0


def test_merge_keeps_speech_counts(frame):
    people = frame("id long, bank_code string, name string", (5, "BOE", "Andy Haldane"), (3, "BOE", "andrew haldane"),
                   (9, "BOE", "Speech by X"), (4, "FRB", "Andrew Haldane"))
    speeches = frame("id long, speaker_id long", (1, 5), (2, 3), (3, 9), (4, 4), (5, None), (6, 77))
    kept, moved = members.merge_members(people, speeches)
    assert {(r["id"], r["name"]) for r in kept.collect()} == {(3, "Andrew Haldane"), (4, "Andrew Haldane")}
    assert {r["id"]: r["speaker_id"] for r in moved.collect()} == {1: 3, 2: 3, 3: None, 4: 4, 5: None, 6: 77}


def test_activity_status_boundaries(frame):
    rows = frame(
        "id long, status string, term_end date, last_speech_date date", (1, "active", None, dt.date(2023, 1, 30)),
        (2, "active", None, dt.date(2023, 1, 31)), (3, "retired", dt.date(2023, 6, 1), dt.date(2023, 1, 31)),
        (4, "active", None, None), (5, "active", dt.date(2020, 1, 1), dt.date(2020, 5, 1)),
    )
    got = {r["id"]: (r["status"], r["term_end"]) for r in members.activity_status(rows, "2024-01-31").collect()}
    assert got == {1: ("retired", dt.date(2023, 1, 30)), 2: ("active", None), 3: ("active", None), 4: ("active", None),
                   5: ("retired", dt.date(2020, 1, 1))}


def test_name_in_text(frame):
    speeches = frame(
        "id long, bank_code string, title string, full_text string", (1, "A", "By JANE DOE", "x"), (2, "A", "t", "saint paul doe-jane"),
        (3, "A", "t", "x" * 1000 + "Jane Doe"), (4, "B", "t", "jane doe"), (5, "A", "x", "Bo and Jane Doe"), (6, "A", "t", "ünal öz 😀"),
        (7, "A", "Ya", "no"),
    )
    roster = frame("bank_code string, name string, position long", ("A", "Jane Doe", 2), ("A", "aint Pau", 3), ("A", "Bo", 1), ("A", "Ünal", 4), ("A", "Y", 9))
    got = {r["id"]: r["speaker"] for r in members.name_in_text(speeches, roster).collect()}
    assert got == {1: "Jane Doe", 2: "aint Pau", 5: "Bo", 6: "Ünal", 7: "Y"}


def test_name_in_text_keeps_the_grams_of_texts_in_their_tasks(frame, monkeypatch):
    """What is written are grams of names: no row for each gram that a text shares with any of them."""
    written, keep = [], members.materialize
    monkeypatch.setattr(members, "materialize", lambda df, purpose: written.append(keep(df, purpose)) or written[-1])
    text = "The governor of the bank " * 20
    speeches = frame("id long, bank_code string, title string, full_text string", *[(i, "B", "t", f"{text}{i}") for i in range(50)])
    roster = frame("bank_code string, position int, name string", ("B", 1, "Governor of the Bank 77"), ("B", 2, "governor of the bank 7"))
    assert [tuple(r) for r in members.name_in_text(speeches, roster).collect()] == [(7, "governor of the bank 7")]
    assert sum(w.count() for w in written) < 50


def test_name_in_text_looks_in_the_text_of_the_bank(frame):
    """Rows that share an id are looked at one by one."""
    speeches = frame("id long, bank_code string, title string, full_text string",
                     (1, "A", "t", "xx Ann Bergma"), (1, "B", "t", "Ann Bergman"), (2, "A", "t", "ann bergman"), (2, "A", "t", None))
    roster = frame("bank_code string, position int, name string", ("A", 1, "Ann Bergman"), ("A", 1, "ANN BERGMAN"))
    assert [tuple(r) for r in members.name_in_text(speeches, roster).collect()] == [(2, "ANN BERGMAN")]


def test_name_in_text_admits_odd_names(frame):
    """Null and empty names, and names whose length or letters change with the case."""
    speeches = frame(
        "id long, bank_code string, title string, full_text string", (1, "A", "t", "by Jane Doe"), (2, "A", "t", "by İİİİ Öz"),
        (3, "A", "t", "by ΝΙΚΟΛΑΟΣΙΔΗΣ Α"), (4, "A", "t", "nobody"), (5, "A", "t", "ΑΣ"),
    )
    roster = frame(
        "bank_code string, name string, position long", ("A", "", 0), ("A", None, 1), ("A", "Jane Doe", 2),
        ("A", "İİİİ Öz", 3), ("A", "ΝΙΚΟΛΑΟΣΙΔΗΣ", 4), ("A", "ΑΣ", 5))
    got = {r["id"]: r["speaker"] for r in members.name_in_text(speeches, roster).collect()}
    assert got == {1: "Jane Doe", 2: "İİİİ Öz", 3: "ΝΙΚΟΛΑΟΣΙΔΗΣ", 5: "ΑΣ"}


def test_shared_beginnings_are_nobodys_key(spark, frame):
    """A beginning that every name and text has is no key while a name has a rarer gram."""
    names = [f"Governor {w}" for w in ("Adebayo", "Lindholm", "Castellanos", "Ferreira")]
    speeches = frame("id long, bank_code string, title string, full_text string", *[
        (i, "A", "t", f"by governor {'nobody' if i % 5 == 4 else names[i % 5].split()[1]} {i}") for i in range(50)])
    roster = frame("bank_code string, name string, position long", *[("A", n, i) for i, n in enumerate([*names, "Governor Unheard"])])
    got = {r["id"]: r["speaker"] for r in members.name_in_text(speeches, roster).collect()}
    assert got == {i: names[i % 5] for i in range(50) if i % 5 != 4}
    assert members.name_in_text(speeches, roster.limit(0)).collect() == []


def test_lastname_lookup_equals_like(spark, frame):
    rng = random.Random(2)
    names = ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 12))) for _ in range(60)]
    people = [("X", n, rng.choice(["active", None]), rng.choice([None, dt.date(2020, 1, 1 + i % 28)])) for i, n in enumerate(names)]
    asked = sorted({n[rng.randrange(len(n)):][:rng.randint(1, 9)] for n in names * 3} - {""})
    got = {r["last_name"]: r["speaker"] for r in members.lastname_lookup(
        frame("bank_code string, last_name string", *[("X", a) for a in asked]),
        frame("bank_code string, name string, status string, last_speech_date date", *people)).collect()}
    for x in asked:
        match = [p for p in people if p[1].startswith(x) or p[1].endswith(" " + x)]
        best = min(match, key=lambda p: (p[2] != "active", -(p[3].toordinal() if p[3] else 0), p[1]), default=None)
        assert got[x] == (best[1] if best else x), x


def test_lastname_lookup(frame):
    people = frame(
        "bank_code string, name string, status string, last_speech_date date", ("FRB", "Michael S. Barr", "active", None),
        ("FRB", "Barrington Old", "retired", dt.date(2024, 1, 1)), ("FRB", "Lisa Cook", "retired", dt.date(2020, 1, 1)),
        ("FRB", "Ann Cook", "retired", dt.date(2021, 1, 1)),
    )
    asked = frame("bank_code string, last_name string", ("FRB", "barr"), ("FRB", "Cook"), ("FRB", "Lisa"), ("FRB", "Nobody"), ("ECB", "Cook"))
    got = {(r["bank_code"], r["last_name"]): r["speaker"] for r in members.lastname_lookup(asked, people).collect()}
    assert got == {("FRB", "barr"): "Michael S. Barr", ("FRB", "Cook"): "Ann Cook", ("FRB", "Lisa"): "Lisa Cook",
                   ("FRB", "Nobody"): "Nobody", ("ECB", "Cook"): "Cook"}


def test_detect_and_refresh(frame, empty):
    speeches = schemas.conform(
        frame("id long, bank_code string, title string, date date, url string, full_text string, speech_type string",
              (1, "A", "same", dt.date(2024, 1, 1), "u1", "fine", "speech"), (2, "A", "old", dt.date(2024, 1, 1), "u2", "fine", "speech"),
              (3, "A", "same", None, "u3", "Share this page", "speech")), schemas.SPEECHES)
    listed = frame("url string, title string, date date, speech_type string, speaker string", ("u1", "same", dt.date(2024, 1, 1), "speech", None),
                   ("u2", "new", dt.date(2024, 1, 1), "speech", "Jane Doe"), ("u3", "same", None, "speech", None), ("u4", "unknown", None, "speech", None))
    changes = ingest.detect_changes(speeches, empty(schemas.MEMBERS), listed)
    assert {(r["id"], r["metadata_changed"], r["dirty_text"]) for r in changes.collect()} == {(2, True, False), (3, False, True)}
    fetched = frame("url string, full_text string", ("u3", "clean"), ("u2", ""))
    out, people = ingest.refresh_changed(speeches, empty(schemas.MEMBERS), listed, fetched, as_time(NOW))
    rows = {r["id"]: r for r in out.collect()}
    assert rows[2]["title"] == "new" and rows[2]["full_text"] == "fine" and rows[2]["speaker_id"] is not None
    assert rows[3]["full_text"] == "clean" and rows[1]["fetched_at"] is None and people.count() == 1


def test_empty_list_changes_no_type(frame, empty):
    rows = frame("id long, bank_code string, date date, url string, speech_type string, synced_at timestamp_ntz",
                 (1, "A", dt.date(2024, 1, 2), "u", "speech", None))
    none = empty("bank_code string, url string")
    assert ingest.mark_unlisted(rows, none, "A", 2024).first()["speech_type"] == "speech"


def test_keep_longest_ties(frame):
    rows = schemas.conform(
        frame("id long, bank_code string, title string, full_text string", (4, "A", "t", "aa"), (2, "A", "t", "bb"), (3, "A", "t", "c"),
              (9, "A", None, None), (8, "A", None, None)), schemas.SPEECHES)
    assert {r["id"] for r in ingest.drop_duplicates_keep_longest(rows).collect()} == {2, 8}
    assert keep_first_by_id(rows, ["bank_code"], "id", -F.col("id")).first()["id"] == 9


def test_running_count_over_blocks(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.6 else f"s{rng.randint(0, 3)}", i // 10, i, rng.random() < 0.3) for i in range(400)]
    df = spark.createDataFrame(rows, "source string, block long, seq long, flag boolean")
    got = {r["seq"]: r["n"] for r in running_count(df, "source", "block", "seq", F.col("flag"), "n").collect()}
    want, seen = {}, {}
    for source, _, seq, flag in rows:
        seen[source] = seen.get(source, 0) + flag
        want[seq] = seen[source]
    assert got == want


def log_rows(frame, *rows):
    schema = "source string, block long, seq long, ts string, ts_text string, level string, message string, extra_text string, extra map<string,string>"
    return frame(schema, *[(s, i // 3, i, t, t, lv, m, "", x) for i, (s, t, lv, m, x) in enumerate(rows)]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_runs_jobs_and_summary(frame):
    job = "Pipeline job status"
    lines = log_rows(
        frame,
        ("f", "2026-01-01 00:00:00", "INFO", "before any run", {}),
        ("f", "2026-01-01 00:00:01", "INFO", "Starting sync run", {"run_id": "r1"}),
        ("f", "2026-01-01 00:00:02", "INFO", job, {"job_name": "collect_ecb", "status": "running"}),
        ("f", "2026-01-01 00:00:03", "ERROR", "bad", {}),
        ("f", "2026-01-01 00:00:05", "INFO", job, {"job_name": "collect_ecb", "status": "partial", "new_items": "3"}),
        ("f", "2026-01-01 00:00:06", "INFO", "Finished sync run", {"status": "success", "duration_sec": "9.5", "total_new": "3"}),
        ("f", "2026-01-01 00:00:07", "INFO", "after the run", {}),
        ("f", "2026-01-01 00:00:08", "INFO", "Starting sync run", {"run_id": "r2"}),
        ("f", "2026-01-01 00:00:09", "INFO", job, {"job_name": "collect_boe", "status": "success", "duration_sec": "2"}),
        ("f", "2026-01-01 00:00:10", "INFO", job, {"job_name": "unknown_job", "status": "success"}),
        ("g", "2026-01-01 00:00:00", "INFO", "no marker", {}),
        ("g", "2026-01-01 00:00:01", "INFO", "Finished sync run", {}),
        ("g", "2026-01-01 00:00:02", "INFO", "still here", {}),
    )
    runs = runlog.split_runs(lines)
    assert {(r["source"], r["run_no"]): r["count"] for r in runs.groupBy("source", "run_no").count().collect()} == {
        ("f", 1): 5, ("f", 2): 3, ("g", 0): 3}
    assert runlog.latest_run(lines).where("source = 'f'").count() == 3
    jobs = {r["job"]: r for r in runlog.jobs(runs).collect()}
    assert set(jobs) == {"collect_ecb", "collect_boe"}
    ecb = jobs["collect_ecb"]
    assert (ecb["status"], ecb["duration"], ecb["new_items"], ecb["stage"], ecb["label"]) == ("warning", 3.0, 3, "collect", "ECB")
    counts = {r["job"]: (r["events"], r["issues"]) for r in runlog.job_counts(runs, runlog.jobs(runs)).collect()}
    assert counts == {"collect_ecb": (3, 1), "collect_boe": (1, 0)}
    summary = {(r["source"], r["run_no"]): r for r in runlog.run_summary(runs).collect()}
    assert (summary["f", 1]["status"], summary["f", 1]["duration"], summary["f", 1]["run_id"]) == ("success", 9.5, "r1")
    assert (summary["f", 2]["status"], summary["f", 2]["duration"]) == ("unknown", 2.0)


def test_stage_order_and_span(frame):
    rows = frame("id long, run_id string, started_at timestamp_ntz, finished_at timestamp_ntz",
                 *[(i, f"r{i % 3}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i // 2), None) for i in range(9)])
    order = [(r["run_id"], r["id"]) for r in runlog.stage_order(rows, 2).collect()]
    assert order == [("r0", 0), ("r0", 3), ("r0", 6), ("r2", 2), ("r2", 5), ("r2", 8)]
    assert [r["run_id"] for r in runlog.run_span(rows, limit=1).collect()] == ["r2"]


def test_run_totals_do_not_depend_on_bank_order(frame):
    rows = frame("run_id string, step string, status string, new long, refreshed long, analyzed long, synced long",
                 ("a", "bank", "failed", None, None, None, None), ("a", "bank", "success", 2, 0, None, None),
                 ("b", "bank", "failed", None, None, None, None), ("c", "bank", "success", 0, 0, None, None),
                 ("c", "sync", "failed", None, None, None, None), ("d", "bank", "success", 1, 0, None, None))
    assert {r["run_id"]: r["status"] for r in runlog.run_totals(rows).collect()} == {"a": "partial", "b": "failed", "c": "partial", "d": "success"}


def test_worst_state_of_nothing_is_idle(empty):
    assert runlog.worst_state(empty("state string")).first()["state"] == "idle"


def test_search_ranks_like_bm25(frame):
    texts = {1: "inflation inflation rates", 2: "Inflation, and growth; rates", 3: "growth only", 4: "rätes of ínflation " + "x " * 30, 5: "nothing"}
    docs = frame("id long, title string, full_text string", *[(k, "T", v) for k, v in texts.items()])
    got = [(r["id"], r["score"]) for r in search.search(docs, "INFLATION rates!").collect()]
    words = {k: ["t"] + v.lower().replace("ä", "a").replace("í", "i").replace(",", "").replace(";", "").split() for k, v in texts.items()}
    mean = sum(map(len, words.values())) / len(words)

    def score(k):
        total = 0.0
        for term in ("inflation", "rates"):
            found = sum(term in w for w in words.values())
            idf = max(math.log((len(words) - found + 0.5) / (found + 0.5)), 0) or 1e-6
            tf = words[k].count(term)
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words[k]) / mean))
        return total

    want = sorted(((k, score(k)) for k in (1, 2, 4)), key=lambda p: (-p[1], p[0]))
    assert [k for k, _ in got] == [k for k, _ in want]
    assert all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(got, want))
    index = search.build_term_index(docs)
    assert [r["id"] for r in search.search_index(index, search.document_lengths(docs), "INFLATION rates!").collect()] == [k for k, _ in got]
    assert search.search(docs, "!!").count() == 0


def test_upsert_keeps_frozen_columns(frame):
    target = frame("id long, bank_code string, name string, role string", (1, "A", "x", "old"), (2, "A", "y", "old"))
    incoming = frame("id long, name string, role string", (2, "renamed", None), (3, "z", "new"))
    got = {tuple(r) for r in upsert.upsert_by_key(target, incoming, ["id"]).collect()}
    assert got == {(1, "A", "x", "old"), (2, "A", "y", None), (3, None, "z", "new")}


def test_sync_marks_only_what_landed(frame):
    source = frame("speech_id long, synced_at timestamp_ntz, analysis_status string, url string", (1, None, "scored", "u1"), (2, None, "scored", None))
    target = frame("url string, speech_id long", ("u0", 0))
    done = sync.incremental_sync(source, source.select("url", "speech_id"), target, ["url"], "speech_id", as_time(NOW), ("url",))
    assert {r["speech_id"] for r in done.source.where("synced_at IS NOT NULL").collect()} == {1}
    assert {r["speech_id"] for r in done.rejected.collect()} == {2} and done.target.count() == 2


def test_sink_types(frame):
    df = frame("Date string, stance_score double, speaker_id string, n int, seen timestamp_ntz, ratio double, year int, ok boolean",
               ("2024-01-01", 0.5, "7", 1, None, 0.1, 2024, True), ("never", None, "x", None, None, float("nan"), None, None))
    assert dict(casts.cast_for_sink(df).dtypes) == {
        "Date": "date", "stance_score": "float", "speaker_id": "bigint", "n": "bigint", "seen": "timestamp_ntz", "ratio": "double",
        "year": "bigint", "ok": "string"}
    assert dict(casts.cast_for_fact(df).dtypes)["ratio"] == "float" and dict(casts.cast_for_fact(df).dtypes)["year"] == "smallint"
    rows = casts.cast_for_extract(df).collect()
    assert rows[1]["ratio"] is None and rows[0]["n"] == 1.0
    assert casts.cast_for_sink(df).where("Date IS NULL AND speaker_id IS NULL").count() == 1
    wide = frame("name string, price double", ("a", 1.0))
    assert casts.slim_fact(wide, "prices").columns == ["price"] and casts.slim_fact(wide, "ECI_DY").columns == ["name", "price"]


def test_versions(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    tables.replace_table(frame("id long", (1,)), root, 1)
    tables.replace_table(frame("id long", (2,)), root, 2)
    tables.replace_table(frame("id long", (3,)), root, 2)
    assert [r["id"] for r in tables.read_latest(spark, root).collect()] == [3]


def test_clashing_ids_are_settled(frame):
    rows = frame("bank_code string, name string, id long, _new boolean", ("A", "x", 1, True), ("A", "y", 1, True), ("A", "z", 2, True), ("A", "old", 3, False), ("A", "v", 3, True))
    got = {r["name"]: r["id"] for r in settle_ids(rows, ["bank_code", "name"], frame("id long", (2,))).collect()}
    assert len(set(got.values())) == 5 and got["old"] == 3 and 2 not in got.values()


def test_first_per_key_keeps_every_column(frame):
    rows = frame("k string, v long, extra array<string>", ("a", 2, ["x"]), ("a", 1, None), (None, 5, ["y"]), (None, 4, []))
    got = {(r["k"], r["v"], None if r["extra"] is None else tuple(r["extra"])) for r in first_per_key(rows, ["k"], F.col("v")).collect()}
    assert got == {("a", 1, None), (None, 4, ())}


def test_hot_key_is_one_row_per_partition_after_the_map_side(spark):
    hot = spark.range(0, 50_000, numPartitions=8).select(
        F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("url"), F.col("id").alias("position"), F.lit("t").alias("title")
    )
    out = ingest.dedupe_first(hot)
    assert out.where("url = 'hot'").first()["position"] == 1 and out.count() == 16_668
    assert "partial_min_by" in out._jdf.queryExecution().executedPlan().toString()
