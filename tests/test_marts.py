"""Daily mart against a day-by-day computation, and late recomputation against a rebuild."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rostrum.operators import marts

START = dt.date(2024, 1, 1)
EVENT = st.tuples(
    st.sampled_from(["A", "B", None]), st.one_of(st.none(), st.integers(0, 70)),
    st.sampled_from(["scored", "no_signal"]), st.one_of(st.none(), st.sampled_from([-1.0, -0.3, 0.0, 0.5, 1.0])),
)
SCHEMA = "speech_id long, bank_code string, date date, analysis_status string, stance_score double"
SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def table(spark, events):
    rows = [(i, b, None if d is None else START + dt.timedelta(d), s, x) for i, (b, d, s, x) in enumerate(events)]
    return spark.createDataFrame(rows, SCHEMA)


def by_hand(events, as_of):
    """The definition, one day at a time."""
    out = {}
    for bank in {b for b, *_ in events if b is not None}:
        days = [START + dt.timedelta(d) for b, d, *_ in events if b == bank and d is not None]
        if not days:
            continue
        day, level, last = min(days), None, None
        while day <= as_of:
            today = [(s, x) for b, d, s, x in events if b == bank and d is not None and START + dt.timedelta(d) == day]
            scores = [x for s, x in today if s == "scored" and x is not None]
            if scores:
                level, last = sum(scores) / len(scores), day
            since = (day - last).days if last else None
            weight = None if since is None else 0.5 ** (since / 14)
            out[bank, day] = (
                round(sum(scores) / len(scores), 9) if scores else None, len(scores), len(today),
                None if level is None else round(level, 9), None if weight is None else round(weight, 9), since,
                int(since is not None and since <= 45), int(bool(scores)),
            )
            day += dt.timedelta(1)
    return out


def collected(df):
    def r(x):
        return None if x is None else round(x, 9)

    return {
        (x["bank_code"], x["date"]): (
            r(x["daily_stance_score"]), x["daily_scored_speech_count"], x["daily_total_speech_count"],
            r(x["stance_level_locf"]), r(x["freshness_weight_hl14d"]), x["days_since_last_scored_speech"],
            x["is_score_fresh"], x["has_scored_speech"],
        )
        for x in df.collect()
    }


@settings(**SETTINGS)
@given(st.lists(EVENT, max_size=12), st.integers(0, 80))
def test_daily_mart(spark, events, last):
    as_of = START + dt.timedelta(last)
    got = marts.daily_mart(table(spark, events), as_of)
    assert collected(got) == by_hand(events, as_of)


@settings(**SETTINGS)
@given(st.lists(EVENT, max_size=8), st.lists(EVENT, max_size=5), st.integers(0, 60), st.integers(0, 20))
def test_late_recompute_equals_rebuild(spark, early, late, before, more):
    old_day, new_day = START + dt.timedelta(before), START + dt.timedelta(before + more)
    everything = table(spark, early + late)
    changed = table(spark, late).select("bank_code", "date")
    previous = marts.daily_mart(table(spark, early), old_day)
    got = marts.recompute_daily(previous, everything, changed.where("bank_code IS NOT NULL"), old_day, new_day)
    assert collected(got) == by_hand(early + late, new_day)


def test_events_and_plot(frame):
    speeches = frame(
        "id long, url string, date date, bank_code string, speaker_id long, title string, fetched_at timestamp_ntz, created_at timestamp_ntz",
        (1, "u1", START, "A", 7, "t1", dt.datetime(2024, 1, 3, 23), None), (2, "u2", START, "A", 99, "t2", None, None),
        (3, "u3", START, "A", None, "t3", None, None), (4, "u4", dt.date(2025, 1, 1), "A", None, "t4", None, None),
    )
    analysis = frame(
        "speech_id long, stance_score double, stance_reason string, keywords string, main_risk string, analysis_status string, analyzed_at timestamp_ntz",
        (1, 0.5, "r", "[]", None, "scored", dt.datetime(2024, 1, 2)), (2, None, None, None, None, "no_signal", None),
        (3, None, None, None, None, "skipped", None), (4, -0.5, "r", None, None, "scored", None),
    )
    members = frame("id long, name string", (7, "Jane Doe"))
    events = marts.events_mart(speeches, analysis, members, F.lit("2024-02-01").cast("timestamp_ntz"))
    rows = {r["speech_id"]: r for r in events.collect()}
    assert set(rows) == {1, 2, 4} and tuple(events.columns) == marts.EVENT_COLUMNS
    assert (rows[1]["speaker"], rows[1]["collection_lag_days"], rows[1]["analysis_lag_days"]) == ("Jane Doe", 2, 1)
    assert rows[2]["speaker"] is None

    daily = marts.daily_mart(events, "2024-01-02")
    assert tuple(daily.columns) == marts.DAILY_COLUMNS
    plot = {r["row_id"]: r for r in marts.plot_mart(daily, events).collect()}
    assert set(plot) == {"line:A:2024-01-01", "line:A:2024-01-02", "bar:1", "bar:4"}
    assert plot["bar:4"]["has_scored_speech"] == 1 and plot["line:A:2024-01-02"]["line_score"] == 0.5


def test_bank_after_as_of_has_no_rows(spark):
    events = table(spark, [("A", 10, "scored", 0.5)])
    assert marts.daily_mart(events, START).count() == 0
    assert marts.calendar_spine(events, START).count() == 0
