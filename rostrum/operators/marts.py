"""Time-series marts: P1, P3, P12, W1-W8, A1, A2, J4, J17, T3, A13."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.functions import dates, scoring
from rostrum.operators.common import as_date, left_join_spread

HALF_LIFE_DAYS = 14
FRESH_DAYS = 45
ANALYZED = ("scored", "no_signal")

EVENT_COLUMNS = (
    "speech_id", "url", "date", "bank_code", "speaker", "title", "stance_score", "stance_reason", "keywords",
    "main_risk", "analysis_status", "analyzed_at", "fetched_at", "created_at", "collection_lag_days",
    "analysis_lag_days", "updated_at",
)
DAILY_COLUMNS = (
    "date", "bank_code", "daily_stance_score", "daily_scored_speech_count", "daily_total_speech_count",
    "stance_level_locf", "freshness_weight_hl14d", "freshness_adjusted_stance", "last_scored_speech_date",
    "days_since_last_scored_speech", "is_score_fresh", "has_scored_speech", "updated_at",
)


def is_scored() -> Column:
    """P12."""
    return (F.col("analysis_status") == "scored") & F.col("stance_score").isNotNull()


def events_mart(speeches: DataFrame, analysis: DataFrame, members: DataFrame, updated_at: Column) -> DataFrame:
    """One row per analysed speech, with speaker and lags.

    The status filter and the column lists reach the scans; the text column is not read.
    """
    a = analysis.where(F.col("analysis_status").isin(*ANALYZED)).select(
        "speech_id", "stance_score", "stance_reason", "keywords", "main_risk", "analysis_status", "analyzed_at"
    )
    s = speeches.select(
        F.col("id").alias("speech_id"), "url", "date", "bank_code", "speaker_id", "title", "fetched_at", "created_at"
    )
    m = members.select(F.col("id").alias("speaker_id"), F.col("name").alias("speaker"))
    return (
        left_join_spread(s.join(a, "speech_id"), m, "speaker_id", "speech_id")
        .withColumn("collection_lag_days", dates.lag_days(F.col("fetched_at"), F.col("date")))
        .withColumn("analysis_lag_days", dates.lag_days(F.col("analyzed_at"), F.col("date")))
        .withColumn("updated_at", updated_at)
        .select(*EVENT_COLUMNS)
    )


def ordered_events(events: DataFrame) -> DataFrame:
    """Final order of the event rows."""
    return events.orderBy("bank_code", "date", "speech_id")


def daily_activity(events: DataFrame) -> DataFrame:
    """A1 + A2 in one pass: totals, scored count and mean score per bank and day.

    Rows without bank or date are dropped. `no_signal` rows count in the total only.
    """
    score = F.when(is_scored(), F.col("stance_score"))
    return (
        events.where(F.col("bank_code").isNotNull() & F.col("date").isNotNull())
        .groupBy("bank_code", "date")
        .agg(
            F.count("speech_id").alias("daily_total_speech_count"),
            F.avg(score).alias("daily_stance_score"),
            F.count(F.when(is_scored(), F.col("speech_id"))).alias("daily_scored_speech_count"),
        )
    )


def _carry(days: DataFrame, end: Column, *group: str) -> DataFrame:
    """W1-W4 from days with activity to every day up to `end`.

    `days` has one row per bank and active day with `level` and `scored_on` (both null
    where nothing was scored). Each row is stretched to the day before the next active
    day, so the calendar, the carried level and the carried date come out of one window
    over active days, without building a spine and joining onto it. The window group of a
    bank (or of a segment of one, named by the columns of `group`) is bounded by the number of
    calendar days, however many speeches it has.
    """
    by_date = Window.partitionBy("bank_code", *group).orderBy("date")
    upto = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = days.select(
        "*",
        F.last("level", ignorenulls=True).over(upto).alias("stance_level_locf"),
        F.max("scored_on").over(upto).alias("last_scored_speech_date"),
        F.coalesce(F.date_sub(F.lead("date").over(by_date), 1), end).alias("until"),
    )
    return spans.withColumn("day", F.explode(F.expr("sequence(date, until, interval 1 day)")))


def _finish_daily(
    spans: DataFrame, as_of: str | dt.date, half_life_days: int, fresh_days: int, updated_at: Column | None
) -> DataFrame:
    active = F.col("day") == F.col("date")
    zero = F.lit(0).cast("long")
    days_since = F.datediff("day", "last_scored_speech_date").cast("long")
    weight = scoring.freshness(days_since, half_life_days)
    scored = F.when(active, F.col("daily_scored_speech_count")).otherwise(zero)
    return spans.select(
        F.col("day").alias("date"),
        "bank_code",
        F.when(active, F.col("daily_stance_score")).alias("daily_stance_score"),
        scored.alias("daily_scored_speech_count"),
        F.when(active, F.col("daily_total_speech_count")).otherwise(zero).alias("daily_total_speech_count"),
        "stance_level_locf",
        weight.alias("freshness_weight_hl14d"),
        (F.col("stance_level_locf") * weight).alias("freshness_adjusted_stance"),
        "last_scored_speech_date",
        days_since.alias("days_since_last_scored_speech"),
        F.coalesce(days_since <= fresh_days, F.lit(False)).cast("long").alias("is_score_fresh"),
        (scored > 0).cast("long").alias("has_scored_speech"),
        (F.lit(str(as_of)[:10]).cast("timestamp_ntz") if updated_at is None else updated_at).alias("updated_at"),
    )


def _active_days(events: DataFrame, as_of: str | dt.date) -> DataFrame:
    days = daily_activity(events.where(F.col("date") <= as_date(as_of)))
    return days.select(
        "*",
        F.col("daily_stance_score").alias("level"),
        F.when(F.col("daily_scored_speech_count") > 0, F.col("date")).alias("scored_on"),
    )


def calendar_spine(events: DataFrame, as_of: str | dt.date) -> DataFrame:
    """W1 alone: every day of a bank from its first event to `as_of`; none for a bank that
    starts later."""
    first = (
        events.where(F.col("bank_code").isNotNull())
        .groupBy("bank_code").agg(F.min("date").alias("first_day"))
        .where(F.col("first_day") <= as_date(as_of))
    )
    return first.select(
        "bank_code",
        F.explode(F.sequence("first_day", as_date(as_of), F.expr("interval 1 day"))).alias("date"),
    )


def spine_join(spine: DataFrame, activity: DataFrame) -> DataFrame:
    """Daily values on a given calendar; days without activity count zero."""
    return spine.join(activity, ["bank_code", "date"], "left").fillna(
        0, ["daily_total_speech_count", "daily_scored_speech_count"]
    )


def daily_mart(
    events: DataFrame,
    as_of: str | dt.date,
    half_life_days: int = HALF_LIFE_DAYS,
    fresh_days: int = FRESH_DAYS,
    updated_at: Column | None = None,
) -> DataFrame:
    """One row per bank and day up to `as_of`, with the state of the score.

    Two shuffles, both after partial aggregation: by (bank, day), then by bank.
    """
    return _finish_daily(_carry(_active_days(events, as_of), as_date(as_of)), as_of, half_life_days, fresh_days, updated_at)


def recompute_daily(
    previous: DataFrame,
    events: DataFrame,
    late: DataFrame,
    previous_as_of: str | dt.date,
    as_of: str | dt.date,
    half_life_days: int = HALF_LIFE_DAYS,
    fresh_days: int = FRESH_DAYS,
    updated_at: Column | None = None,
) -> DataFrame:
    """The daily mart after late or new events, equal to a full rebuild.

    `late` holds (bank_code, date) of changed events, old and new date of a moved one.
    Only days from the earliest change of a bank on are computed; the row of the day
    before supplies the level to carry, and earlier rows are kept as they are.
    """
    next_day = F.date_add(as_date(previous_as_of), 1)
    changed = late.where(F.col("date").isNotNull()).groupBy("bank_code").agg(F.min("date").alias("changed_from"))
    # A bank whose first event is one of the new days has no row yet.
    begun = events.where(F.col("bank_code").isNotNull() & F.col("date").between(next_day, as_date(as_of))).select("bank_code")
    known = previous.select("bank_code").unionByName(begun).distinct()
    start = known.join(changed, "bank_code", "full_outer").select(
        "bank_code", F.least(F.coalesce("changed_from", next_day), next_day).alias("start")
    )
    with_start = previous.join(start, "bank_code")
    kept = with_start.where(F.col("date") < F.col("start")).select(*DAILY_COLUMNS)

    zero = F.lit(0).cast("long")
    seed = with_start.where(F.col("date") == F.date_sub("start", 1)).select(
        "bank_code", "date", zero.alias("daily_total_speech_count"),
        F.lit(None).cast("double").alias("daily_stance_score"), zero.alias("daily_scored_speech_count"),
        F.col("stance_level_locf").alias("level"), F.col("last_scored_speech_date").alias("scored_on"),
        F.lit(True).alias("is_seed"),
    )
    # Events before the earliest start of all are not read; the rest is reduced to days
    # before it meets the start of its bank.
    earliest = start.agg(F.min("start").alias("s")).scalar()
    tail = (
        _active_days(events.where(F.col("date") >= earliest), as_of).join(start, "bank_code").where(F.col("date") >= F.col("start")).drop("start")
        .withColumn("is_seed", F.lit(False))
    )
    spans = _carry(seed.unionByName(tail), as_date(as_of))
    spans = spans.where(~(F.col("is_seed") & (F.col("day") == F.col("date"))))
    rebuilt = _finish_daily(spans, as_of, half_life_days, fresh_days, updated_at)
    return kept.unionByName(rebuilt)


def part_of(bank: Column, date: Column, period: str = "month") -> Column:
    """The part of the stored daily mart that a bank's day belongs to."""
    return F.concat_ws("|", bank, F.trunc(date, period).cast("string"))


def changed_segments(events: DataFrame, late: DataFrame, previous_as_of: str | dt.date, as_of: str | dt.date) -> DataFrame:
    """(bank_code, first, last): the days whose row can differ after changes at `late` (bank_code, date).

    A change at a day reaches to the day before the bank's next scored one, from which on the level is that day's
    own. One window over a bank's days; days up to `as_of` that the previous build did not have follow its last.
    """
    changed = late.where(F.col("date").isNotNull() & F.col("bank_code").isNotNull() & (F.col("date") <= as_date(as_of))).select(
        "bank_code", "date", F.lit(True).alias("_changed"), F.lit(False).alias("_scored"))
    if str(previous_as_of)[:10] < str(as_of)[:10]:
        banks = events.where(F.col("bank_code").isNotNull()).select("bank_code").distinct()
        changed = changed.unionByName(banks.select(
            "bank_code", F.date_add(as_date(previous_as_of), 1).alias("date"), F.lit(True).alias("_changed"), F.lit(False).alias("_scored")))
    scored = events.where(is_scored() & F.col("bank_code").isNotNull() & F.col("date").isNotNull()).select(
        "bank_code", "date", F.lit(False).alias("_changed"), F.lit(True).alias("_scored"))
    days = changed.unionByName(scored).groupBy("bank_code", "date").agg(F.max("_changed").alias("_changed"), F.max("_scored").alias("_scored"))
    behind = Window.partitionBy("bank_code").orderBy("date").rowsBetween(1, Window.unboundedFollowing)
    until = F.date_sub(F.min(F.when(F.col("_scored"), F.col("date"))).over(behind), 1)
    return days.withColumn("last", F.least(F.coalesce(until, as_date(as_of)), as_date(as_of))).where("_changed").select(
        "bank_code", F.col("date").alias("first"), F.greatest("date", "last").alias("last"))


def touched_parts(segments: DataFrame, as_of: str | dt.date, period: str = "month") -> DataFrame:
    """The parts that segments meet, neighbouring ones of a bank as one run: (bank_code, part, run_first, run_last)."""
    step = F.expr(f"interval 1 {period}")
    parts = segments.select("bank_code", F.explode(F.sequence(F.trunc("first", period), F.trunc("last", period), step)).alias("begin")).distinct()
    by_begin = Window.partitionBy("bank_code").orderBy("begin")
    fresh = F.coalesce(F.lag("begin").over(by_begin) + step != F.col("begin"), F.lit(True))
    runs = parts.withColumn("_run", F.sum(fresh.cast("int")).over(by_begin))
    whole = Window.partitionBy("bank_code", "_run")
    return runs.select(
        "bank_code", part_of(F.col("bank_code"), F.col("begin"), period).alias("part"), F.min("begin").over(whole).alias("run_first"),
        F.least(F.date_sub((F.max("begin").over(whole) + step).cast("date"), 1), as_date(as_of)).alias("run_last"))


def recompute_parts(
    seeds: DataFrame, events: DataFrame, touched: DataFrame, as_of: str | dt.date, half_life_days: int = HALF_LIFE_DAYS,
    fresh_days: int = FRESH_DAYS, updated_at: Column | None = None,
) -> DataFrame:
    """The daily mart of the `touched` parts alone, as a full rebuild would have it.

    `seeds` has the stored rows of the days before the runs of touched parts; their level and
    last scored date are carried into the run. Events before the first run are not read.
    """
    runs = touched.select("bank_code", "run_first", "run_last").distinct()
    zero = F.lit(0).cast("long")
    seed = seeds.join(runs, "bank_code").where(F.col("date") == F.date_sub("run_first", 1)).select(
        "bank_code", "run_first", "run_last", "date", zero.alias("daily_total_speech_count"),
        F.lit(None).cast("double").alias("daily_stance_score"), zero.alias("daily_scored_speech_count"),
        F.col("stance_level_locf").alias("level"), F.col("last_scored_speech_date").alias("scored_on"))
    earliest = runs.agg(F.min("run_first").alias("s")).scalar()
    days = _active_days(events.where(F.col("date") >= earliest), as_of).join(runs, "bank_code").where(
        F.col("date").between(F.col("run_first"), F.col("run_last")))
    spans = _carry(seed.unionByName(days), F.col("run_last"), "run_first").where(F.col("day") >= F.col("run_first"))
    return _finish_daily(spans, as_of, half_life_days, fresh_days, updated_at)


def plot_mart(daily: DataFrame, events: DataFrame) -> DataFrame:
    """Lines (one per daily row) and bars (one per scored event) in one table."""
    def null(kind: str) -> Column:
        return F.lit(None).cast(kind)

    lines = daily.select(
        F.concat(F.lit("line:"), F.col("bank_code"), F.lit(":"), F.col("date").cast("string")).alias("row_id"),
        "date", "bank_code", F.lit("line").alias("mark_type"),
        null("long").alias("speech_id"), null("string").alias("speaker"),
        null("string").alias("title"), null("string").alias("stance_reason"),
        F.col("stance_level_locf").alias("line_score"),
        null("double").alias("bar_score"), null("double").alias("stance_score"),
        "freshness_weight_hl14d", "freshness_adjusted_stance", "days_since_last_scored_speech",
        "is_score_fresh", "has_scored_speech", "updated_at",
    )
    bars = events.where(is_scored()).select(
        F.concat(F.lit("bar:"), F.col("speech_id").cast("string")).alias("row_id"),
        "date", "bank_code", F.lit("speech_bar").alias("mark_type"),
        "speech_id", "speaker", "title", "stance_reason",
        null("double").alias("line_score"),
        F.col("stance_score").alias("bar_score"), "stance_score",
        null("double").alias("freshness_weight_hl14d"), null("double").alias("freshness_adjusted_stance"),
        null("long").alias("days_since_last_scored_speech"), null("long").alias("is_score_fresh"),
        F.lit(1).cast("long").alias("has_scored_speech"), "updated_at",
    )
    return lines.unionByName(bars)


def with_rates(daily: DataFrame, rates: DataFrame) -> DataFrame:
    """External daily series next to the mart, by day and bank."""
    return daily.join(rates, ["date", "bank_code"], "left")


class Marts(NamedTuple):
    events: DataFrame
    daily: DataFrame
    plot: DataFrame


def mart_counts(marts: Marts) -> DataFrame:
    """Rows per mart and in total."""
    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("mart"), "n")

    parts = counted("events", marts.events).unionByName(counted("daily", marts.daily)).unionByName(
        counted("plot", marts.plot)
    )
    return parts.rollup("mart").agg(F.sum("n").alias("n")).select(
        F.coalesce("mart", F.lit("total")).alias("mart"), "n"
    )
