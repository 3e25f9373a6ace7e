"""Marts and time series."""

from pyspark.sql import functions as F

from rostrum.functions import scoring
from rostrum.operators import marts
from rostrum.operators.common import as_date, as_time
from rostrum.plans.queries_sinks import SNAPSHOT_SQL, shown_tables
from rostrum.plans.registry import query
from rostrum.plans.views import AS_OF_O, NOW_O
from rostrum.session import work_folder

DAILY_SQL = """
    CAST(date AS VARCHAR) AS date, bank_code, round(daily_stance_score, 6) AS daily_stance_score,
    CAST(scored AS BIGINT) AS daily_scored_speech_count, CAST(total AS BIGINT) AS daily_total_speech_count,
    round(level, 6) AS stance_level_locf, round(weight, 6) AS freshness_weight_hl14d,
    round(level * weight, 6) AS freshness_adjusted_stance, CAST(last_scored AS VARCHAR) AS last_scored_speech_date,
    days_since AS days_since_last_scored_speech,
    CAST(coalesce(days_since <= 45, FALSE) AS BIGINT) AS is_score_fresh,
    CAST(scored > 0 AS BIGINT) AS has_scored_speech,
    '2001-08-01 12:00:00.000000' AS updated_at"""


@query(f"SELECT {DAILY_SQL} FROM daily_o")
def daily_mart(v):
    return marts.daily_mart(v.events_o, AS_OF_O, updated_at=as_time(NOW_O))


@query("""
    SELECT speech_id, url, CAST(date AS VARCHAR) AS date, bank_code, speaker, title, stance_score, stance_reason,
      keywords, main_risk, analysis_status, strftime(analyzed_at, '%Y-%m-%d %H:%M:%S.%f') AS analyzed_at,
      strftime(fetched_at, '%Y-%m-%d %H:%M:%S.%f') AS fetched_at,
      strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, collection_lag_days, analysis_lag_days,
      '2001-08-01 12:00:00.000000' AS updated_at FROM events_o""")
def events_mart(v):
    return v.events_o


@query("""
    SELECT 'line:' || bank_code || ':' || CAST(date AS VARCHAR) AS row_id, CAST(date AS VARCHAR) AS date, bank_code,
      'line' AS mark_type, CAST(NULL AS BIGINT) AS speech_id, CAST(NULL AS VARCHAR) AS speaker,
      CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS stance_reason, round(level, 6) AS line_score,
      CAST(NULL AS DOUBLE) AS bar_score, CAST(NULL AS DOUBLE) AS stance_score,
      round(weight, 6) AS freshness_weight_hl14d, round(level * weight, 6) AS freshness_adjusted_stance,
      days_since AS days_since_last_scored_speech, CAST(coalesce(days_since <= 45, FALSE) AS BIGINT) AS is_score_fresh,
      CAST(scored > 0 AS BIGINT) AS has_scored_speech, '2001-08-01 12:00:00.000000' AS updated_at FROM daily_o
    UNION ALL
    SELECT 'bar:' || speech_id, CAST(date AS VARCHAR), bank_code, 'speech_bar', speech_id, speaker, title,
      stance_reason, NULL, stance_score, stance_score, NULL, NULL, NULL, NULL, 1, '2001-08-01 12:00:00.000000'
    FROM events_o WHERE analysis_status = 'scored' AND stance_score IS NOT NULL""")
def plot_mart(v):
    daily = marts.daily_mart(v.events_at_rest, AS_OF_O, updated_at=as_time(NOW_O))
    return marts.plot_mart(daily, v.events_at_rest)


@query("""
    SELECT 'events' AS mart, count(*) AS n FROM events_o UNION ALL SELECT 'daily', count(*) FROM daily_o
    UNION ALL SELECT 'plot', (SELECT count(*) FROM daily_o) + count(*) FROM events_o
      WHERE analysis_status = 'scored' AND stance_score IS NOT NULL
    UNION ALL SELECT 'total', (SELECT count(*) FROM events_o) * 1 + 2 * (SELECT count(*) FROM daily_o)
      + count(*) FROM events_o WHERE analysis_status = 'scored' AND stance_score IS NOT NULL""")
def mart_counts(v):
    daily = marts.daily_mart(v.events_at_rest, AS_OF_O)
    return marts.mart_counts(marts.Marts(v.events_at_rest, daily, marts.plot_mart(daily, v.events_at_rest)))


@query("""
    SELECT bank_code, CAST(date AS VARCHAR) AS date, count(*) AS daily_total_speech_count FROM events_o GROUP BY 1, 2""")
def daily_total(v):
    return marts.daily_activity(v.events_o).select("bank_code", "date", "daily_total_speech_count")


@query("""
    SELECT bank_code, CAST(date AS VARCHAR) AS date, round(avg(stance_score), 6) AS daily_stance_score,
      count(*) AS daily_scored_speech_count
    FROM events_o WHERE analysis_status = 'scored' AND stance_score IS NOT NULL GROUP BY 1, 2""")
def daily_score(v):
    return marts.daily_activity(v.events_o.where(marts.is_scored())).select(
        "bank_code", "date", "daily_stance_score", "daily_scored_speech_count"
    )


@query("SELECT bank_code, CAST(date AS VARCHAR) AS date FROM daily_o")
def calendar_spine(v):
    return marts.calendar_spine(v.events_o, AS_OF_O)


@query("""
    SELECT bank_code, CAST(date AS VARCHAR) AS date, CAST(total AS BIGINT) AS daily_total_speech_count,
      round(daily_stance_score, 6) AS daily_stance_score, CAST(scored AS BIGINT) AS daily_scored_speech_count FROM daily_o""")
def spine_left(v):
    return marts.spine_join(marts.calendar_spine(v.events_o, AS_OF_O), marts.daily_activity(v.events_o))


def _daily_columns(*names):
    def run(v):
        return marts.daily_mart(v.events_o, AS_OF_O).select("bank_code", "date", *names)

    return run


for _name, _columns, _sql in (
    ("locf_level", ("stance_level_locf",), "round(level, 6) AS stance_level_locf"),
    ("last_scored_date", ("last_scored_speech_date",), "CAST(last_scored AS VARCHAR) AS last_scored_speech_date"),
    ("days_since", ("days_since_last_scored_speech",), "days_since AS days_since_last_scored_speech"),
    ("freshness_weight", ("freshness_weight_hl14d",), "round(weight, 6) AS freshness_weight_hl14d"),
    ("adjusted_stance", ("freshness_adjusted_stance",), "round(level * weight, 6) AS freshness_adjusted_stance"),
    ("is_fresh", ("is_score_fresh",), "CAST(coalesce(days_since <= 45, FALSE) AS BIGINT) AS is_score_fresh"),
):
    query(f"SELECT bank_code, CAST(date AS VARCHAR) AS date, {_sql} FROM daily_o", _name)(_daily_columns(*_columns))


@query("""
    SELECT bank_code, CAST(date AS VARCHAR) AS date, round(power(0.5, days_since / 30.0), 6) AS weight,
      CAST(coalesce(days_since <= 7, FALSE) AS BIGINT) AS is_score_fresh FROM daily_o""")
def daily_mart_custom_decay(v):
    daily = marts.daily_mart(v.events_o, AS_OF_O, half_life_days=30, fresh_days=7)
    return daily.select("bank_code", "date", F.col("freshness_weight_hl14d").alias("weight"), "is_score_fresh")


@query("SELECT speech_id, bank_code, stance_score FROM events_o WHERE analysis_status = 'scored' AND stance_score IS NOT NULL")
def scored_filter(v):
    return v.events_o.where(marts.is_scored()).select("speech_id", "bank_code", "stance_score")


@query("SELECT bank_code, CAST(date AS VARCHAR) AS date, speech_id FROM events_o ORDER BY 1, 2, 3")
def order_events(v):
    return marts.ordered_events(v.events_o).select("bank_code", "date", "speech_id")


@query("SELECT speech_id, collection_lag_days, analysis_lag_days FROM events_o")
def lag_days(v):
    return v.events_o.select("speech_id", "collection_lag_days", "analysis_lag_days")


@query("""
    SELECT id, CAST(CASE WHEN age <= 90 THEN 1.0 WHEN age <= 180 THEN 0.5 WHEN age <= 365 THEN 0.2 ELSE 0.05 END AS DOUBLE)
      AS weight FROM (SELECT id, datediff('day', date, DATE '2001-08-01') AS age FROM speeches_o)""")
def age_weight(v):
    return v.speeches_o.select("id", scoring.age_weight(F.col("date"), as_date(AS_OF_O)).alias("weight"))


@query("""
    SELECT mark_type, bank_code, count(*) AS n FROM (
      SELECT 'line' AS mark_type, bank_code FROM daily_o UNION ALL SELECT 'speech_bar', bank_code FROM events_o
      WHERE analysis_status = 'scored' AND stance_score IS NOT NULL) GROUP BY 1, 2""")
def union_marks(v):
    plot = marts.plot_mart(marts.daily_mart(v.events_at_rest, AS_OF_O), v.events_at_rest)
    return plot.groupBy("mark_type", "bank_code").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'line:' || bank_code || ':' || CAST(date AS VARCHAR) AS row_id FROM daily_o UNION ALL "
       "SELECT 'bar:' || speech_id FROM events_o WHERE analysis_status = 'scored' AND stance_score IS NOT NULL")
def row_id(v):
    return marts.plot_mart(marts.daily_mart(v.events_at_rest, AS_OF_O), v.events_at_rest).select("row_id")


@query("""
    SELECT CAST(d.date AS VARCHAR) AS date, d.bank_code, round(level, 6) AS stance_level_locf, round(rate, 6) AS rate
    FROM daily_o d LEFT JOIN rates_l r ON d.date = r.date AND d.bank_code = r.bank_code""")
def rate_on_daily(v):
    daily = marts.daily_mart(v.events_o, AS_OF_O).select("date", "bank_code", "stance_level_locf")
    return marts.with_rates(daily, v.rates_l)


@query(f"SELECT {DAILY_SQL} FROM daily_o")
def late_recompute(v):
    """The mart of an earlier day, brought up to date after late scores: equals a rebuild."""
    is_late = (F.col("speech_id") % 7 == 0) & (F.col("date") > "2001-03-01")
    early = v.events_at_rest.where(~is_late & (F.col("date") <= "2001-07-01"))
    previous = marts.daily_mart(early, "2001-07-01", updated_at=as_time(NOW_O))
    late = v.events_at_rest.where(is_late | (F.col("date") > "2001-07-01")).select("bank_code", "date")
    return marts.recompute_daily(previous, v.events_at_rest, late, "2001-07-01", AS_OF_O, updated_at=as_time(NOW_O))


@query("SELECT id, date_part('year', date)::BIGINT AS year FROM speeches_o WHERE date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'")
def year_filter(v):
    from rostrum.sources.tables import in_years

    return v.speeches_o.where(in_years(F.col("date"), 1997, 1999)).select("id", F.year("date").alias("year"))


@query("""
    SELECT id, bank_code FROM dated_d WHERE true_date BETWEEN
      CASE bank_code WHEN 'FRB' THEN DATE '2006-01-01' WHEN 'BOJ' THEN DATE '2019-01-01' ELSE DATE '2000-01-01' END
      AND DATE '2021-12-31'""")
def scan_year_slices(v):
    from rostrum.sources.tables import year_slices

    rows = v.dated_d.select("id", "bank_code", F.col("true_date").alias("date"))
    return year_slices(rows, 2021).select("id", "bank_code")


@query(SNAPSHOT_SQL)
def scan_tables(v):
    """The base tables as they are stored, read with their declared schemas, row by row."""
    from rostrum.operators.migrate import add_missing_columns
    from rostrum.sources.tables import read_table

    root = work_folder(v.spark, "base")
    store = {"members": v.members_o, "analysis": v.analysis_o, "speeches": v.speeches_o, "stage_runs": v.runlog_e}
    for name, df in store.items():
        add_missing_columns(df, name).write.parquet(f"{root}/{name}")
    return shown_tables({name: read_table(v.spark, root, name) for name in store})
