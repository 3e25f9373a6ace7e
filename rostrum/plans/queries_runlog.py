"""Run logs and status."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rostrum.functions import logs
from rostrum.operators import runlog
from rostrum.plans.registry import SQL, query
from rostrum.session import materialize, work_folder
from rostrum.sinks import logstore, tables
from rostrum.sources.runlogs import parse_log, read_log, read_status_events

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
TS_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S,%g')"


def _lines(v):
    """Parsed lines as a table at rest: logs are parsed once and then queried."""
    return materialize(parse_log(v.log_lines_e), "log-lines")


def _rough_runs(v):
    """The same lines, of which some have no status, some no readable time, and some further counters."""
    return materialize(runlog.split_runs(materialize(parse_log(v.rough_lines_e), "rough-lines")), "rough-runs")


def _runs(v):
    """Lines with their run, at rest too: job analytics read them several times."""
    return materialize(runlog.split_runs(_lines(v)), "log-runs")


EXTRA_SQL = """CASE event_type WHEN 'signup' THEN 'run_id=R' || event_id || ', mode=recent'
      WHEN 'purchase' THEN 'run_id=F' || event_id || ', status=' || status || ', duration_sec=' || value || ', total_new=' || k || ', analyzed_items=' || (k % 5)
      WHEN 'click' THEN 'job_name=' || job_name || ', status=' || status
      WHEN 'view' THEN 'job_name=' || job_name || ', status=' || status || ', duration_sec=' || value || ', new_items=' || k
      ELSE 'error_message=code:' || k || '; url lost' END"""


@query(f"SELECT event_id AS seq, {TS_TEXT} || ' | ' || level || ' | rostrum | ' || message || ' | ' || {EXTRA_SQL} AS value FROM log_fields_e")
def format_log_line(v):
    return v.log_lines_e.select("seq", "value")


@query(f"""
    SELECT event_id AS seq, source, {STAMP.format('ts')} AS ts, level, 'rostrum' AS logger, message, {EXTRA_SQL} AS extra_text,
      CASE WHEN event_type IN ('click', 'view') THEN job_name END AS job_name FROM log_fields_e""")
def scan_run_log(v):
    broken = v.log_lines_e.select("source", "block", "seq", F.concat(F.lit("  stack trace | of "), "seq").alias("value"))
    return parse_log(v.log_lines_e.unionByName(broken)).select(
        "seq", "source", "ts", "level", "logger", "message", "extra_text",
        F.try_element_at("extra", F.lit("job_name")).alias("job_name"),
    )


@query(f"""
    SELECT {STAMP.format('ts')} AS ts, level, 'rostrum' AS logger, message, {EXTRA_SQL} AS extra_text,
      CASE WHEN event_type IN ('click', 'view') THEN job_name END AS job_name FROM log_fields_e""")
def scan_run_log_file(v):
    """Lines written to text files and read from them in their splits."""
    path = work_folder(v.spark, "log-files")
    tables.write_log(v.log_lines_e, F.col("value"), path)
    return parse_log(read_log(v.spark, path)).select(
        "ts", "level", "logger", "message", "extra_text", F.try_element_at("extra", F.lit("job_name")).alias("job_name"))


@query("SELECT event_id, CAST(k AS VARCHAR) AS k, 'last' AS twice, CAST(3 AS BIGINT) AS n FROM log_fields_e")
def parse_kv(v):
    text = F.concat(F.lit("k="), F.col("k").cast("string"), F.lit(", twice=first, =nokey, noequals, e= a=b , twice=last"))
    rows = v.log_fields_e.select("event_id", logs.parse_kv(text).alias("m"))
    return rows.select("event_id", F.col("m")["k"].alias("k"), F.col("m")["twice"].alias("twice"), F.size("m").alias("n"))


@query("""
    SELECT event_id, CASE status WHEN 'partial' THEN 'warning' WHEN 'fail' THEN 'failed' ELSE status END AS status,
      'unknown' AS other FROM log_fields_e""")
def normalize_status(v):
    return v.log_fields_e.select(
        "event_id", logs.normalize_status(F.upper("status")).alias("status"), logs.normalize_status(F.lit("odd")).alias("other")
    )


@query("SELECT event_id AS seq, source, run_no, CAST(run_no = last_run AS BIGINT) AS is_latest FROM log_runs_e")
def split_runs(v):
    return runlog.split_runs(_lines(v)).select("seq", "source", "run_no", "is_latest")


@query("SELECT event_id AS seq, source FROM log_runs_e WHERE run_no = last_run")
def latest_run(v):
    return runlog.latest_run(_lines(v)).select("seq", "source")


@query("SELECT event_id AS seq, level FROM log_fields_e WHERE level IN ('WARNING', 'ERROR', 'EXCEPTION')")
def issue_filter(v):
    return runlog.issues(_lines(v)).select("seq", "level")


@query("SELECT event_id AS seq FROM log_fields_e WHERE level = 'INFO' AND job_name = 'collect_ecb' AND event_type IN ('click', 'view')")
def log_search(v):
    return runlog.search_lines(_lines(v), "INFO", " COLLECT_ECB ").select("seq")


def _stored(v):
    root = work_folder(v.spark, "log-store")
    logstore.store_log(parse_log(v.log_lines_e), root)
    return root


@query(SQL["issue_filter"])
def issue_filter_stored(v):
    """P17 over stored lines: the folders of other levels are not opened."""
    return logstore.stored_issues(v.spark, _stored(v)).select("seq", "level")


@query(SQL["log_search"])
def log_search_stored(v):
    """P18 over stored lines: only folders that hold every gram of the keyword are opened."""
    return logstore.search_stored(v.spark, _stored(v), "INFO", " COLLECT_ECB ").select("seq")


@query(f"""
    SELECT source, run_no, arg_min({TS_TEXT}, event_id) AS first_ts, arg_min(message, event_id) AS first_message,
      arg_max({TS_TEXT}, event_id) AS last_ts, arg_max(message, event_id) AS last_message
    FROM log_runs_e WHERE message = 'Finished sync run' OR (event_type IN ('click', 'view') AND job_name IN ('collect_frb', 'postgres_sync'))
    GROUP BY 1, 2""")
def token_events(v):
    return runlog.token_events(_runs(v), ("Finished sync run", "collect_frb", "postgres_sync"))


JOB_CASE = "CASE job " + " ".join(f"WHEN '{k}' THEN '{{0}}'".replace("{0}", s) for k, s, _ in logs.JOBS) + " END"
LABEL_CASE = "CASE job " + " ".join(f"WHEN '{k}' THEN '{name}'" for k, _, name in logs.JOBS) + " END"


@query(f"""
    SELECT source, run_no, job, {JOB_CASE} AS stage, {LABEL_CASE} AS label, {STAMP.format('start_ts')} AS start_ts,
      {STAMP.format('end_ts')} AS end_ts, status, round(duration, 6) AS duration, job_events FROM log_jobs_e""")
def job_first_last(v):
    return runlog.jobs(_runs(v)).select(
        "source", "run_no", "job", "stage", "label", "start_ts", "end_ts", "status", "duration", "job_events"
    )


@query("SELECT source, run_no, job, CAST(new_items AS BIGINT) AS new_items, CAST(NULL AS BIGINT) AS synced_items FROM log_jobs_e")
def job_detail(v):
    return runlog.jobs(_runs(v)).select("source", "run_no", "job", "new_items", "synced_items")


@query(f"""
    SELECT source, run_no, job, {JOB_CASE} AS stage, {STAMP.format('start_ts')} AS start_ts, {STAMP.format('end_ts')} AS end_ts,
      CASE WHEN reported IS NULL THEN CASE WHEN errors THEN 'failed' WHEN warnings THEN 'warning' ELSE 'success' END
        WHEN reported = 'partial' THEN 'warning' WHEN reported = 'fail' THEN 'failed' ELSE reported END AS status, job_events
    FROM rough_jobs_e JOIN (SELECT source, run_no, job, bool_or(level = 'ERROR') AS errors, bool_or(level = 'WARNING') AS warnings
      FROM rough_spans_e GROUP BY 1, 2, 3) USING (source, run_no, job)""")
def job_status_inferred(v):
    """W12 and X31 on lines without status and without readable times."""
    return runlog.jobs(_rough_runs(v)).select("source", "run_no", "job", "stage", "start_ts", "end_ts", "status", "job_events")


@query("""
    SELECT event_id AS seq, source, run_no, job, level FROM rough_spans_e WHERE level IN ('WARNING', 'ERROR', 'EXCEPTION')""")
def issues_in_open_spans(v):
    """J14 with open ends: starts and ends without a readable time."""
    runs = _rough_runs(v)
    return runlog.issues_in_jobs(runs, runlog.jobs(runs)).select("seq", "source", "run_no", "job", "level")


@query("""
    SELECT source, run_no, job, count(*) AS events, count(*) FILTER (WHERE level IN ('WARNING', 'ERROR', 'EXCEPTION')) AS issues
    FROM rough_spans_e GROUP BY 1, 2, 3""")
def job_counts_open_spans(v):
    """A17 with open ends; a job whose span is empty has its own lines."""
    runs = _rough_runs(v)
    return runlog.job_counts(runs, runlog.jobs(runs))


@query("""
    SELECT source, run_no, job, new_items, synced_items, source_synced_items, tableau_mart_items, mart_daily_rows FROM rough_jobs_e""")
def job_counters(v):
    """The counters of a job's deciding line."""
    return runlog.jobs(_rough_runs(v)).select(
        "source", "run_no", "job", "new_items", "synced_items", "source_synced_items", "tableau_mart_items", "mart_daily_rows")


@query(f"""
    SELECT source, run_no, 'finish' AS stage, {STAMP.format('finish.ts')} AS end_ts,
      CASE WHEN finish.status = 'partial' THEN 'warning' WHEN finish.status = 'fail' THEN 'failed' WHEN finish.status IS NOT NULL THEN finish.status
        WHEN errors THEN 'failed' WHEN finish IS NOT NULL THEN 'success' ELSE 'unknown' END AS status,
      round(coalesce(finish.value, 0), 6) AS duration, CAST(finish.k AS BIGINT) AS total_new,
      CAST(finish.k + 1 AS BIGINT) AS source_synced_items, CAST(finish.k + 2 AS BIGINT) AS tableau_mart_items
    FROM (SELECT source, run_no, bool_or(level = 'ERROR') AS errors,
      arg_max({{'ts': ts, 'k': k, 'value': value, 'status': status}}, event_id) FILTER (WHERE message = 'Finished sync run') AS finish
      FROM rough_runs_e GROUP BY 1, 2)""")
def finish_row(v):
    """The closing row of each run."""
    return runlog.finish_rows(_rough_runs(v)).select(
        "source", "run_no", "stage", "end_ts", "status", "duration", "total_new", "source_synced_items", "tableau_mart_items")


@query("""
    SELECT source, run_no, CAST(arg_max(k + 1, event_id) FILTER (WHERE message = 'Finished sync run') AS BIGINT) AS source_synced_items,
      CAST(arg_max(k + 2, event_id) FILTER (WHERE message = 'Finished sync run') AS BIGINT) AS tableau_mart_items
    FROM rough_runs_e GROUP BY 1, 2""")
def run_counters(v):
    """The two counters of a run's finish that the plain log does not have."""
    return runlog.run_summary(_rough_runs(v)).select("source", "run_no", "source_synced_items", "tableau_mart_items")


@query(f"SELECT DISTINCT job, {JOB_CASE} AS stage, {LABEL_CASE} AS label FROM log_jobs_e")
def stage_of_job(v):
    names = v.log_fields_e.select(F.col("job_name").alias("job")).distinct()
    return names.select("job", logs.stage_of_job(F.col("job")).alias("stage"), logs.label_of_job(F.col("job")).alias("label"))


@query("""
    SELECT r.event_id AS seq, r.source, r.run_no, j.job, r.level FROM log_runs_e r JOIN log_jobs_e j
      ON r.source = j.source AND r.run_no = j.run_no AND (r.ts BETWEEN j.start_ts AND j.end_ts
        OR (j.start_ts > j.end_ts AND r.message = 'Pipeline job status' AND r.job_name = j.job))
    WHERE r.level IN ('WARNING', 'ERROR', 'EXCEPTION')""")
def issues_in_job(v):
    runs = _runs(v)
    return runlog.issues_in_jobs(runs, runlog.jobs(runs)).select("seq", "source", "run_no", "job", "level")


@query("""
    SELECT j.source, j.run_no, j.job, count(*) AS events,
      count(*) FILTER (WHERE r.level IN ('WARNING', 'ERROR', 'EXCEPTION')) AS issues
    FROM log_runs_e r JOIN log_jobs_e j ON r.source = j.source AND r.run_no = j.run_no AND (r.ts BETWEEN j.start_ts AND j.end_ts
      OR (j.start_ts > j.end_ts AND r.message = 'Pipeline job status' AND r.job_name = j.job))
    GROUP BY 1, 2, 3""")
def job_counts(v):
    runs = _runs(v)
    return runlog.job_counts(runs, runlog.jobs(runs))


@query(f"SELECT source, run_no, {JOB_CASE} AS stage, count(*) AS jobs FROM log_jobs_e GROUP BY 1, 2, 3")
def stage_counts(v):
    return runlog.stage_counts(runlog.jobs(_runs(v)))


@query("""
    SELECT source, run_no, job, round(duration, 6) AS duration,
      round(duration / sum(duration) OVER (PARTITION BY source, run_no), 6) AS share
    FROM log_jobs_e WHERE status <> 'skipped' AND duration > 0.05""")
def duration_share(v):
    return runlog.duration_share(runlog.jobs(_runs(v)))


RUN_SQL = """
    SELECT source, run_no, count(*) AS events, min(event_id) AS first_id, max(event_id) AS last_id, min(ts) AS first_ts, arg_max(ts, event_id) AS last_ts,
      bool_or(level = 'ERROR') AS has_error, min(CASE WHEN message = 'Starting sync run' THEN event_id END) AS start_id,
      max(CASE WHEN message = 'Finished sync run' THEN event_id END) AS finish_id,
      arg_max(ts, CASE WHEN message = 'Finished sync run' THEN event_id END) AS finish_ts,
      arg_max(status, CASE WHEN message = 'Finished sync run' THEN event_id END) AS finish_status,
      arg_max(value, CASE WHEN message = 'Finished sync run' THEN event_id END) AS finish_value,
      arg_max(k, CASE WHEN message = 'Finished sync run' THEN event_id END) AS finish_k
    FROM log_runs_e GROUP BY 1, 2"""


@query(f"""
    SELECT source, run_no, CASE WHEN finish_id IS NOT NULL THEN 'F' || finish_id WHEN start_id IS NOT NULL THEN 'R' || start_id END AS run_id,
      {STAMP.format('first_ts')} AS started, {STAMP.format('coalesce(finish_ts, last_ts)')} AS ended,
      CASE WHEN finish_id IS NULL THEN CASE WHEN has_error THEN 'failed' ELSE 'unknown' END
        WHEN finish_status = 'partial' THEN 'warning' WHEN finish_status = 'fail' THEN 'failed' ELSE finish_status END AS status,
      round(coalesce(finish_value, (epoch_us(last_ts) - epoch_us(first_ts)) / 1000000.0), 6) AS duration, events,
      CAST(finish_k AS BIGINT) AS total_new, CAST(NULL AS BIGINT) AS total_refreshed, CAST(finish_k % 5 AS BIGINT) AS analyzed_items,
      CAST(NULL AS BIGINT) AS synced_items, CAST(NULL AS BIGINT) AS source_synced_items, CAST(NULL AS BIGINT) AS tableau_mart_items,
      CAST(NULL AS VARCHAR) AS failed_steps FROM ({RUN_SQL})""")
def run_summary(v):
    return runlog.run_summary(_runs(v))


@query("""
    SELECT source, run_no, CASE WHEN errors THEN 'failed' WHEN warnings THEN 'warning' WHEN ended THEN 'success' ELSE 'running' END AS status
    FROM (SELECT source, run_no, bool_or(level = 'ERROR') AS errors, bool_or(level = 'WARNING') AS warnings,
      bool_or(message = 'Finished sync run') AS ended FROM log_runs_e GROUP BY 1, 2)""")
def infer_status(v):
    found = _runs(v).groupBy("source", "run_no").agg(
        F.bool_or(F.col("level").isin(*logs.ERROR_LEVELS)).alias("e"), F.bool_or(F.col("level") == "WARNING").alias("w"),
        F.bool_or(F.col("message") == logs.RUN_FINISH).alias("f"),
    )
    status = logs.infer_status(F.lit(True), F.col("e"), F.col("w"), F.col("f"))
    return found.select("source", "run_no", status.alias("status"))


# --- stage table --------------------------------------------------------------------------


@query(f"""
    SELECT run_id, {STAMP.format('min(started_at)')} AS started_at, {STAMP.format('max(finished_at)')} AS finished_at
    FROM runlog_e GROUP BY 1 ORDER BY min(runlog_e.started_at) DESC, run_id LIMIT 5""")
def run_span(v):
    return runlog.run_span(v.runlog_e, limit=5)


@query("""
    SELECT id, run_id, stage_name FROM runlog_e WHERE run_id IN (SELECT run_id FROM runlog_e GROUP BY 1
      ORDER BY min(started_at) DESC, run_id LIMIT 5)""")
def stage_order(v):
    return runlog.stage_order(v.runlog_e, limit=5).select("id", "run_id", "stage_name")


@query(f"""
    SELECT run_id, {STAMP.format('min(started_at)')} AS started_at, {STAMP.format('max(finished_at)')} AS finished_at FROM runlog_e GROUP BY 1""")
def run_span_all(v):
    """A9 of every run."""
    return runlog.run_span(v.runlog_e)


@query("SELECT id, run_id, stage_name, row_number() OVER (PARTITION BY run_id ORDER BY started_at, id) AS place FROM runlog_e")
def stage_order_all(v):
    """W14 of every run, each stage with its place."""
    place = F.row_number().over(Window.partitionBy("run_id").orderBy("started_at", "id"))
    return runlog.stage_order(v.runlog_e).select("id", "run_id", "stage_name", place.alias("place"))


@query("""
    SELECT id, run_id, round((epoch_us(finished_at) - epoch_us(started_at)) / 1000000.0, 6) AS duration_seconds, item_count FROM runlog_e""")
def record_stage(v):
    return runlog.record_stages(v.runlog_e).select("id", "run_id", "duration_seconds", "item_count")


@query("""
    SELECT id, CASE WHEN id % 10 <> 0 THEN CAST(item_count AS VARCHAR) END AS k,
      CASE WHEN id % 10 = 0 THEN 'bad ' || id END AS raw FROM runlog_e""")
def details_json(v):
    parsed = v.runlog_e.select("id", logs.details(F.col("details_json")).alias("d"))
    return parsed.select("id", F.try_element_at("d", F.lit("k")).alias("k"), F.try_element_at("d", F.lit("raw")).alias("raw"))


def _results(v):
    return v.table("events").select(
        F.concat(F.lit("run"), "user_id").alias("run_id"),
        F.when(F.col("event_id") % 3 == 0, "analysis").when(F.col("event_id") % 3 == 1, "sync").otherwise("bank").alias("step"),
        F.when((F.col("event_type") == "error") & (F.col("value") > 60), "failed").otherwise("success").alias("status"),
        F.when(F.col("value") > 90, F.lit(1)).alias("new"), F.lit(2).alias("refreshed"), F.lit(3).alias("analyzed"),
        F.lit(None).cast("int").alias("synced"),
    )


@query("""
    SELECT run_id, total_new, total_refreshed, analyzed_items, synced_items,
      CASE WHEN bank_failed > 0 AND total_new > 0 THEN 'partial' WHEN bank_failed > 0 THEN 'failed'
        WHEN later_failed > 0 THEN 'partial' ELSE 'success' END AS status
    FROM (SELECT 'run' || user_id AS run_id, count(*) FILTER (WHERE value > 90) AS total_new, 2 * count(*) AS total_refreshed,
      3 * count(*) AS analyzed_items, CAST(0 AS BIGINT) AS synced_items,
      count(*) FILTER (WHERE event_type = 'error' AND value > 60 AND event_id % 3 = 2) AS bank_failed,
      count(*) FILTER (WHERE event_type = 'error' AND value > 60 AND event_id % 3 <> 2) AS later_failed FROM events GROUP BY 1)""")
def run_totals(v):
    return runlog.run_totals(_results(v))


STATUS_SQL = f"SELECT {{0}}, arg_max(state, event_id) AS state, {STAMP.format('max(event_at)')} AS event_at FROM status_e GROUP BY 1"


@query(STATUS_SQL.format("bank_code"))
def latest_status(v):
    return runlog.latest_status(v.status_e, "bank_code")


@query(STATUS_SQL.format("stage"))
def latest_stage_status(v):
    return runlog.latest_status(v.status_e, "stage")


@query(f"""
    SELECT state FROM ({STATUS_SQL.format('bank_code')}) ORDER BY CASE state WHEN 'failed' THEN 4 WHEN 'partial' THEN 3
      WHEN 'running' THEN 2 WHEN 'success' THEN 1 ELSE 0 END DESC, state DESC LIMIT 1""")
def worst_state(v):
    return runlog.worst_state(runlog.latest_status(v.status_e, "bank_code"))


@query(f"SELECT event_id, stage, state, {STAMP.format('event_at')} AS event_at FROM status_e")
def scan_event_jsonl(v):
    """Status events as JSON lines and back."""
    from rostrum import schemas

    line = F.to_json(F.struct(
        F.lit("x").alias("service"), "stage", F.col("state").alias("status"), F.col("event_id").cast("string").alias("run_id"),
        F.date_format("event_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_at"),
    ))
    rows = v.status_e.select(F.from_json(line, schemas.STATUS_EVENTS).alias("e")).select("e.*")
    return rows.select(F.col("run_id").cast("long").alias("event_id"), "stage", F.col("status").alias("state"), "event_at")



@query(SQL["scan_event_jsonl"])
def scan_event_jsonl_file(v):
    """S5 from real files of JSON lines."""
    line = F.to_json(F.struct(
        F.lit("x").alias("service"), "stage", F.col("state").alias("status"), F.col("event_id").cast("string").alias("run_id"),
        F.date_format("event_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_at")))
    path = work_folder(v.spark, "status-files")
    v.status_e.select(line.alias("value")).write.text(path)
    return read_status_events(v.spark, path).select(
        F.col("run_id").cast("long").alias("event_id"), "stage", F.col("status").alias("state"), "event_at")
