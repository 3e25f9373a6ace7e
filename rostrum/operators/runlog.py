"""Run-log analytics: W11, W12, W14, A9, A11, A12, A14, A17, A18, J14, P17, P18, P21, D16.

Parsed log lines have (source, block, seq) as their order; `block` bounds how many lines
share one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum import schemas
from rostrum.functions import dates, logs
from rostrum.functions.basic import non_empty
from rostrum.operators.common import first_per_key

LINE = ("block", "seq")
JOB = ("source", "run_no", "job")
RUN_COUNTERS = ("total_new", "total_refreshed", "analyzed_items", "synced_items", "source_synced_items", "tableau_mart_items")
ACTIVE_FLOOR = 0.05


def _line() -> Column:
    return F.struct(*LINE)


def split_runs(lines: DataFrame) -> DataFrame:
    """`run_no` per line, counting start markers per source.

    Lines before the first start and lines after a run's finish marker belong to no run
    and are dropped; a source without any start marker is one run (number 0).

    A scan in segments: each block is summed up as its number of starts and whether a run is finished at its
    end; these few rows are combined in order to what every block begins with (`_before`, `_closed`); inside a block
    lines are numbered and cut from there on. No step takes a run, or a source, as one group of lines, so that a
    log of one long run uses as many tasks as it has blocks.
    """
    start, finish = F.col("message") == logs.RUN_START, F.col("message") == logs.RUN_FINISH
    one = F.when(F.coalesce(start, F.lit(False)), 1).otherwise(0).cast("long")
    last_start, last_finish = F.max(F.when(start, F.col("seq"))), F.max(F.when(finish, F.col("seq")))
    sums = lines.groupBy("source", "block").agg(F.sum(one).alias("_starts"), last_start.alias("_s"), last_finish.alias("_f")).select(
        "source", "block", "_starts",
        # With a start: is the run it begins finished in here? Without: is there a finish at all?
        F.coalesce(F.when(F.col("_starts") > 0, F.col("_f") > F.col("_s")).otherwise(F.col("_f").isNotNull()), F.lit(False)).alias("_fin"))
    source = Window.partitionBy("source")
    upto = source.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grouped = sums.withColumn("_upto", F.sum("_starts").over(upto)).withColumn("_runs", F.sum("_starts").over(source))
    in_run = Window.partitionBy("source", "_upto").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = grouped.withColumn("_at_end", F.max("_fin").over(in_run))
    carried = ended.select(
        "source", "block", "_runs", (F.col("_upto") - F.col("_starts")).alias("_before"),
        F.coalesce(F.lag("_at_end").over(source.orderBy("block")), F.lit(False)).alias("_closed"))
    inside = Window.partitionBy("source", "block").orderBy("seq")
    here, earlier = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow), inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = lines.select(
        "*", F.sum(one).over(here).alias("_count"), last_start.over(here).alias("_s"), last_finish.over(earlier).alias("_f"))
    cut = F.coalesce(F.when(F.col("_s").isNotNull(), F.col("_f") > F.col("_s")).otherwise(F.col("_closed") | F.col("_f").isNotNull()), F.lit(False))
    run_no = F.col("_before") + F.col("_count")
    return numbered.join(carried, ["source", "block"]).where((F.col("_runs") == 0) | ((run_no > 0) & ~cut)).select(
        *lines.columns, run_no.alias("run_no"), (run_no == F.col("_runs")).alias("is_latest"))


def latest_run(lines: DataFrame) -> DataFrame:
    """The lines of the latest run of each source."""
    return split_runs(lines).where(F.col("is_latest")).drop("is_latest")


def issues(lines: DataFrame) -> DataFrame:
    """P17."""
    return lines.where(F.col("level").isin(*logs.ISSUE_LEVELS))


def search_lines(lines: DataFrame, level: str | None = None, keyword: str | None = None) -> DataFrame:
    """Lines of a level whose raw text contains a keyword, in any case."""
    out = lines if level is None else lines.where(F.col("level") == level)
    return out if not keyword else out.where(F.lower("raw").contains(keyword.strip().lower()))


def _mentions(tokens: tuple[str, ...]) -> Column:
    """Message or extra text contains one of the tokens."""
    hit = F.lit(False)
    for token in tokens:
        hit = hit | F.col("message").contains(token) | F.col("extra_text").contains(token)
    return hit


def token_events(runs: DataFrame, tokens: tuple[str, ...]) -> DataFrame:
    """First and last line of each run that mentions one of the tokens."""
    event = F.struct("ts_text", "message", "extra_text")
    return (
        runs.where(_mentions(tokens)).groupBy("source", "run_no")
        .agg(F.min_by(event, _line()).alias("first"), F.max_by(event, _line()).alias("last"))
        .select(
            "source", "run_no", F.col("first.ts_text").alias("first_ts"), F.col("first.message").alias("first_message"),
            F.col("last.ts_text").alias("last_ts"), F.col("last.message").alias("last_message"),
        )
    )


def _job_rows(runs: DataFrame) -> DataFrame:
    """W12 without inferred states: `reported` is the status as it was given, null without one."""
    event = F.struct("ts", "ts_text", "extra")
    status = F.coalesce(F.try_element_at("extra", F.lit("status")), F.lit(""))
    reported = _own_lines(runs).where(logs.stage_of_job(F.col("job")).isNotNull() & (F.col("job") != "finish"))
    grouped = reported.groupBy("source", "run_no", "job").agg(
        F.min_by(event, F.when(status == "running", _line())).alias("running"),
        F.min_by(event, _line()).alias("first"),
        F.max_by(event, F.when(status != "running", _line())).alias("done"),
        F.count(F.lit(1)).alias("job_events"),
    )
    start = F.coalesce("running", "first")
    final = F.coalesce(F.col("done"), start)
    extra = final["extra"]
    given = F.try_element_at(extra, F.lit("duration_sec")).try_cast("double")
    return grouped.select(
        "source", "run_no", "job",
        logs.stage_of_job(F.col("job")).alias("stage"), logs.label_of_job(F.col("job")).alias("label"),
        start["ts"].alias("start_ts"), final["ts"].alias("end_ts"),
        F.try_element_at(extra, F.lit("status")).alias("reported"),
        F.coalesce(given, dates.duration_seconds(start["ts"], final["ts"], negative_as_zero=True)).alias("duration"),
        "job_events",
        *[logs.counter(extra, name).alias(name) for name in logs.COUNTERS],
        F.coalesce(
            F.try_element_at(extra, F.lit("reason")), F.try_element_at(extra, F.lit("error_message"))
        ).alias("note"),
    )


def _own_lines(runs: DataFrame) -> DataFrame:
    """Lines that report on a job, with its name."""
    return runs.where(F.col("message") == logs.JOB_MESSAGE).withColumn("job", F.try_element_at("extra", F.lit("job_name")))


def jobs(runs: DataFrame) -> DataFrame:
    """One row per run and job: first running event (else the first), last event
    that is not running (else none), status, duration, counters (X37, X38).

    A job whose deciding line has no status gets one by what its time span holds (X31): failed with an error,
    else warning with a warning, else success. Only such jobs meet the lines again.
    """
    rows = _job_rows(runs)
    silent = rows.where(F.col("reported").isNull())
    found = events_in_jobs(runs, silent).groupBy(*JOB).agg(
        F.bool_or(F.col("level").isin(*logs.ERROR_LEVELS)).alias("_error"), F.bool_or(F.col("level") == "WARNING").alias("_warning"))
    # A job that has not ended counts as ended at its start, so that none is inferred to be running.
    inferred = logs.infer_status(F.lit(True), F.coalesce("_error", F.lit(False)), F.coalesce("_warning", F.lit(False)), F.lit(True))
    status = F.when(F.col("reported").isNull(), inferred).otherwise(logs.normalize_status(F.col("reported")))
    return rows.join(found, list(JOB), "left").select(
        *[status.alias("status") if c == "reported" else F.col(c) for c in rows.columns])


def events_in_jobs(runs: DataFrame, job_rows: DataFrame) -> DataFrame:
    """The lines of a run within the time span of each of its jobs; for a job without any, its own lines.

    A start without a readable time is open to the past and an end without one to the future; a line without one is in
    no span. The interval join goes by blocks: spans first meet the times of a run's blocks, which are far fewer
    than its lines, and then only the lines of the blocks they reach. A run has at most one row per known
    job (thirteen), so a line is multiplied by a fixed bound, and a run of any length is spread over its blocks.
    """
    spans = job_rows.select(*JOB, "start_ts", "end_ts")

    def meets(low: str, high: str):
        return (F.col("start_ts").isNull() | (F.col(high) >= F.col("start_ts"))) & (F.col("end_ts").isNull() | (F.col(low) <= F.col("end_ts")))

    timed = runs.where(F.col("ts").isNotNull())
    blocks = timed.groupBy("source", "run_no", "block").agg(F.min("ts").alias("_low"), F.max("ts").alias("_high"))
    placed = spans.join(blocks, ["source", "run_no"]).where(meets("_low", "_high")).drop("_low", "_high")
    inside = timed.join(placed, ["source", "run_no", "block"]).where(meets("ts", "ts"))
    empty = spans.join(inside.select(*JOB).distinct(), list(JOB), "left_anti")
    own = _own_lines(runs).join(empty, list(JOB))
    columns = [*runs.columns, "job", "start_ts", "end_ts"]
    return inside.select(columns).unionByName(own.select(columns))


def issues_in_jobs(runs: DataFrame, job_rows: DataFrame) -> DataFrame:
    """The issues among the lines of each job. Which lines a job has is settled before the choice of level."""
    return issues(events_in_jobs(runs, job_rows))


def job_counts(runs: DataFrame, job_rows: DataFrame) -> DataFrame:
    """Lines and issues per job."""
    inside = events_in_jobs(runs.select("source", "run_no", "block", "ts", "level", "message", "extra"), job_rows)
    return inside.groupBy(*JOB).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("level").isin(*logs.ISSUE_LEVELS)).alias("issues")
    )


def finish_rows(runs: DataFrame) -> DataFrame:
    """The closing row of each run, from the last line that tells its end; without one, or without a status on
    it, failed if the run logged an error, success if it has a finish line, else unknown."""
    event = F.struct("ts", "extra")
    tells = _mentions((logs.RUN_FINISH, logs.UP_TO_DATE))
    rows = runs.groupBy("source", "run_no").agg(
        F.max_by(event, F.when(tells, _line())).alias("e"),
        F.bool_or(F.col("level").isin(*logs.ERROR_LEVELS)).alias("_error"), F.bool_or(F.col("message") == logs.RUN_FINISH).alias("_finish"))
    extra = F.col("e.extra")
    given = non_empty(F.try_element_at(extra, F.lit("status")))
    inferred = F.when(F.col("_error"), "failed").when(F.col("_finish"), "success").otherwise("unknown")
    return rows.select(
        "source", "run_no", F.lit("finish").alias("job"), logs.stage_of_job(F.lit("finish")).alias("stage"),
        logs.label_of_job(F.lit("finish")).alias("label"), F.col("e.ts").alias("start_ts"), F.col("e.ts").alias("end_ts"),
        logs.normalize_status(F.coalesce(given, inferred)).alias("status"),
        F.coalesce(F.try_element_at(extra, F.lit("duration_sec")).try_cast("double"), F.lit(0.0)).alias("duration"),
        *[logs.counter(extra, name).alias(name) for name in logs.COUNTERS])


def stage_counts(job_rows: DataFrame) -> DataFrame:
    """Jobs per run and stage column."""
    return job_rows.groupBy("source", "run_no", "stage").agg(F.count(F.lit(1)).alias("jobs"))


def duration_share(job_rows: DataFrame) -> DataFrame:
    """Share of each timed job in the run's total; skipped and near-zero jobs are out."""
    timed = job_rows.where((F.col("status") != "skipped") & (F.col("duration") > ACTIVE_FLOOR))
    total = timed.groupBy("source", "run_no").agg(F.sum("duration").alias("total"))
    return timed.join(total, ["source", "run_no"]).select(
        "source", "run_no", "job", "duration", (F.col("duration") / F.col("total")).alias("share")
    )


def run_summary(runs: DataFrame) -> DataFrame:
    """Start, end, status, counters of each run; a run that did not finish is
    'failed' if it logged an error, 'unknown' otherwise."""
    event = F.struct("ts", "extra")
    finish = F.col("message") == logs.RUN_FINISH
    grouped = runs.groupBy("source", "run_no").agg(
        F.min_by(event, F.when(F.col("message") == logs.RUN_START, _line())).alias("start"),
        F.max_by(event, F.when(finish, _line())).alias("finish"),
        F.min_by("ts", _line()).alias("first_ts"),
        F.max_by("ts", _line()).alias("last_ts"),
        F.bool_or(F.col("level").isin(*logs.ERROR_LEVELS)).alias("has_error"),
        F.count(F.lit(1)).alias("events"),
    )
    extra = F.col("finish.extra")
    reported = F.try_element_at(extra, F.lit("status"))
    inferred = F.when(F.col("has_error"), "failed").when(F.col("finish").isNotNull(), "success").otherwise("unknown")
    given = F.try_element_at(extra, F.lit("duration_sec")).try_cast("double")
    return grouped.select(
        "source", "run_no",
        F.coalesce(
            F.try_element_at(extra, F.lit("run_id")), F.try_element_at(F.col("start.extra"), F.lit("run_id"))
        ).alias("run_id"),
        F.coalesce("start.ts", "first_ts").alias("started"),
        F.coalesce("finish.ts", "last_ts").alias("ended"),
        F.when(reported.isNotNull(), logs.normalize_status(reported)).otherwise(inferred).alias("status"),
        F.coalesce(given, dates.duration_seconds(F.col("first_ts"), F.col("last_ts"), negative_as_zero=True))
        .alias("duration"),
        "events",
        *[logs.counter(extra, c).alias(c) for c in RUN_COUNTERS],
        F.try_element_at(extra, F.lit("failed_steps")).alias("failed_steps"),
    )


def run_span(stage_runs: DataFrame, run_id: str | None = None, limit: int | None = None) -> DataFrame:
    """First start and last finish per run, newest first; `limit` makes it a report of the latest."""
    rows = stage_runs if run_id is None else stage_runs.where(F.col("run_id") == run_id)
    spans = rows.groupBy("run_id").agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"))
    ordered = spans.orderBy(F.col("started_at").desc(), "run_id")
    return ordered if limit is None else ordered.limit(limit)


def stage_order(stage_runs: DataFrame, limit: int | None = None) -> DataFrame:
    """Stages of all (or the latest) runs in the order they ran. The sort is over the whole
    table, by range partitions; no run is gathered in one task."""
    if limit is None:
        return stage_runs.orderBy("run_id", "started_at", "id")
    latest = run_span(stage_runs, limit=limit).select("run_id")
    return stage_runs.join(latest, "run_id", "left_semi").orderBy("run_id", "started_at", "id")


def record_stages(steps: DataFrame) -> DataFrame:
    """Stage rows ready to append, with their duration."""
    timed = steps.withColumn("duration_seconds", dates.duration_seconds(F.col("started_at"), F.col("finished_at")))
    return schemas.conform(timed, schemas.STAGE_RUNS)


def latest_status(events: DataFrame, key: str) -> DataFrame:
    """Latest state per key (a bank or a stage); of one instant the highest id."""
    state = F.struct("state", "event_at")
    return events.groupBy(key).agg(F.max_by(state, F.struct("event_at", "event_id")).alias("s")).select(
        key, F.col("s.state").alias("state"), F.col("s.event_at").alias("event_at")
    )


def worst_state(states: DataFrame) -> DataFrame:
    """The most severe state; 'idle' if there is none. Equal ranks go by name."""
    return states.agg(
        F.coalesce(F.max_by("state", F.struct(logs.severity(F.col("state")), F.col("state"))), F.lit("idle"))
        .alias("state")
    )


def run_totals(bank_results: DataFrame) -> DataFrame:
    """Totals and status per run from rows (run_id, step, status, new, refreshed,
    analyzed, synced), `step` being bank, analysis or sync.

    Success if no bank failed; otherwise partial if anything new came in, else failed. A
    failed analysis or sync turns success into partial. The order of banks plays no part.
    """
    failed = F.col("status") == "failed"
    totals = bank_results.groupBy("run_id").agg(
        F.sum(F.coalesce("new", F.lit(0))).alias("total_new"),
        F.sum(F.coalesce("refreshed", F.lit(0))).alias("total_refreshed"),
        F.sum(F.coalesce("analyzed", F.lit(0))).alias("analyzed_items"),
        F.sum(F.coalesce("synced", F.lit(0))).alias("synced_items"),
        F.count_if(failed & (F.col("step") == "bank")).alias("_bank_failed"),
        F.count_if(failed & (F.col("step") != "bank")).alias("_later_failed"),
    )
    status = (
        F.when((F.col("_bank_failed") > 0) & (F.col("total_new") > 0), "partial")
        .when(F.col("_bank_failed") > 0, "failed")
        .when(F.col("_later_failed") > 0, "partial")
        .otherwise("success")
    )
    return totals.withColumn("status", status).drop("_bank_failed", "_later_failed")


def merge_latest(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Stored latest states combined with those of a new batch."""
    both = old.unionByName(new).withColumn("_order", F.struct("event_at", "state"))
    return first_per_key(both, [key], -dates.epoch_micros(F.col("event_at")), F.col("state")).drop("_order")
