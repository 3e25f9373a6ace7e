"""Run-log functions: S4, S21, X27, X29-X31, X37, X38."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostrum.functions.basic import item, let

RUN_START = "Starting sync run"
RUN_FINISH = "Finished sync run"
UP_TO_DATE = "Everything is up-to-date"
JOB_MESSAGE = "Pipeline job status"
ERROR_LEVELS = ("ERROR", "EXCEPTION")
ISSUE_LEVELS = ("WARNING", "ERROR", "EXCEPTION")

# Fixed values: (job key, stage column, label), in display order.
JOBS = (
    ("prepare_environment", "prepare", "Prepare environment"),
    ("collection", "collect", "Collection summary"),
    ("collect_frb", "collect", "FRB"),
    ("collect_ecb", "collect", "ECB"),
    ("collect_boe", "collect", "BOE"),
    ("collect_boj", "collect", "BOJ"),
    ("collect_rba", "collect", "RBA"),
    ("collect_boc", "collect", "BOC"),
    ("member_cleanup", "maintenance", "Member cleanup"),
    ("initial_analysis", "analyze", "Initial analysis"),
    ("exhaustive_analysis", "analyze", "Exhaustive analysis"),
    ("collection_sync", "sync", "Collection sync"),
    ("postgres_sync", "sync", "PostgreSQL sync"),
)

# Counters shown for a job, by kind.
COUNTERS = (
    "new_items", "refreshed_items", "total_new", "total_refreshed", "analyzed_items",
    "synced_items", "source_synced_items", "tableau_mart_items", "mart_events_rows", "mart_daily_rows", "mart_plot_rows",
)

SEVERITY = {"failed": 4, "partial": 3, "running": 2, "success": 1, "skipped": 0, "idle": 0}


def safe_value(value: Column) -> Column:
    """A value that cannot break the `k=v, k=v` form."""
    text = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"[\n\r]", " ")
    return F.trim(F.replace(F.replace(text, F.lit(", "), F.lit("; ")), F.lit("="), F.lit(":")))


def format_line(ts: Column, level: Column, logger: Column, message: Column, extra: Column) -> Column:
    """`ts | level | logger | message | k=v, k=v`; `extra` is an array of (key, value)
    structs, so that the order written is the order given."""
    pairs = F.transform(extra, lambda e: F.concat(e["key"], F.lit("="), safe_value(e["value"])))
    written = F.array_join(pairs, ", ")
    return F.concat_ws(" | ", ts, level, logger, message, let(written, lambda w: F.when(w != "", w)))


def extra_pairs(**values: Column) -> Column:
    """(key, value) structs in the order given; values are written as text."""
    return F.array(*[
        F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()
    ])


def parse_kv(text: Column) -> Column:
    """X29: 'k=v, k=v' -> map; parts without a key are dropped, a later key wins."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), ", "), lambda p: F.instr(p, "=") > 1)
    entries = F.transform(
        parts,
        lambda p: F.struct(
            F.trim(F.substring_index(p, "=", 1)).alias("key"),
            F.trim(F.substring(p, F.instr(p, "=") + 1, F.length(p))).alias("value"),
        ),
    )

    def last_wins(a: Column) -> Column:
        return F.filter(
            a,
            lambda e, i: ~F.exists(F.slice(a, i + 2, F.size(a)), lambda later: later["key"] == e["key"]),
        )

    return F.map_from_entries(let(entries, last_wins))


def parse_line(line: Column) -> Column:
    """One log line -> struct, null for a line with fewer than four parts.

    What follows a second separator inside the message is lost, as in the log view.
    """
    def fields(parts: Column) -> Column:
        extra = F.trim(F.coalesce(F.try_element_at(parts, F.lit(5)), F.lit("")))
        return F.when(
            F.size(parts) >= 4,
            F.struct(
                item(parts, 1).alias("ts_text"),
                F.trim(item(parts, 2)).alias("level"),
                F.trim(item(parts, 3)).alias("logger"),
                F.trim(item(parts, 4)).alias("message"),
                extra.alias("extra_text"),
            ),
        )

    return let(F.split(F.trim(line), r" \| "), fields)


def normalize_status(status: Column) -> Column:
    """X30."""
    value = F.lower(F.coalesce(status, F.lit("unknown")))
    return (
        F.when(value.isin("success", "failed", "running", "skipped", "warning"), value)
        .when(value == "partial", "warning")
        .when(value.isin("fail", "error"), "failed")
        .otherwise("unknown")
    )


def infer_status(has_any: Column, has_error: Column, has_warning: Column, has_end: Column) -> Column:
    """Status of a job that did not report one."""
    return (
        F.when(~has_any, "unknown").when(has_error, "failed").when(has_warning, "warning")
        .when(has_end, "success").otherwise("running")
    )


def severity(state: Column) -> Column:
    """Rank of a state; unknown states rank lowest."""
    rank = F.lit(0)
    for name, value in SEVERITY.items():
        rank = F.when(state == name, value).otherwise(rank)
    return rank


def _job_lookup(job: Column, position: int) -> Column:
    value = F.lit(None).cast("string")
    for spec in JOBS:
        value = F.when(job == spec[0], F.lit(spec[position])).otherwise(value)
    return value


def stage_of_job(job: Column) -> Column:
    """Stage column of a job key; null for a job that is not shown."""
    return F.when(job == "finish", "finish").otherwise(_job_lookup(job, 1))


def label_of_job(job: Column) -> Column:
    """Label of a job key."""
    return F.when(job == "finish", "Finish run").otherwise(_job_lookup(job, 2))


def counter(extra: Column, name: str) -> Column:
    """A counter of the extra map as a number."""
    return F.try_element_at(extra, F.lit(name)).try_cast("long")


def details(text: Column, schema: str = "MAP<STRING, STRING>") -> Column:
    """Details JSON -> map; text that is not JSON is kept under `raw`."""
    parsed = F.from_json(text, schema)
    return F.when(text.isNotNull(), F.coalesce(parsed, F.create_map(F.lit("raw"), text)))
