"""Score queue: P8, P15, P19, P20, D6-D8, J3, J7, A3, A4, A10, R9, V1."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum import schemas
from rostrum.functions import scoring, text
from rostrum.functions.basic import non_empty
from rostrum.operators.common import left_join_spread, split_rows
from rostrum.operators.marts import ANALYZED

MAX_ATTEMPTS = 3
OPEN = "pending"


def with_analysis(speeches: DataFrame, analysis: DataFrame) -> DataFrame:
    """Speeches with their analysis row, if any. One row per speech on both sides."""
    a = analysis.withColumnRenamed("speech_id", "id").withColumnRenamed("synced_at", "analysis_synced_at")
    return speeches.join(a, "id", "left")


def with_speaker(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The speaker's name, null where unknown. Whether the member table is broadcast
    is decided by its size, by the optimizer."""
    names = members.select(F.col("id").alias("speaker_id"), F.col("name").alias("speaker"))
    return left_join_spread(rows, names, "speaker_id", "id")


def _is_open() -> Column:
    return F.coalesce("analysis_status", F.lit(OPEN)) == OPEN


def pending_queue(speeches: DataFrame, analysis: DataFrame, members: DataFrame, limit: int | None = None) -> DataFrame:
    """Speeches with enough text that wait for a score and have tries left.

    A limit picks the newest rows, with the id as tie-break, so the same ones every time.
    Without a limit the whole queue is one unordered batch.
    """
    due = with_analysis(
        _long_enough(speeches, "speaker_id"),
        analysis.select("speech_id", "analysis_status", "analysis_attempts", "synced_at"),
    ).where(_is_open() & (F.coalesce("analysis_attempts", F.lit(0)) < MAX_ATTEMPTS))
    named = with_speaker(due, members).select("id", "date", F.coalesce("speaker", F.lit("Unknown")).alias("speaker"))
    queue = named if limit is None else named.orderBy(F.col("date").desc(), "id").limit(limit)
    out = _with_text(queue.select("id", "speaker"), speeches).select(
        "id", "bank_code", "title", "full_text", "date", "speaker"
    )
    return out if limit is None else out.orderBy(F.col("date").desc(), "id")


def _long_enough(speeches: DataFrame, *columns: str) -> DataFrame:
    """Speeches with enough text for a score, without the text."""
    return speeches.where(F.length("full_text") > scoring.SHORT_TEXT).select("id", "date", *columns)


def _with_text(chosen: DataFrame, speeches: DataFrame) -> DataFrame:
    """The texts of chosen rows, fetched last: the joins that choose never carry a text,
    and a small choice is broadcast to the scan."""
    return chosen.join(speeches.select("id", "bank_code", "title", "full_text", "date"), "id")


def untried_then_failed(
    speeches: DataFrame, analysis: DataFrame, since_year: int | None = None, limit: int | None = None
) -> DataFrame:
    """Never tried rows (tier 0), then tried ones without keywords and with one to
    five attempts (tier 1), newest first. One ordered batch instead of one row at a time."""
    rows = with_analysis(
        _long_enough(speeches), analysis.select("speech_id", "keywords", "analysis_attempts", "synced_at")
    )
    attempts = F.coalesce("analysis_attempts", F.lit(0))
    failed = (F.coalesce("keywords", F.lit("[]")) == "[]") & attempts.between(1, 5)
    rows = rows.withColumn("tier", F.when(attempts == 0, 0).when(failed, 1)).where(F.col("tier").isNotNull())
    if since_year is not None:
        rows = rows.where(F.col("date") >= F.lit(f"{since_year}-01-01").cast("date"))
    if limit is not None:
        rows = rows.orderBy("tier", F.col("date").desc(), "id").limit(limit)
    out = _with_text(rows.select("id", "tier"), speeches).select("id", "title", "date", "tier", "full_text")
    return out if limit is None else out.orderBy("tier", F.col("date").desc(), "id")


def unscored_of_speaker(
    speeches: DataFrame, analysis: DataFrame, members: DataFrame, name: str, min_chars: int = 1000
) -> DataFrame:
    """P20: longer texts of one named speaker that have no score."""
    who = members.where(F.col("name") == name).select(F.col("id").alias("speaker_id"))
    return with_analysis(
        speeches.where(F.length("full_text") > min_chars).join(who, "speaker_id", "left_semi"),
        analysis.select("speech_id", "stance_score", "synced_at"),
    ).where(F.col("stance_score").isNull()).select("id", "title", "date", "full_text")


def skippable(speeches: DataFrame, analysis: DataFrame) -> DataFrame:
    """Open rows whose text is missing or too short, with the reason."""
    short = F.col("full_text").isNull() | (F.length("full_text") <= scoring.SHORT_TEXT)
    return (
        with_analysis(speeches.where(short), analysis.select("speech_id", "analysis_status", "synced_at"))
        .where(_is_open())
        .select(F.col("id").alias("speech_id"), scoring.skip_reason(F.col("full_text")).alias("reason"))
    )


def mark_skipped(speeches: DataFrame, analysis: DataFrame) -> DataFrame:
    """P15 rows become 'skipped'; rows that had no analysis row get one."""
    skip = skippable(speeches, analysis).withColumnRenamed("reason", "_reason")
    hit = F.col("_reason").isNotNull()
    old = schemas.conform(analysis, schemas.ANALYSIS)
    values = {
        "analysis_attempts": F.when(hit, 1).otherwise(F.col("analysis_attempts")),
        "analysis_status": F.when(hit, "skipped").otherwise(F.col("analysis_status")),
        "stance_reason": F.when(hit, F.col("_reason")).otherwise(F.col("stance_reason")),
        "keywords": F.when(hit, "[]").otherwise(F.col("keywords")),
    }
    return old.join(skip, "speech_id", "full_outer").select(*[
        values.get(c, F.col(c)).alias(c) for c in old.columns
    ])


def has_text_now(analysis: DataFrame, speeches: DataFrame) -> DataFrame:
    """Skipped analysis rows whose speech has enough text now."""
    long_enough = speeches.where(F.length("full_text") > scoring.SHORT_TEXT).select(F.col("id").alias("speech_id"))
    return analysis.where(F.col("analysis_status") == "skipped").join(long_enough, "speech_id", "left_semi")


def revive_skipped(analysis: DataFrame, speeches: DataFrame) -> DataFrame:
    """Skipped rows with enough text go back to the queue as new. Runs before D7."""
    ready = speeches.where(F.length("full_text") > scoring.SHORT_TEXT).select(
        F.col("id").alias("speech_id"), F.lit(True).alias("_ready")
    )
    skipped, rest = split_rows(analysis, F.col("analysis_status") == "skipped")
    hit = F.col("_ready")
    cleared = ("stance_score", "stance_reason", "keywords", "main_risk", "analyzed_at", "synced_at")
    values = {c: F.when(~F.coalesce(hit, F.lit(False)), F.col(c)) for c in cleared}
    values["analysis_status"] = F.when(hit, OPEN).otherwise(F.col("analysis_status"))
    values["analysis_attempts"] = F.when(hit, 0).otherwise(F.col("analysis_attempts"))
    revived = skipped.join(ready, "speech_id", "left").select(*[
        values.get(c, F.col(c)).alias(c) for c in analysis.columns
    ])
    return revived.unionByName(rest)


Scorer = Callable[[pd.Series], pd.Series]


def score_batch(
    queue: DataFrame, scorer: Scorer, partitions: int | None = None, max_chars: int = text.MAX_CHARS
) -> DataFrame:
    """V1: (speech_id, response) from a user's scorer, which maps a batch of input texts to
    result JSON (null for a failed call).

    The only step that leaves the JVM. Partitions are the unit of parallel calls and of
    retry after the loss of an executor. A text is handed over up to `max_chars` characters, which a
    scorer's input bounds, and says so where it was cut.
    """
    work = queue.select(
        F.col("id").alias("speech_id"),
        text.scorer_input(F.col("full_text"), F.col("date"), F.col("speaker"), max_chars).alias("input"),
    )
    if partitions:
        work = work.repartition(partitions)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"speech_id": batch["speech_id"], "response": scorer(batch["input"])})

    return work.mapInPandas(run, "speech_id long, response string")


def apply_scores(
    speeches: DataFrame, analysis: DataFrame, responses: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame]:
    """(analysis, speeches) after a batch of scorer responses (speech_id, response).

    A usable response replaces the result; any other one only adds an attempt. A speech
    with a new result syncs again.
    """
    parsed = responses.select(
        "speech_id", F.lit(True).alias("_tried"), scoring.parse_result(F.col("response")).alias("_result")
    )
    old = schemas.conform(analysis, schemas.ANALYSIS)
    ok = F.col("_result").isNotNull()
    result = F.col("_result")
    attempts = F.coalesce("analysis_attempts", F.lit(0)) + F.when(F.col("_tried"), 1).otherwise(0)
    values = {
        "stance_score": F.when(ok, result["stance_score"]).otherwise(F.col("stance_score")),
        "stance_reason": F.when(ok, result["stance_reason"]).otherwise(F.col("stance_reason")),
        "keywords": F.when(ok, scoring.keywords_to_json(result["keywords"])).otherwise(F.col("keywords")),
        "main_risk": F.when(ok, result["main_risk"]).otherwise(F.col("main_risk")),
        "analysis_status": F.when(ok, scoring.score_status(result["stance_score"]))
        .when(F.col("_tried"), F.coalesce("analysis_status", F.lit(OPEN))).otherwise(F.col("analysis_status")),
        "analysis_attempts": attempts.cast("int"),
        "analyzed_at": F.when(ok, now).otherwise(F.col("analyzed_at")),
        "synced_at": F.when(~ok, F.col("synced_at")),
    }
    new_analysis = old.join(parsed, "speech_id", "full_outer").select(*[
        values.get(c, F.col(c)).alias(c) for c in old.columns
    ])
    done = parsed.where(ok).select(F.col("speech_id").alias("id"), F.lit(True).alias("_done"))
    new_speeches = speeches.join(done, "id", "left").select(*[
        F.when(F.col("_done").isNull(), F.col(c)).alias(c) if c == "synced_at" else F.col(c) for c in speeches.columns
    ])
    return new_analysis, new_speeches


def rescored(responses: DataFrame) -> DataFrame:
    """D6, the speeches' side, as a change (see `sinks.deltas`): the ids with a usable new result, whose sync time is cleared."""
    usable = responses.where(scoring.parse_result(F.col("response")).isNotNull())
    return usable.select(F.col("speech_id").alias("id")).distinct().withColumn("synced_at", F.lit(None).cast("timestamp_ntz"))


def keyword_counts(analysis: DataFrame) -> DataFrame:
    """Keyword mentions by category."""
    return (
        analysis.select(F.explode(scoring.keywords_from_json(F.col("keywords"))).alias("k"))
        .groupBy(non_empty(F.col("k.category")).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bank_stats(speeches: DataFrame, analysis: DataFrame) -> DataFrame:
    """A3, A4: speeches and analysed speeches per bank, with the grand total as the row
    without a bank."""
    done = analysis.where(F.col("analysis_status").isin(*ANALYZED)).select(
        F.col("speech_id").alias("id"), F.lit(True).alias("done")
    )
    return (
        speeches.select("id", "bank_code").join(done, "id", "left")
        .rollup("bank_code")
        .agg(F.count("id").alias("total"), F.count("done").alias("analyzed"), F.grouping("bank_code").alias("is_total"))
    )


def scored_members(speeches: DataFrame, analysis: DataFrame) -> DataFrame:
    """A10: distinct members with a score."""
    scored = analysis.where(F.col("stance_score").isNotNull()).select(F.col("speech_id").alias("id"))
    return (
        speeches.where(F.col("speaker_id").isNotNull()).select("id", "speaker_id")
        .join(scored, "id", "left_semi").select("speaker_id").distinct()
    )


def banks(speeches: DataFrame) -> DataFrame:
    """A10: distinct banks."""
    return speeches.where(F.col("bank_code").isNotNull()).select("bank_code").distinct()
