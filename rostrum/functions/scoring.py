"""Score functions: X20-X23, X25, X26."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostrum.schemas import KEYWORDS

SHORT_TEXT = 500
MISSING_REASON = "Skipped: Missing full text."
SHORT_REASON = "Skipped: Text too short for meaningful analysis (<= 500 chars)."


def clamp_score(score: Column) -> Column:
    """Into [-1, 1], one decimal; null stays null."""
    bounded = F.greatest(F.least(score, F.lit(1.0)), F.lit(-1.0))
    return F.when(score.isNotNull(), F.round(bounded, 1))


def score_status(score: Column) -> Column:
    """X22."""
    return F.when(score.isNotNull(), "scored").otherwise("no_signal")


def skip_reason(text: Column) -> Column:
    """Why a row without usable text is skipped."""
    return F.when(text.isNull(), F.lit(MISSING_REASON)).otherwise(F.lit(SHORT_REASON))


def age_weight(date: Column, as_of: Column) -> Column:
    """Weight of a score by age in days; future dates weigh 1."""
    age = F.datediff(as_of, date)
    return F.when(age <= 90, 1.0).when(age <= 180, 0.5).when(age <= 365, 0.2).when(age.isNotNull(), 0.05)


def freshness(days: Column, half_life_days: float) -> Column:
    """0.5 to the power days / half-life; null stays null."""
    return F.pow(F.lit(0.5), days / F.lit(float(half_life_days)))


def parse_result(response: Column) -> Column:
    """Scorer response -> struct, null if it is not a usable result.

    `stance_score` and `stance_reason` must be present; a null score is a valid answer, a
    missing one is not. A score that is not a number makes the whole response unusable.
    """
    fields = F.from_json(
        response,
        "stance_score STRING, stance_reason STRING, main_risk STRING, "
        "keywords ARRAY<STRUCT<category: STRING, detail: STRING>>",
    )
    keys = F.json_object_keys(response)
    complete = F.array_contains(keys, "stance_score") & F.array_contains(keys, "stance_reason")
    number = fields["stance_score"].try_cast("double")
    usable = complete & (fields["stance_score"].isNull() | number.isNotNull())
    return F.when(
        F.coalesce(usable, F.lit(False)),
        F.struct(
            clamp_score(number).alias("stance_score"),
            fields["stance_reason"].alias("stance_reason"),
            fields["keywords"].alias("keywords"),
            fields["main_risk"].alias("main_risk"),
        ),
    )


def keywords_from_json(text: Column) -> Column:
    """X26."""
    return F.from_json(text, KEYWORDS)


def keywords_to_json(keywords: Column) -> Column:
    """X26."""
    return F.to_json(keywords)
