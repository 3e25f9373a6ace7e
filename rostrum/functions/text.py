"""Text clean-up functions: X17, X24, X32, X33, X35, X40, P16."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostrum.functions.basic import contains_any, let, strip

# Fixed values.
CHROME_MARKERS = ("Share this page", "Content Type(s)", "Related Information")
CHROME_LINES = ("Available as:", "PDF", "Audio", "Video")
CUT_LINES = ("Content Type(s)", "Subject(s)", "Related Information")
MOJIBAKE = ("", "ζц")
MOJIBAKE_MARKER = "창\u0080"
NO_TEXT_MESSAGE = "This speech appears to be a scanned document or contains no extractable text."
MAX_CHARS = 100_000
TRUNCATED = "... [TEXT TRUNCATED]"


def is_dirty(text: Column) -> Column:
    """The text still carries page chrome."""
    return contains_any(text, CHROME_MARKERS)


def collapse_repeats(lines: Column) -> Column:
    """Drop a line that equals the one kept before it."""
    return let(lines, lambda a: F.filter(a, lambda x, i: (i == 0) | (x != F.try_element_at(a, i))))


def clean_page_text(text: Column) -> Column:
    """Trimmed lines without blanks, chrome and repeats, cut at the first end marker.

    Chrome lines never count as 'the line before', so dropping them first gives the same
    result as one pass that skips them.
    """
    lines = F.transform(F.split(F.replace(text, F.lit("\u00a0"), F.lit(" ")), r"\R"), strip)
    kept = F.filter(
        lines, lambda x: (x != "") & ~x.startswith("Share this page") & ~x.isin(*CHROME_LINES)
    )

    def cut(a: Column) -> Column:
        ends = F.filter(F.transform(F.array(*[F.lit(m) for m in CUT_LINES]), lambda m: F.array_position(a, m)),
                        lambda p: p > 0)
        end = F.coalesce(F.array_min(ends), F.size(a).cast("long") + 1)
        return F.slice(a, F.lit(1), (end - 1).cast("int"))

    return strip(F.array_join(let(collapse_repeats(kept), cut), "\n"))


def truncate_text(text: Column, limit: int = MAX_CHARS) -> Column:
    """Scorer input limited to `limit` characters, with a marker where cut."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(TRUNCATED))).otherwise(
        F.coalesce(text, F.lit(""))
    )


def scorer_input(text: Column, date: Column, speaker: Column, limit: int = MAX_CHARS) -> Column:
    """The text handed to a scorer, headed by date and speaker."""
    return F.concat(
        F.lit("Date: "), F.coalesce(date.cast("string"), F.lit("")),
        F.lit("\nSpeaker: "), F.coalesce(speaker, F.lit("Unknown")),
        F.lit("\n\nSpeech Text:\n"), truncate_text(text, limit), F.lit("\n"),
    )


def dehyphenate(text: Column) -> Column:
    """Join words split at a line end; a text with almost nothing in it becomes a message."""
    joined = F.regexp_replace(strip(text), r"(?U)(\w+)-\n([a-z]+)", "$1$2")
    return F.when(F.length(F.coalesce(joined, F.lit(""))) < 50, F.lit(NO_TEXT_MESSAGE)).otherwise(joined)


def strip_mojibake(text: Column) -> Column:
    """Remove known encoding artefacts."""
    for artefact in MOJIBAKE:
        text = F.replace(text, F.lit(artefact), F.lit(""))
    return text


def trim_menu(text: Column, from_heading: Column) -> Column:
    """Where the site menu leads the text, take the text from the first heading on."""
    menu = F.substring(text, 1, 200).contains("About us")
    return F.when(menu & from_heading.isNotNull(), from_heading).otherwise(text)


def choose_text(dataset_text: Column, fetched_text: Column, minimum: int = 100) -> Column:
    """The dataset's text unless it is missing or short and a fetched one exists."""
    weak = dataset_text.isNull() | (F.length(dataset_text) < minimum)
    has_fetched = F.coalesce(F.length(fetched_text) > 0, F.lit(False))
    return F.when(weak & has_fetched, fetched_text).otherwise(dataset_text)
