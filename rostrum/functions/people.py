"""Speaker-name functions: X11-X16."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostrum.functions.basic import contains_any, extract, item, let, non_empty, strip, words

# Phrases that mark a "name" as something else.
NOISE_PHRASES = (
    "slides", "transcript", "appendix", "annex", "foreword", "lead comment",
    "comments on", "comments given by", "press conference", "presentation",
    "technical appendix", "accompanying slides", "available as", "accessible fx",
    "achieving a sustainable", "an evolving", "finding the right", "five years of",
    "from design to", "global action", "inclusive capitalism", "inflation persistence",
    "investment association", "looking through", "macroprudential policy",
    "measuring recession", "one bank research", "protecting economic",
    "prudential regulation", "pull, push, pipes", "returning inflation",
    "running out of room", "speaker requests", "speech annex", "stress tests",
    "tails of the unexpected", "the future of work", "the grand unifying",
    "update and outlook", "wwhy ssttaggffllaattiioonn", "aiming at", "article contributed",
    "at the turning point", "cashless payment", "digital innovation", "germany and japan",
    "how to overcome", "keynote speech", "list by year", "overcoming deflation",
    "path toward", "realizing the asian", "revisiting qqe", "the future of money",
    "toward overcoming", "two years under", "日本語", "assistant (financial system)",
    "the australian", "interest rate benchmarks", "renminbi internationalisation",
    "buffers and options", "inflation and monetary policy", "an accounting",
    "resilience and ongoing", "after the boom", "the long run", "fundamentals and flexibility",
    "international and domestic", "issues in economic", "managing two transitions",
    "building on strong", "economic possibilities", "issues in payments", "the economic scene",
    "challenges for economic", "economic update", "economic conditions", "the economic outlook",
    "anniversary event", "light is therefore colour", "for immediate release", "speech by",
    "remarks by", "lecture by", "address by", "keynote by",
)

# Honorifics removed once from the front of a name.
HONORIFICS = (
    "Sir", "Dame", "Professor", r"Dr\.", "Governor", "Deputy Governor",
    "Assistant Governor", "Executive Director",
)

# Fixed values: (bank, spelling found, name).
ALIASES = (
    ("BOE", "Andy Haldane", "Andrew Haldane"),
    ("BOE", "Andrew G Haldane", "Andrew Haldane"),
    ("BOE", "Charlie Bean", "Charles Bean"),
    ("BOE", "Andrew Sentence", "Andrew Sentance"),
    ("BOE", "Silvan Tenreyro", "Silvana Tenreyro"),
    ("BOE", "PPaauull FFiisshheerr", "Paul Fisher"),
    ("FRB", "Barr", "Michael S. Barr"),
    ("FRB", "Bowman", "Michelle W. Bowman"),
    ("FRB", "Brainard", "Lael Brainard"),
    ("FRB", "Clarida", "Richard H. Clarida"),
    ("FRB", "Cook", "Lisa D. Cook"),
    ("FRB", "Jefferson", "Philip N. Jefferson"),
    ("FRB", "Kugler", "Adriana D. Kugler"),
    ("FRB", "Miran", "Stephen I. Miran"),
    ("FRB", "Powell", "Jerome H. Powell"),
    ("FRB", "Quarles", "Randal K. Quarles"),
    ("FRB", "Waller", "Christopher J. Waller"),
    ("FRB", "Yellen", "Janet L. Yellen"),
    ("FRB", "Bernanke", "Ben S. Bernanke"),
    ("FRB", "Tarullo", "Daniel K. Tarullo"),
)

# Line texts and words that are roles, not names.
ROLE_LINES = (
    "governor", "deputy governor", "assistant governor", "senior officer",
    "download", "audio", "transcript", "speech",
)
ROLE_WORDS = ("governor", "speech", "transcript", "bank")
JOB_TITLES = ("Governor", "Deputy Governor", "Assistant Governor", "Senior Officer")


def header_field(text: Column, name: str) -> Column:
    """X11: value of the last `__NAME__:` line of a text, null if there is none."""
    found = F.regexp_extract_all(text, F.lit(rf"(?m)^__{name}__:(.*)$"), F.lit(1))
    return let(found, lambda hits: F.when(F.size(hits) > 0, strip(item(hits, -1))))


def strip_headers(text: Column) -> Column:
    """X11: the text without its `__DATE__:` and `__SPEAKER__:` lines."""
    return strip(F.regexp_replace(text, r"(?m)^__(?:DATE|SPEAKER)__:.*(?:\n|\z)", ""))


def _short_name(text: Column) -> Column:
    """`text` if it has two to four words, else null."""
    return F.when(F.size(words(text)).between(2, 4), text)


def speaker_from_title(title: Column, bank: Column) -> Column:
    """The speaker named in a title, by the bank's way of writing it."""
    after_speech = item(F.split(title, "Speech by"), -1)
    after_interview = item(F.split(title, "Interview with"), -1)
    ecb = non_empty(
        F.when(title.contains("Speech by"), strip(F.substring_index(after_speech, ",", 1)))
        .when(title.contains("Interview with"), strip(F.substring_index(after_interview, ",", 1)))
    )

    bare = strip(F.regexp_replace(title, r"(?i)\(pdf\s*.*\)", ""))
    before_colon = strip(F.substring_index(bare, ":", 1))
    boe = F.coalesce(
        strip(extract(bare, r"(?i).+[−–-]\s*(?:speech|remarks|slides|panel remarks|address)\s+by\s+([^−–-]+)\z")),
        F.when(
            bare.contains(":") & ~contains_any(F.lower(before_colon), ("at", "the", "meeting", "update")),
            _short_name(before_colon),
        ),
        strip(extract(bare, r"(?i)Slides\s+from\s+([^’']+)[’']s")),
    )

    boj = strip(extract(
        title, r"(?i)\((?:Speech|Remarks|Address)\s+by\s+(?:Governor\s+|Deputy Governor\s+)?([^)]+)\)"
    ))
    boc = F.coalesce(*[
        F.when(title.contains(sep), _short_name(strip(F.substring_index(title, sep, 1))))
        for sep in (":", "—", " - ")
    ])
    frb = extract(title, r"(?U)(?:Governor|Chair|Vice Chair)\s+(\w+(?:\s+\w+)?)")
    return (
        F.when(bank == "ECB", ecb).when(bank == "BOE", boe).when(bank == "BOJ", boj)
        .when(bank == "BOC", boc).when(bank == "FRB", frb)
    )


def first_lines(text: Column, limit: int) -> Column:
    """The first non-blank lines of a text, trimmed."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    return F.slice(lines, 1, limit)


def speaker_from_lines(text: Column, layout: str = "any", limit: int = 10) -> Column:
    """The first of the opening lines that looks like a person.

    `byline`: line 2 or 3, or line 3 or 4 under a transcript heading.
    `any`: the first of the opening lines with two or three capitalised words.
    """
    if layout == "byline":
        def pick(lines: Column) -> Column:
            transcript = F.coalesce(F.try_element_at(lines, F.lit(1)).contains("Transcript"), F.lit(False))
            spoken = transcript & (F.size(lines) >= 3)

            def named(index: int, check_role: bool) -> Column:
                line = item(lines, index)
                ok = F.size(words(line)).between(2, 4) & line.rlike(r"\A[A-Za-z\s.]+\z")
                if check_role:
                    ok = ok & ~F.lower(line).isin(*ROLE_LINES)
                return F.when(ok, line)

            name = F.when(spoken, F.coalesce(named(3, False), named(4, False))).when(
                ~transcript & (F.size(lines) >= 2), F.coalesce(named(2, True), named(3, True))
            )
            tidy = F.array_join(words(name), " ")
            return F.when(name.isNotNull() & ~F.lower(tidy).isin(*ROLE_LINES), drop_job_title(tidy))

        return let(first_lines(text, limit), pick)

    def is_name(line: Column) -> Column:
        return (
            F.size(words(line)).between(2, 3)
            & line.rlike(r"\A[A-Z][A-Za-z\s.]+\z")
            & ~contains_any(F.lower(line), ROLE_WORDS)
        )

    return F.try_element_at(F.filter(first_lines(text, limit), is_name), F.lit(1))


def drop_job_title(name: Column) -> Column:
    """Job titles before or after a name."""
    for job in JOB_TITLES:
        name = strip(F.regexp_replace(name, rf"\A{job} | {job}\z", ""))
    return name


def capitalize_words(name: Column) -> Column:
    """First letter of each word upper, the rest lower."""
    return F.array_join(
        F.transform(words(name), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))),
        " ",
    )


def _is_upper(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


def given_name_first(name: Column) -> Column:
    """'SURNAME Given' -> 'Given Surname'; anything else stays."""
    def swap(parts: Column) -> Column:
        surname = item(parts, 1)
        given = F.array_join(
            F.transform(F.slice(parts, 2, 1 << 20), lambda p: F.when(_is_upper(p), F.initcap(p)).otherwise(p)), " "
        )
        return F.when(
            (F.size(parts) >= 2) & _is_upper(surname), F.concat(given, F.lit(" "), F.initcap(surname))
        ).otherwise(strip(name))

    return let(words(name), swap)


def listed_speaker(cell: Column) -> Column:
    """Speaker cell of a table page: the part before the first comma, given name first."""
    return non_empty(given_name_first(strip(F.substring_index(cell, ",", 1))))


def normalize_person(name: Column, bank: Column) -> Column:
    """One spelling per person: honorific off, aliases, bank habits, capitals."""
    aliases = F.create_map(*[F.lit(x) for bank_code, found, proper in ALIASES for x in (f"{bank_code}:{found}", proper)])
    honorific = r"(?i)\A(?:" + "|".join(HONORIFICS) + r")\s+"

    def two_words(parts: Column) -> Column:
        first, second = item(parts, 1), item(parts, 2)
        swap = (F.size(parts) == 2) & _is_upper(first) & ~_is_upper(second)
        return F.when(swap, F.concat_ws(" ", second, first)).otherwise(F.array_join(parts, " "))

    def without_notes(known: Column) -> Column:
        bare = F.regexp_replace(known, r"(?U)\s*\(\w+\s+\d{4}\)", "")
        bare = F.regexp_replace(bare, r"(?i)\s+slides\z", "")
        return strip(F.regexp_replace(bare, r"\(.*\z", ""))

    def known_as(bare: Column) -> Column:
        aliased = F.coalesce(F.try_element_at(aliases, F.concat(bank, F.lit(":"), bare)), bare)
        return (
            F.when(bank == "BOJ", let(words(bare), two_words)).when(bank == "BOE", without_notes(aliased)).otherwise(aliased)
        )

    return capitalize_words(let(F.regexp_replace(strip(name), honorific, ""), known_as))


def is_noise_name(name: Column) -> Column:
    """A 'name' that is a phrase of a title, or too short to be one."""
    phrases = "|".join(re.escape(p) for p in NOISE_PHRASES)
    return F.coalesce(F.lower(name).rlike(phrases), F.lit(False)) | (F.length(name) < 3)


def role_from_title(title: Column) -> Column:
    """Role named in a title, the first of the list that occurs."""
    role = F.lit(None).cast("string")
    for name in ("Board Member", "President", "Chair", "Governor"):
        role = F.when(title.contains(name), F.lit(name)).otherwise(role)
    return role
