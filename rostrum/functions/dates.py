"""Date and time functions: X6-X10, X18, X28, X36, X39.

All results are zone-free (`date` or `timestamp_ntz`); text that is not a date
becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostrum.functions.basic import extract, let, strip

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)  # fixed values
MONTHS = "|".join(MONTH_NAMES)
MONTH_STARTS = "".join(m[:3] for m in MONTH_NAMES)

# Accepted formats by source style, first success wins, and the shape of
# each. A failed parse costs an exception, so only text of the right shape is parsed.
SHAPES = {
    "yyyy-M-d": r"\A\d{4}-\d{1,2}-\d{1,2}\z",
    "d/M/yyyy": r"\A\d{1,2}/\d{1,2}/\d{4}\z",
    "d MMMM yyyy": r"\A\d{1,2} (?:[Mm][Aa][Yy]|[A-Za-z]{4,}) \d{4}\z",
    "d MMM yyyy": r"\A\d{1,2} [A-Za-z]{3} \d{4}\z",
    "yyyyMMdd": r"\A\d{8}\z",
    "MMMM d, yyyy": r"\A(?:[Mm][Aa][Yy]|[A-Za-z]{4,}) \d{1,2}, \d{4}\z",
    "MMM d, yyyy": r"\A[A-Za-z]{3} \d{1,2}, \d{4}\z",
}
DATE_FORMATS = {
    "dataset": ("yyyy-M-d", "d/M/yyyy", "d MMMM yyyy", "yyyyMMdd"),
    "card": ("MMMM d, yyyy", "MMM d, yyyy", "yyyy-M-d"),
    "table": ("MMM d, yyyy", "MMMM d, yyyy"),
}


def squeeze(text: Column) -> Column:
    """No-break spaces to spaces, runs of white space to one space, trimmed."""
    return strip(F.regexp_replace(F.replace(text, F.lit("\u00a0"), F.lit(" ")), r"\s+", " "))


def _parse(text: Column, fmt: str) -> Column:
    return F.when(text.rlike(SHAPES[fmt]), F.try_to_date(text, fmt))


def _first_format(text: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*[_parse(text, fmt) for fmt in formats])


def parse_date(text: Column, style: str) -> Column:
    """Parse a date in one of the formats of a source style.

    `card` falls back to the first 'Month D, YYYY' inside the text, `table` looks only
    for that shape and ignores the dot of 'Mar.'.
    """
    if style == "table":
        shape = r"([A-Za-z]+\.?\s+\d{1,2},\s+\d{4})"
        found = F.replace(extract(squeeze(text), shape), F.lit("."), F.lit(""))
        return let(found, lambda t: _first_format(t, DATE_FORMATS["table"]))

    def read(clean: Column) -> Column:
        direct = _first_format(clean, DATE_FORMATS[style])
        if style != "card":
            return direct
        inner = extract(clean, r"([A-Za-z]+\s+\d{1,2},\s+\d{4})")
        return F.coalesce(direct, _parse(inner, "MMMM d, yyyy"))

    return let(squeeze(text), read)


def parse_rfc822(text: Column) -> Column:
    """Date part of 'Thu, 16 Apr 2026 15:15:00 +0200'; the offset is ignored.

    The week day is cut off first because Spark does not parse it.
    """
    body = strip(text)
    body = strip(F.substring(body, F.lit(1), F.greatest(F.length(body) - 6, F.lit(0))))
    body = F.regexp_replace(body, r"\A[A-Za-z]{3},\s*", "")
    return F.try_to_date(squeeze(body), "d MMM yyyy HH:mm:ss")


def date_from_url(href: Column, style: str, default_year: Column | None = None) -> Column:
    """Date written in a link, as `YYYY-MM-DD` text checked to be a real date.

    `digits8` .../name20260416a.htm; `iso_or_ddmmyy` 2026-04-16 or -160413;
    `year_month_name` /2019/january/ -> first of month; `year_month` /2026/03/.
    """
    fallback = F.lit(None).cast("date") if default_year is None else F.try_to_date(
        F.concat(default_year.cast("string"), F.lit("-01-01")), "yyyy-M-d"
    )
    if style == "digits8":
        return F.coalesce(F.try_to_date(extract(href, r"(\d{8})"), "yyyyMMdd"), fallback)
    if style == "iso_or_ddmmyy":
        iso = F.try_to_date(extract(href, r"(\d{4}-\d{2}-\d{2})"), "yyyy-MM-dd")
        return F.coalesce(iso, _ddmmyy(extract(href, r"-(\d{6})")), fallback)
    if style == "ddmmyy":
        return _ddmmyy(extract(href, r"-(\d{6})[-.]"))
    if style == "year_month_name":
        year = extract(href, r"/(\d{4})/\w+/")
        month = extract(href, r"/\d{4}/(\w+)/")
        text = F.concat(F.lit("1 "), month, F.lit(" "), year)
        year_only = F.try_to_date(F.concat(extract(href, r"/(\d{4})/"), F.lit("-01-01")), "yyyy-MM-dd")
        return F.coalesce(
            _parse(text, "d MMMM yyyy"), _parse(text, "d MMM yyyy"), year_only, fallback
        )
    if style == "year_month":
        text = F.concat(extract(href, r"/(\d{4})/\d{2}/"), F.lit("-"), extract(href, r"/\d{4}/(\d{2})/"))
        return F.coalesce(F.try_to_date(F.concat(text, F.lit("-01")), "yyyy-MM-dd"), fallback)
    raise ValueError(style)


def _ddmmyy(digits: Column) -> Column:
    day, month, year = F.substring(digits, 1, 2), F.substring(digits, 3, 2), F.substring(digits, 5, 2)
    century = F.when(year < "50", F.lit("20")).otherwise(F.lit("19"))
    return F.try_to_date(F.concat(century, year, F.lit("-"), month, F.lit("-"), day), "yyyy-MM-dd")


def _written(text: Column, pattern: str, year: int, month: int, day: int) -> Column:
    """The first date of a shape, whose month is a word that begins like a month's name."""
    name = F.initcap(F.substring(extract(text, pattern, month), 1, 3))
    number = ((F.instr(F.lit(MONTH_STARTS), name) + 2) / 3).cast("int").cast("string")
    return F.try_to_date(F.concat_ws("-", extract(text, pattern, year), number, extract(text, pattern, day)), "yyyy-M-d")


def _date_of_bank(text: Column, bank: Column) -> Column:
    """The forms that two banks use: 'Jan.31, 2025', 'Jan. 31,2025' (BOJ); '24 Jan 2019', 'Jan 24, 2019' (BOE)."""
    start = "|".join(m[:3] for m in MONTH_NAMES)
    tight = _written(text, rf"\b((?:{start})[a-z]*)\.?\s*(\d{{1,2}}),\s*(\d{{4}})", 3, 1, 2)
    day_first = _written(text, rf"\b(\d{{1,2}})\s+((?:{start})[a-z]*)\s+(\d{{4}})", 3, 2, 1)
    month_first = _written(text, rf"\b((?:{start})[a-z]*)\s+(\d{{1,2}}),\s+(\d{{4}})", 3, 1, 2)
    return F.when(bank == "BOJ", tight).when(bank == "BOE", F.coalesce(day_first, month_first))


def date_from_text(text: Column, window: int = 2000, bank: Column | None = None) -> Column:
    """The date near the top of a text. With `bank` first in a form of that bank; then 'D Month YYYY', else
    'Month D, YYYY' (also 'Mon. D, YYYY'), the first of each. The window is the feature: dates further
    down are other dates."""
    head = F.substring(text, 1, window)
    day_first = extract(head, rf"\b(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})\b")
    month_first = F.replace(
        extract(head, r"\b([A-Z][a-z]+\.?\s+\d{1,2},\s+\d{4})\b"), F.lit("."), F.lit("")
    )
    found = (
        _parse(squeeze(day_first), "d MMMM yyyy"),
        _parse(squeeze(month_first), "MMMM d, yyyy"),
        _parse(squeeze(month_first), "MMM d, yyyy"),
    )
    return F.coalesce(*found) if bank is None else F.coalesce(_date_of_bank(head, bank), *found)


def is_placeholder_date(bank: Column, date_text: Column) -> Column:
    """Dates that stand for 'not known exactly'."""
    rough = bank.isin("BOE", "BOJ") & (date_text.endswith("-01-01") | date_text.contains("-50-"))
    first_of_month = (bank == "BOE") & date_text.rlike(r"\A202[123]-.*-01\z")
    missing = (bank == "RBA") & (F.coalesce(date_text, F.lit("")) == "")
    return F.coalesce(rough, F.lit(False)) | F.coalesce(first_of_month, F.lit(False)) | missing


def repair_date(bank: Column, date_text: Column, url: Column, full_text: Column) -> Column:
    """Best known date, as text, of a row with a placeholder date.

    A date found in the text is taken when it agrees with the placeholder: same year for
    1 January placeholders, same month for first-of-month ones, any for month 50.
    What remains with month 50 becomes 1 January; a missing date comes from the URL.
    """
    def pick(found: Column) -> Column:
        same_year = F.substring(found, 1, 4) == F.substring(date_text, 1, 4)
        same_month = F.substring(found, 1, 7) == F.substring(date_text, 1, 7)
        month50 = date_text.contains("-50-")
        year_start = date_text.endswith("-01-01")
        agrees = F.when(month50, found.isNotNull()).when(year_start, same_year).otherwise(same_month)
        return (
            F.when(~is_placeholder_date(bank, date_text), date_text)
            .when(bank == "RBA", F.coalesce(date_from_url(url, "ddmmyy").cast("string"), date_text))
            .when(F.coalesce(agrees, F.lit(False)), found)
            .when(month50, F.concat(F.substring(date_text, 1, 4), F.lit("-01-01")))
            .otherwise(date_text)
        )

    return let(date_from_text(full_text, bank=bank).cast("string"), pick)


def lag_days(stamp: Column, date: Column) -> Column:
    """Whole days from `date` to the day of `stamp`."""
    return F.datediff(stamp.cast("date"), date).cast("long")


def epoch_micros(ts: Column) -> Column:
    """Micro-seconds since 1970 of a zone-free timestamp."""
    ts = ts.cast("timestamp_ntz")
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * F.lit(86_400_000_000)
    seconds = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long") * F.lit(1_000_000)
    fraction = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return day + seconds + fraction


def duration_seconds(start: Column, end: Column, negative_as_zero: bool = False) -> Column:
    """Seconds between two stamps; null if either is not a time.

    With `negative_as_zero` the log-view rule applies: 0 for missing or reversed pairs.
    """
    def stamp(c: Column) -> Column:
        return epoch_micros(c.try_cast("timestamp_ntz"))

    seconds = (stamp(end) - stamp(start)) / F.lit(1_000_000.0)
    if not negative_as_zero:
        return seconds
    return F.coalesce(F.greatest(seconds, F.lit(0.0)), F.lit(0.0))


def log_time(text: Column) -> Column:
    """X36: 'YYYY-MM-DD HH:MM:SS,mmm' -> zone-free timestamp."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp_ntz")


def eastern_time(utc: Column) -> Column:
    """Wall-clock text in America/New_York of a zone-free UTC instant."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), utc.cast("timestamp_ntz"))
    return F.date_format(local, "yyyy-MM-dd HH:mm:ss,SSS")
