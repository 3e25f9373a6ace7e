"""Small building blocks shared by the function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c\u00a0"


def strip(text: Column) -> Column:
    """Remove white space, including no-break spaces, at both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it several times in `body`.

    A higher-order function would otherwise re-evaluate an outer expression for every
    array element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def non_empty(text: Column) -> Column:
    """'' -> null."""
    return F.when(text != "", text)


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of `pattern`, null (not '') where there is none."""
    return non_empty(F.regexp_extract(text, pattern, group))


def contains_any(text: Column, needles: list[str] | tuple[str, ...]) -> Column:
    """True if `text` contains one of the fixed strings; null text is false."""
    found = F.lit(False)
    for needle in needles:
        found = found | text.contains(needle)
    return F.coalesce(found, F.lit(False))


def words(text: Column) -> Column:
    """White-space separated words, none for blank text."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def item(array: Column, index: int) -> Column:
    """Element by 1-based position, from the end if negative; null where there is none."""
    return F.try_element_at(array, F.lit(index))
