"""URL functions: X1-X5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostrum.functions.basic import strip


def normalize_url(url: Column) -> Column:
    """Trim, lower, one trailing '/' off, http -> https, cut at '?', in that order.

    The order is part of the result: `a/?q` keeps its slash and fragments stay.
    """
    u = F.lower(strip(F.coalesce(url, F.lit(""))))
    u = F.regexp_replace(u, r"/\z", "")
    u = F.regexp_replace(u, r"\Ahttp://", "https://")
    return F.substring_index(u, "?", 1)


def is_pdf(url: Column, content_type: Column | None = None) -> Column:
    """The path before '?' ends in .pdf, or the content type says so."""
    by_path = F.coalesce(F.substring_index(F.lower(url), "?", 1).endswith(".pdf"), F.lit(False))
    if content_type is None:
        return by_path
    return by_path | F.coalesce(F.lower(content_type).contains("application/pdf"), F.lit(False))


def absolute_url(href: Column, base: str, relative_prefix: str | None = None, keep_other: bool = False) -> Column:
    """X3: '/x' gets the base, http links stay.

    Other links get `relative_prefix`, stay as they are with `keep_other`, or become
    null (the row is then dropped by the caller).
    """
    if relative_prefix is not None:
        other = F.concat(F.lit(relative_prefix), href)
    else:
        other = href if keep_other else F.lit(None).cast("string")
    return (
        F.when(href.startswith("/"), F.concat(F.lit(base), href))
        .when(href.startswith("http"), href)
        .otherwise(other)
    )


def title_key(title: Column, style: str = "plain") -> Column:
    """Key of a title. `plain` trims, `lower` also lowers, `variant` also drops
    '(Summary)', '(Outline)' and '(Full Text)'."""
    if style == "plain":
        return strip(title)
    if style == "lower":
        return F.lower(strip(title))
    if style == "variant":
        return F.lower(strip(F.regexp_replace(title, r"(?i)\s*\((?:Summary|Outline|Full Text)\)", "")))
    raise ValueError(style)


def slug_url(scheme: Column, date: Column, title: Column) -> Column:
    """Synthetic URL of a row that has none."""
    slug = F.substring(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"), 1, 60)
    return F.concat(scheme, F.lit("://speeches/"), date.cast("string"), F.lit("/"), slug)
