"""Page tables -> candidate rows and main text: S6-S8, P9, P10, V2.

A page arrives as a row `(page_id, bank_code, url, html)`. Everything is regular
expressions and array functions on that row, so extraction is a narrow, shuffle-free
stage that scales with the number of input splits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions import dates, people, text, urls
from rostrum.functions.basic import extract, item, let, non_empty, strip

ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"),
    ("&copy;", "©"), ("&middot;", "·"), ("&ndash;", "–"), ("&mdash;", "—"), ("&amp;", "&"),
)  # fixed values; '&amp;' last

# Content-type labels that are collected, and the one that never is.
CONTENT_TYPES = ("Comments", "Lectures", "Opening statements", "Presentations", "Remarks", "Speech summaries")
EXCLUDED_TYPE = "Webcasts"

ANCHOR = r"(?is)<a\b[^>]*>.*?</a\s*>"
NODE_BREAK = "\u0001"


@dataclass(frozen=True)
class SiteRule:
    """V2: how one bank's list pages and text pages are read. Fixed values per bank."""

    bank_code: str
    base_url: str
    href_any: tuple[str, ...] = ()
    href_none: tuple[str, ...] = ()
    href_not: tuple[str, ...] = ()
    href_regex: str | None = None
    title_stop: tuple[str, ...] = ()
    min_title: int = 1
    card_start: str | None = None
    link_within: str | None = None
    title_within: str | None = None
    main_only: bool = False
    relative_prefix: str | None = None
    keep_other_links: bool = False
    date_style: str = "card"
    url_date_style: str | None = None
    default_year: bool = False
    typed: bool = False
    containers: tuple[str, ...] = ("main", "article", "body")
    drop_tags: tuple[str, ...] = ("nav", "header", "footer", "script", "style")


RULES = (
    SiteRule(
        "FRB", "https://www.federalreserve.gov", href_any=("/newsevents/speech/",), min_title=10,
        title_stop=("speech", "speeches", "archive", "more"),
        relative_prefix="https://www.federalreserve.gov/newsevents/speech/",
        url_date_style="digits8", default_year=True,
        containers=("div.col-xs-12 col-sm-8 col-md-8", "div#article", "div.article", "main", "article"),
    ),
    SiteRule(
        "ECB", "https://www.ecb.europa.eu", href_any=("/press/key/", "/press/inter/"),
        keep_other_links=True, containers=("main", "article"),
    ),
    SiteRule(
        "BOE", "https://www.bankofengland.co.uk", href_any=("/speech/", "/speeches/"), min_title=10,
        href_not=("/sitemap/speeches", "/news/speeches"),
        relative_prefix="https://www.bankofengland.co.uk/", title_within=r"(?is)<h3\b[^>]*class=[\"'][^\"']*\blist\b[^>]*>(.*?)</h3>",
        url_date_style="year_month_name", default_year=True,
        containers=("div.page-content", "article", "div.content-block", "main", "body"),
        drop_tags=("nav", "header", "footer", "script", "style", "aside", "button"),
    ),
    SiteRule(
        "BOJ", "https://www.boj.or.jp", href_any=("koen",), href_none=("r_menu", "koen_all"),
        href_regex=r"(?<!index\.htm)\z", card_start=r"(?i)(?=<tr\b)", keep_other_links=True,
        date_style="table", default_year=True,
        containers=("div#main", "div.section", "main"),
        drop_tags=("nav", "header", "footer", "script", "style", "aside"),
    ),
    SiteRule(
        "RBA", "https://www.rba.gov.au", href_any=("/speeches/",), href_none=("index.html", "/speeches/list.html"),
        href_not=("/speeches/",), href_regex=r"\.html?\z",
        title_stop=("audio", "transcript", "q&a transcript", "q&a", "video", "presentation"),
        card_start=r"(?i)(?=<(?:article|li)\b)", keep_other_links=True, url_date_style="iso_or_ddmmyy",
        containers=("div#content", "article", "main"),
        drop_tags=("nav", "header", "footer", "script", "style", "aside"),
    ),
    SiteRule(
        "BOC", "https://www.bankofcanada.ca", href_regex=r"/\d{4}/\d{2}/", href_none=("/multimedia/",), min_title=10,
        card_start=r"(?i)(?=<(?:div|article)\b[^>]*class=[\"'](?:[^\"']*\s)?(?:media|mtt-result)[\s\"'])",
        link_within=r"(?is)<h[35]\b[^>]*>(.*?)</h[35]>", main_only=True, url_date_style="year_month", typed=True,
        containers=("main", "article", "div#main-content"),
        drop_tags=("nav", "header", "footer", "script", "style", "aside", "form"),
    ),
)

# Pages of no particular bank: every link with a usable title.
GENERIC = SiteRule("*", "https://x", href_any=("/",), min_title=5, keep_other_links=True)


def decode_entities(value: Column) -> Column:
    """The common character entities of a page."""
    for name, char in ENTITIES:
        value = F.replace(value, F.lit(name), F.lit(char))
    return value


def drop_elements(html: Column, tags: tuple[str, ...]) -> Column:
    """Remove comments and whole elements by tag."""
    html = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    for tag in tags:
        html = F.regexp_replace(html, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    return html


def nodes(html: Column, separator: str) -> Column:
    """Text of a fragment: each text node trimmed, blank ones dropped, joined."""
    parts = F.split(F.regexp_replace(html, r"(?s)<[^>]*>", NODE_BREAK), NODE_BREAK)
    return F.array_join(F.filter(F.transform(parts, lambda p: strip(decode_entities(p))), lambda p: p != ""), separator)


def inner_text(html: Column) -> Column:
    """Text of a small fragment on one line."""
    return strip(F.regexp_replace(nodes(html, " "), r"\s+", " "))


def balanced(html: Column, tag: str, open_pattern: str) -> Column:
    """Inside of the first element matching `open_pattern`, with nested elements of the
    same tag counted; up to the end of the page if it is never closed."""
    body = F.regexp_extract(html, rf"(?is){open_pattern}(.*)\z", 1)
    has_open = F.regexp_extract(html, rf"(?is){open_pattern}", 0) != ""
    pieces = F.split(body, rf"(?i)(?=<{tag}\b)|(?=</{tag}\s*>)")

    def step(state: Column, piece: Column) -> Column:
        opens = F.lower(F.substring(piece, 1, len(tag) + 1)) == f"<{tag}"
        closes = F.lower(F.substring(piece, 1, len(tag) + 2)) == f"</{tag}"
        depth = state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        done = state["done"] | (depth <= 0)
        length = state["length"] + F.when(done, 0).otherwise(F.length(piece))
        return F.struct(depth.alias("depth"), length.alias("length"), done.alias("done"))

    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("length"), F.lit(False).alias("done"))
    length = F.aggregate(pieces, start, step, lambda s: s["length"])
    return F.when(has_open, F.substring(body, F.lit(1), length))


def container(html: Column, name: str) -> Column:
    """Inside of the first element named `tag`, `tag#id` or `tag.class`."""
    if "#" in name:
        tag, ident = name.split("#", 1)
        return balanced(html, tag, rf"<{tag}\b[^>]*\bid=[\"']{ident}[\"'][^>]*>")
    if "." in name:
        tag, cls = name.split(".", 1)
        return balanced(html, tag, rf"<{tag}\b[^>]*\bclass=[\"'](?:[^\"']*\s)?{cls}(?:\s[^\"']*)?[\"'][^>]*>")
    closed = extract(html, rf"(?is)<{name}\b[^>]*>(.*)</{name}\s*>")
    return F.coalesce(closed, extract(html, rf"(?is)<{name}\b[^>]*>(.*)\z"))


def main_html(html: Column, rule: SiteRule) -> Column:
    """The preferred container of a page, without navigation and scripts."""
    return drop_elements(F.coalesce(*[container(html, c) for c in rule.containers]), rule.drop_tags)


def page_text(html: Column, rule: SiteRule) -> Column:
    """Main text of a page, null if it has none of the containers."""
    return nodes(main_html(html, rule), "\n")


def menu_free_text(html: Column, rule: SiteRule) -> Column:
    """S7 + X17 + X35: cleaned main text, restarted at the first heading under a menu."""
    main = main_html(html, rule)
    heading = extract(main, r"(?is)(<h[123]\b.*)\z")
    return text.trim_menu(text.clean_page_text(nodes(main, "\n")), nodes(heading, "\n"))


def longest_section(html: Column, section_pattern: str = r"(?is)<section\b[^>]*>(.*?)</section\s*>") -> Column:
    """Text of the longest section (the first of equals); null if it is short and is
    only the search form."""
    sections = F.transform(F.regexp_extract_all(html, F.lit(section_pattern), F.lit(1)), lambda s: nodes(s, "\n"))
    longest = F.aggregate(
        sections,
        F.lit(None).cast("string"),
        lambda best, s: F.when(best.isNull() | (F.length(s) > F.length(best)), s).otherwise(best),
    )
    return F.when(~((F.length(longest) <= 100) & longest.contains("Search Options")), longest)


def is_candidate(href: Column, title: Column, rule: SiteRule) -> Column:
    """Link and title rules of a bank."""
    ok = (F.length(title) >= rule.min_title) & (href != "")
    if rule.href_any:
        wanted = F.lit(False)
        for part in rule.href_any:
            wanted = wanted | href.contains(part)
        ok = ok & wanted
    for part in rule.href_none:
        ok = ok & ~href.contains(part)
    if rule.href_not:
        ok = ok & ~href.isin(*rule.href_not)
    if rule.href_regex:
        ok = ok & href.rlike(rule.href_regex)
    if rule.title_stop:
        ok = ok & ~F.lower(title).isin(*rule.title_stop)
    return ok


def is_collectable(labels: Column) -> Column:
    """P10: some allowed content type and no webcast; no label at all is not collectable."""
    allowed = F.array(*[F.lit(t) for t in CONTENT_TYPES])
    return F.coalesce(F.arrays_overlap(labels, allowed), F.lit(False)) & ~F.array_contains(labels, EXCLUDED_TYPE)


def primary_type(labels: Column) -> Column:
    """The first allowed content type, else 'speech'."""
    return F.coalesce(
        F.try_element_at(F.filter(labels, lambda x: x.isin(*CONTENT_TYPES)), F.lit(1)), F.lit("speech")
    )


def _href(anchor: Column) -> Column:
    return decode_entities(F.regexp_extract(anchor, r"(?is)\bhref\s*=\s*[\"']([^\"']*)[\"']", 1))


def _cards(html: Column, rule: SiteRule) -> Column:
    """The parts of a list page that hold one candidate each."""
    scope = F.coalesce(container(html, "main"), html) if rule.main_only else html
    if rule.card_start is None:
        return F.regexp_extract_all(scope, F.lit(ANCHOR), F.lit(0))
    pieces = F.split(scope, rule.card_start)
    return F.filter(pieces, lambda p: p.rlike(r"\A" + rule.card_start))


def _of(rule: SiteRule) -> Column:
    """Whether a row belongs to a rule; the rule '*' takes all."""
    return F.lit(True) if rule.bank_code == "*" else F.col("bank_code") == rule.bank_code


def _card_parts(card: Column, rule: SiteRule) -> dict[str, Column]:
    """Where a card of a bank has its link, title, date and speaker, and whether it can be a candidate at all."""
    if rule.bank_code == "BOJ":
        cells = F.regexp_extract_all(card, F.lit(r"(?is)<td\b[^>]*>(.*?)</td\s*>"), F.lit(1))
        usable, scope, date_text = F.size(cells) >= 3, item(cells, 3), inner_text(item(cells, 1))
        named = people.listed_speaker(inner_text(item(cells, 2)))
    else:
        usable, scope = F.lit(True), extract(card, rule.link_within) if rule.link_within else card
        date_text = inner_text(extract(
            card, r"(?is)<span\b[^>]*class=[\"'][^\"']*(?:media-date|pressdate)[^\"']*[\"'][^>]*>(.*?)</span>"
        ))
        named = non_empty(inner_text(extract(card, _speaker_pattern(rule.bank_code))))
    anchor = F.regexp_extract(scope, ANCHOR, 0)
    label = F.coalesce(extract(anchor, rule.title_within), anchor) if rule.title_within else anchor
    return {"usable": usable, "href": _href(anchor), "title": inner_text(label), "date_text": date_text, "named": named}


def _date_of(rule: SiteRule, year: int | None) -> Column:
    default = F.lit(year) if (rule.default_year and year) else None
    found = [F.try_to_date("time_tag", "yyyy-MM-dd"), dates.parse_date(F.col("date_text"), rule.date_style)]
    if rule.url_date_style:
        found.append(dates.date_from_url(F.col("href"), rule.url_date_style, default))
    elif default is not None:
        found.append(F.try_to_date(F.concat(default.cast("string"), F.lit("-01-01")), "yyyy-MM-dd"))
    return F.coalesce(*found)


def all_page_links(pages: DataFrame, rules: tuple[SiteRule, ...] = RULES, year: int | None = None) -> DataFrame:
    """Candidate rows of the list pages of several banks, in page order.

    Returns (page_id, bank_code, position, title, date, url, speaker, speech_type). The rule is chosen per row, so all
    banks are read in one scan; rows of other banks give nothing.
    """
    def by_bank(make: Callable[[SiteRule], Column]) -> Column:
        value = F.lit(None)
        for rule in reversed(rules):
            value = F.when(_of(rule), make(rule)).otherwise(value)
        return value

    def part(name: str) -> Column:
        return by_bank(lambda r: _card_parts(F.col("card"), r)[name])

    def admitted(rule: SiteRule) -> Column:
        ok = F.col("usable") & is_candidate(F.col("href"), F.col("title"), rule)
        return ok & is_collectable(F.col("labels")) if rule.typed else ok

    cards = pages.select("page_id", "bank_code", F.posexplode(by_bank(lambda r: _cards(F.col("html"), r))).alias("position", "card"))
    rows = cards.select(
        "page_id", "bank_code", "position", *[part(n).alias(n) for n in ("usable", "href", "title", "date_text", "named")],
        F.substring(extract(F.col("card"), r"(?is)<time\b[^>]*datetime=[\"']([^\"']+)"), 1, 10).alias("time_tag"),
        (F.transform(F.regexp_extract_all("card", F.lit(ANCHOR), F.lit(0)), inner_text)).alias("labels"),
    ).where(by_bank(admitted))
    out = rows.select(
        "page_id", "bank_code", "position", "title", by_bank(lambda r: _date_of(r, year)).alias("date"),
        by_bank(lambda r: urls.absolute_url(F.col("href"), r.base_url, r.relative_prefix, r.keep_other_links)).alias("url"),
        F.coalesce(F.col("named"), people.speaker_from_title(F.col("title"), F.col("bank_code"))).alias("speaker"),
        by_bank(lambda r: primary_type(F.col("labels")) if r.typed else F.lit("speech")).alias("speech_type"),
    ).where(F.col("url").isNotNull())
    if year is not None:
        out = out.where(F.col("date").isNull() | (F.year("date") == year))
    return out


def page_links(pages: DataFrame, rule: SiteRule, year: int | None = None) -> DataFrame:
    """Candidate rows of the list pages of one bank; see `all_page_links`."""
    return all_page_links(pages, (rule,), year)


def _speaker_pattern(bank: str) -> str:
    """Where a card names its speaker: a profile link, a release tag or an author element."""
    if bank == "BOC":
        return r"(?is)<a\b[^>]*href=[\"'][^\"']*/profile/[^>]*>(.*?)</a>"
    if bank == "BOE":
        return r"(?is)<div\b[^>]*class=[\"'][^\"']*release-tag[^>]*>[^<]*//\s*([^<]*?)\s*</div>"
    return r"(?is)<\w+\b[^>]*class=[\"'][^\"']*(?:author-name|speaker)[^>]*>(.*?)</"


def page_texts(pages: DataFrame, rules: tuple[SiteRule, ...] = RULES) -> DataFrame:
    """S7 for a table of text pages of several banks: (page_id, bank_code, url, full_text).

    Pages known to be PDF by their address give null; the text of a scanned file comes
    from another table and goes through `dehyphenate`.
    """
    def by_bank(one: SiteRule) -> Column:
        if one.typed:
            return menu_free_text(F.col("html"), one)
        if one.bank_code == "ECB":
            return F.coalesce(page_text(F.col("html"), one), longest_section(F.col("html")))
        return page_text(F.col("html"), one)

    value = page_text(F.col("html"), GENERIC)
    for rule in rules:
        value = F.when(F.col("bank_code") == rule.bank_code, by_bank(rule)).otherwise(value)
    return pages.select(
        "page_id", "bank_code", "url",
        F.when(~urls.is_pdf(F.col("url")), value).alias("full_text"),
    )
