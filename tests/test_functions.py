"""Column functions on hand-written values."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rostrum.functions import dates, logs, people, scoring, text, urls


@pytest.mark.parametrize("raw, want", [
    (None, ""), ("  HTTP://A.org/B/ ", "https://a.org/b"), ("a/?q", "a/"), ("a//", "a/"),
    ("https://a/x#Frag", "https://a/x#frag"), ("http://a/?", "https://a/"), ("\thttp://a\n", "https://a"),
])
def test_normalize_url(value, raw, want):
    assert value(urls.normalize_url, raw) == want


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="aB/?#: htp.", max_size=12))
def test_normalize_url_order(value, raw):
    want = raw.strip().lower()
    want = want[:-1] if want.endswith("/") else want
    want = "https://" + want[7:] if want.startswith("http://") else want
    assert value(urls.normalize_url, raw) == want.split("?")[0]


@pytest.mark.parametrize("style, raw, want", [
    ("dataset", " 2024-3-05 ", "2024-03-05"), ("dataset", "05/03/2024", "2024-03-05"), ("dataset", "5 March 2024", "2024-03-05"),
    ("dataset", "20240305", "2024-03-05"), ("dataset", "March 5, 2024", None), ("dataset", "", None),
    ("card", "March 04, 2026", "2026-03-04"), ("card", "Mar 4, 2026", "2026-03-04"),
    ("card", "Posted March 4, 2026 at noon", "2026-03-04"), ("card", "Smarch 4, 2026", None),
    ("table", "May  21, 2026", "2026-05-21"), ("table", "Mar. 3, 2026", "2026-03-03"),
    ("table", "Feb. 30, 2026", None),
])
def test_parse_date(value, style, raw, want):
    got = value(lambda c: dates.parse_date(c, style), raw)
    assert (got and str(got)) == want


@pytest.mark.parametrize("raw, want", [
    ("Thu, 16 Apr 2026 15:15:00 +0200", "2026-04-16"), ("Thu, 16 Apr 2026 23:59:00 -1100", "2026-04-16"), ("soon", None), (None, None),
])
def test_parse_rfc822(value, raw, want):
    got = value(dates.parse_rfc822, raw)
    assert (got and str(got)) == want


@pytest.mark.parametrize("style, href, want", [
    ("digits8", "/speech/barr20260416a.htm", "2026-04-16"), ("digits8", "/speech/x.htm", "2030-01-01"),
    ("iso_or_ddmmyy", "/sp-2024-02-29.html", "2024-02-29"), ("iso_or_ddmmyy", "/sp-so-160813.html", "2013-08-16"),
    ("iso_or_ddmmyy", "/sp-so-160899.html", "1999-08-16"), ("iso_or_ddmmyy", "/sp-so-320813.html", "2030-01-01"),
    ("year_month_name", "/speech/2019/january/x", "2019-01-01"), ("year_month_name", "/speech/2019/sep/x", "2019-09-01"),
    ("year_month_name", "/speech/2019/boe/x", "2019-01-01"), ("year_month", "/2026/03/slug/", "2026-03-01"),
])
def test_date_from_url(value, style, href, want):
    assert str(value(lambda c: dates.date_from_url(c, style, F.lit(2030)), href)) == want


@pytest.mark.parametrize("bank, date, url, body, want", [
    ("BOE", "2019-01-01", "", "Published on 24 January 2019\nx", "2019-01-24"),
    ("BOE", "2019-01-01", "", "Published on 24 January 2018\nx", "2019-01-01"),
    ("BOE", "2021-03-01", "", "March 12, 2021", "2021-03-12"),
    ("BOE", "2021-03-01", "", "12 April 2021", "2021-03-01"),
    ("BOE", "2020-03-01", "", "12 March 2020", "2020-03-01"),
    ("BOJ", "2019-50-01", "", "Jan. 31, 2025", "2025-01-31"),
    ("BOJ", "2019-50-01", "", "nothing", "2019-01-01"),
    ("RBA", "", "/sp-gov-160813.html", "", "2013-08-16"),
    ("RBA", None, "/sp-gov.html", "", None),
    ("FRB", "2019-01-01", "", "24 January 2019", "2019-01-01"),
])
def test_repair_date(value, bank, date, url, body, want):
    assert value(dates.repair_date, bank, date, url, body) == want


def test_date_text_window(value):
    late = "x" * 2100 + " 24 January 2019"
    assert value(dates.date_from_text, late) is None
    assert value(lambda c: dates.date_from_text(c, 2500), late) == dt.date(2019, 1, 24)


@pytest.mark.parametrize("start, end, want, shown", [
    ("2026-01-01T10:00:00", "2026-01-01 10:00:01.5", 1.5, 1.5), ("2026-01-01 10:00:00", None, None, 0.0),
    ("2026-01-01 10:00:00", "2026-01-01 09:00:00", -3600.0, 0.0), ("junk", "2026-01-01 09:00:00", None, 0.0),
    ("1969-12-31 23:59:59", "1970-01-01 00:00:01", 2.0, 2.0),
])
def test_duration(value, start, end, want, shown):
    assert value(dates.duration_seconds, start, end) == want
    assert value(lambda a, b: dates.duration_seconds(a, b, True), start, end) == shown


def test_eastern_time_follows_daylight_saving(value):
    def show(c):
        return dates.eastern_time(c.cast("timestamp_ntz"))

    assert value(show, "2026-07-01 00:30:00.123") == "2026-06-30 20:30:00,123"
    assert value(show, "2026-01-01 00:30:00") == "2025-12-31 19:30:00,000"


@pytest.mark.parametrize("bank, name, want", [
    ("BOE", "Sir Jon Cunliffe", "Jon Cunliffe"), ("BOE", "Andy Haldane", "Andrew Haldane"), ("BOE", "MARK CARNEY", "Mark Carney"),
    ("BOE", "Dave Ramsden (May 2020)", "Dave Ramsden"), ("BOE", "Silvana Tenreyro slides", "Silvana Tenreyro"),
    ("BOJ", "UEDA Kazuo", "Kazuo Ueda"), ("BOJ", "Kazuo UEDA", "Kazuo Ueda"), ("FRB", "Powell", "Jerome H. Powell"),
    ("ECB", "Luis de Guindos", "Luis De Guindos"), ("BOE", "Ian McCafferty", "Ian Mccafferty"), ("ECB", "deputy governor  Ünal Öz", "Ünal Öz"),
])
def test_normalize_person(value, bank, name, want):
    assert value(people.normalize_person, name, bank) == want


@pytest.mark.parametrize("name, want", [
    ("Speech by X Y", True), ("ab", True), ("Ann Bee", False), ("Pull, Push, Pipes", True), (None, None), ("全日本語 x", True),
])
def test_noise_name(value, name, want):
    assert value(people.is_noise_name, name) == want


@pytest.mark.parametrize("bank, title, want", [
    ("BOE", "The outlook - speech by Jane Doe", "Jane Doe"), ("BOE", "The outlook − Remarks by Jane Doe (pdf 1.2MB)", "Jane Doe"),
    ("BOE", "Jane Doe: Prices and growth", "Jane Doe"), ("BOE", "At the meeting: Prices", None),
    ("BOE", "Slides from Jane Doe’s talk", "Jane Doe"), ("BOJ", "Prices (Speech by Governor UEDA Kazuo)", "UEDA Kazuo"),
    ("ECB", "Money. Speech by Jane Doe, Member", "Jane Doe"), ("ECB", "Interview with El País", "El País"), ("ECB", "Money", None),
    ("BOC", "One two three four five: x - y", None), ("BOC", "Jane Doe — x", "Jane Doe"), ("FRB", "By Governor Ünal Öz, today", "Ünal Öz"),
])
def test_speaker_from_title(value, bank, title, want):
    assert value(people.speaker_from_title, title, bank) == want


def test_listed_speaker(value):
    assert value(people.listed_speaker, "KOEDA Junko, Member of the Policy Board") == "Junko Koeda"
    assert value(people.listed_speaker, "Jane Doe") == "Jane Doe"
    assert value(people.listed_speaker, "") is None


def test_speaker_from_lines(value):
    def byline(c):
        return people.speaker_from_lines(c, "byline")

    assert value(byline, "A title, long\nJane Doe\nGovernor") == "Jane Doe"
    assert value(byline, "Transcript of Session\nTitle 1\nJane Doe\nGovernor") == "Jane Doe"
    assert value(byline, "A title\nDeputy Governor\nJane Doe") == "Jane Doe"
    assert value(byline, "Only one line") is None
    assert value(people.speaker_from_lines, "1 a\nThe Bank\nJane Doe\n") == "Jane Doe"


def test_headers(value):
    body = "__SPEAKER__:Jane Doe\nfirst\n__DATE__: 2024-01-02 \nlast"
    assert value(lambda c: people.header_field(c, "DATE"), body) == "2024-01-02"
    assert value(lambda c: people.header_field(c, "SPEAKER"), body) == "Jane Doe"
    assert value(people.strip_headers, body) == "first\nlast"
    assert value(lambda c: people.header_field(c, "DATE"), "no header") is None


@pytest.mark.parametrize("lines, kept", [
    (["  Why ports matter ", "", "Why ports matter", "Cranes."], ["Why ports matter", "Cranes."]),
    (["a", "PDF", "a", "Video", "b", "a"], ["a", "b", "a"]),  # chrome between two equal lines does not part them
    (["Rail", "Share this page by mail", "Share this page", "and road", "Audio only"], ["Rail", "and road", "Audio only"]),
    (["Tide tables", "Subject(s)", "Harbours", "Related Information"], ["Tide tables"]),
    (["Related Information on ebb", "flood\u00a0", "Related Information", "Subject(s)", "x"], ["Related Information on ebb", "flood"]),
    (["Available as:", "Content Type(s)"], []), ([], [])])
def test_clean_page_text(value, lines, kept):
    assert value(text.clean_page_text, "\n".join(lines)) == "\n".join(kept)
    assert value(text.clean_page_text, "\r\n\t".join(lines)) == "\n".join(kept)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", "PDF", "", "Share this page x", "Subject(s)", " a "]), max_size=10))
def test_clean_page_text_like_one_pass(value, lines):
    kept, previous = [], None
    for raw in lines:
        line = raw.strip()
        if not line or line == previous or line.startswith("Share this page") or line in text.CHROME_LINES:
            continue
        kept.append(line)
        previous = line
    for i, line in enumerate(kept):
        if line in text.CUT_LINES:
            kept = kept[:i]
            break
    assert value(text.clean_page_text, "\n".join(lines)) == "\n".join(kept).strip()


def test_dehyphenate(value):
    body = "the mone-\ntary policy of Ün-\nal and A-\nB " + "x" * 60
    assert value(text.dehyphenate, body) == "the monetary policy of Ünal and A-\nB " + "x" * 60
    assert value(text.dehyphenate, "short") == text.NO_TEXT_MESSAGE
    assert value(text.dehyphenate, None) == text.NO_TEXT_MESSAGE


@pytest.mark.parametrize("raw, want", [(0.34, 0.3), (1.7, 1.0), (-3.0, -1.0), (None, None), (0.0, 0.0)])
def test_clamp_score(spark, raw, want):
    assert spark.range(1).select(scoring.clamp_score(F.lit(raw).cast("double"))).first()[0] == want


@pytest.mark.parametrize("raw, usable, score, status", [
    ('{"stance_score": 0.5, "stance_reason": "Test reason.", "keywords": [{"category": "Inflation", "detail": "Test"}], "main_risk": "r"}',
     True, 0.5, "scored"),
    ('{"stance_score": null, "stance_reason": "No policy signal.", "keywords": [], "main_risk": null}', True, None, "no_signal"),
    ('{"stance_score": "0.5", "stance_reason": "x"}', True, 0.5, "scored"),
    ('{"stance_score": "high", "stance_reason": "x"}', False, None, None),
    ('{"stance_reason": "x"}', False, None, None), ("nonsense", False, None, None), (None, False, None, None),
])
def test_parse_result(value, raw, usable, score, status):
    got = value(scoring.parse_result, raw)
    assert (got is not None) == usable
    if usable:
        assert got["stance_score"] == score
        assert value(lambda c: scoring.score_status(scoring.parse_result(c)["stance_score"]), raw) == status


@pytest.mark.parametrize("age, want", [(-5, 1.0), (90, 1.0), (91, 0.5), (180, 0.5), (181, 0.2), (365, 0.2), (366, 0.05)])
def test_age_weight(spark, age, want):
    today = F.lit("2024-06-30").cast("date")
    assert spark.range(1).select(scoring.age_weight(F.date_sub(today, age), today)).first()[0] == want


def test_log_line_round_trip(value):
    line = "2026-01-02 03:04:05,678 | INFO | log |  Job done  | a=1, b=x=y, =no, nope, a=2 | lost"
    got = value(logs.parse_line, line)
    assert (got["level"], got["message"], got["extra_text"]) == ("INFO", "Job done", "a=1, b=x=y, =no, nope, a=2")
    assert value(logs.parse_kv, got["extra_text"]) == {"a": "2", "b": "x=y"}
    assert value(logs.parse_line, "too | few | parts") is None
    assert value(logs.safe_value, "a, b=c\nd ") == "a; b:c d"
    assert value(dates.log_time, got["ts_text"]) == dt.datetime(2026, 1, 2, 3, 4, 5, 678000)


@pytest.mark.parametrize("raw, want", [
    ("SUCCESS", "success"), ("partial", "warning"), ("fail", "failed"), ("error", "failed"), ("idle", "unknown"), (None, "unknown"),
])
def test_normalize_status(value, raw, want):
    assert value(logs.normalize_status, raw) == want


def test_details(value):
    assert value(logs.details, '{"a": 1}') == {"a": "1"}
    assert value(logs.details, "broken {") == {"raw": "broken {"}
    assert value(logs.details, None) is None


def test_choose_text_and_menu(value):
    assert value(text.choose_text, None, "web") == "web"
    assert value(text.choose_text, "short", "") == "short"
    assert value(text.choose_text, "x" * 100, "web") == "x" * 100
    assert value(text.trim_menu, "About us\nmore", "Heading") == "Heading"
    assert value(text.trim_menu, "x" * 250 + "About us", "Heading") == "x" * 250 + "About us"


@pytest.mark.parametrize("bank, body, want", [
    ("BOJ", "Tokyo, Jan.31, 2025 at noon", dt.date(2025, 1, 31)), ("BOJ", "Sept. 5,2024", dt.date(2024, 9, 5)),
    ("BOE", "Published on 24 Jan 2019", dt.date(2019, 1, 24)), ("BOE", "12 Sept 2020 and 1 May 2021", dt.date(2020, 9, 12)),
    ("BOE", "Mar 3, 2020", dt.date(2020, 3, 3)), ("FRB", "Published on 24 Jan 2019", None), ("FRB", "24 January 2019", dt.date(2019, 1, 24)),
    ("BOE", "31 Feb 2020", None), ("BOE", "see 7 Rooms 2020", None), (None, "24 January 2019", dt.date(2019, 1, 24)), ("BOJ", None, None)])
def test_date_in_the_form_of_a_bank(value, bank, body, want):
    assert value(lambda b, t: dates.date_from_text(t, bank=b), bank, body) == want
