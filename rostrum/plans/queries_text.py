"""Pages, URLs, dates, names and texts."""

from pyspark.sql import functions as F

from rostrum.functions import dates, people, scoring, text, urls
from rostrum.functions.basic import strip
from rostrum.operators.common import as_date
from rostrum.plans.registry import SQL, query
from rostrum.plans.views import AS_OF_O
from rostrum.session import work_folder
from rostrum.sources import datasets, pages
from rostrum.sources.runlogs import read_log

# --- URLs -----------------------------------------------------------------------------


@query(r"""
    SELECT page_id, k, regexp_replace(regexp_replace(lower(trim(raw)), '/$', ''), '^http://', 'https://') AS u,
      split_part(regexp_replace(regexp_replace(lower(trim(raw)), '/$', ''), '^http://', 'https://'), '?', 1) AS norm
    FROM (SELECT page_id, k, CASE k WHEN 0 THEN url WHEN 1 THEN '  ' || upper(url) || '/ ' ELSE url || '/?q=1' END AS raw
      FROM (SELECT page_id, url, unnest([0, 1, 2]) AS k FROM pages))""")
def normalize_url(v):
    raw = v.table("pages").select("page_id", "url", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("k")).select(
        "page_id", "k",
        F.when(F.col("k") == 0, F.col("url"))
        .when(F.col("k") == 1, F.concat(F.lit("  "), F.upper("url"), F.lit("/ ")))
        .otherwise(F.concat("url", F.lit("/?q=1"))).alias("raw"),
    )
    bare = F.regexp_replace(F.regexp_replace(F.lower(strip(F.col("raw"))), r"/\z", ""), r"\Ahttp://", "https://")
    return raw.select("page_id", "k", bare.alias("u"), urls.normalize_url(F.col("raw")).alias("norm"))


@query("""
    SELECT position, CAST(split_part(lower(url), '?', 1) LIKE '%.pdf' AS BIGINT) AS by_url,
      CAST(split_part(lower(url), '?', 1) LIKE '%.pdf' OR page_id % 2 = 0 AS BIGINT) AS by_either FROM candidates_p""")
def is_pdf(v):
    kind = F.when(F.col("page_id") % 2 == 0, F.lit("Application/PDF; x")).otherwise(F.lit("text/html"))
    return v.candidates_p.select(
        "position", urls.is_pdf(F.col("url")).alias("by_url"), urls.is_pdf(F.col("url"), kind).alias("by_either")
    )


@query("""
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://b.org/' || path WHEN 1 THEN url ELSE 'https://b.org/s/' || path END
        AS with_prefix,
      CASE page_id % 3 WHEN 0 THEN 'https://b.org/' || path WHEN 1 THEN url END AS dropped,
      CASE page_id % 3 WHEN 0 THEN 'https://b.org/' || path WHEN 1 THEN url ELSE path END AS kept
    FROM (SELECT page_id, url, regexp_extract(url, '://[^/]+/(.*)$', 1) AS path FROM pages)""")
def absolute_url(v):
    path = F.regexp_extract("url", r"://[^/]+/(.*)$", 1)
    href = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/"), path)).when(F.col("page_id") % 3 == 1, F.col("url"))
    rows = v.table("pages").select("page_id", href.otherwise(path).alias("href"))
    base = "https://b.org"
    return rows.select(
        "page_id",
        urls.absolute_url(F.col("href"), base, f"{base}/s/").alias("with_prefix"),
        urls.absolute_url(F.col("href"), base).alias("dropped"),
        urls.absolute_url(F.col("href"), base, keep_other=True).alias("kept"),
    )


@query("""
    SELECT position, trim(title) AS plain, lower(trim(title)) AS low,
      lower(trim(replace(replace(replace(replace(title, ' (Summary)', ''), ' (Full Text)', ''), ' (SUMMARY)', ''), ' (FULL TEXT)', '')))
        AS variant FROM candidates_p""")
def title_key(v):
    title = F.col("title")
    return v.candidates_p.select(
        "position", urls.title_key(title).alias("plain"), urls.title_key(title, "lower").alias("low"),
        urls.title_key(title, "variant").alias("variant"),
    )


@query("""
    SELECT id, 'ecb://speeches/' || CAST(date AS VARCHAR) || '/'
      || substring(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), 1, 60) AS slug FROM speeches_d""")
def slug_url(v):
    return v.speeches_d.select("id", urls.slug_url(F.lit("ecb"), F.col("date"), F.col("title")).alias("slug"))


# --- dates ----------------------------------------------------------------------------


@query("""
    SELECT id, CASE WHEN k IN (0, 1, 2, 3) THEN CAST(date AS VARCHAR) END AS dataset,
      CASE WHEN k IN (0, 4, 5, 7) THEN CAST(date AS VARCHAR) END AS card,
      CASE WHEN k IN (4, 5, 6, 7) THEN CAST(date AS VARCHAR) END AS listed
    FROM (SELECT id, date, id % 9 AS k FROM speeches_o)""")
def parse_date_multi(v):
    day = F.col("date")

    def fmt(pattern):
        return F.date_format(day, pattern)

    k = F.col("id") % 9
    written = (
        F.when(k == 0, fmt("yyyy-MM-dd")).when(k == 1, fmt("dd/MM/yyyy")).when(k == 2, fmt("d MMMM yyyy"))
        .when(k == 3, fmt("yyyyMMdd")).when(k == 4, F.concat(F.lit(" "), fmt("MMMM d, yyyy"), F.lit("\u00a0")))
        .when(k == 5, fmt("MMM d, yyyy")).when(k == 6, F.concat(fmt("MMM"), F.lit(". "), fmt("d, yyyy")))
        .when(k == 7, F.concat(F.lit("on "), fmt("MMMM"), F.lit("\u00a0 "), fmt("d, yyyy"), F.lit(" at noon")))
        .otherwise(F.lit("31 Febtober 2020"))
    )
    rows = v.speeches_o.select("id", written.alias("t"))
    return rows.select(
        "id", dates.parse_date(F.col("t"), "dataset").alias("dataset"), dates.parse_date(F.col("t"), "card").alias("card"),
        dates.parse_date(F.col("t"), "table").alias("listed"),
    )


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS day FROM events")
def parse_rfc822(v):
    stamp = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0200"))
    raw = F.when(F.col("event_id") % 5 == 0, F.lit("yesterday at noon")).otherwise(stamp)
    return v.table("events").select("event_id", dates.parse_rfc822(raw).alias("day"))


@query("""
    SELECT id, CASE WHEN id % 4 = 0 THEN '2031-01-01' ELSE CAST(date AS VARCHAR) END AS digits8,
      CASE WHEN id % 4 = 0 THEN NULL ELSE CAST(date AS VARCHAR) END AS iso_or_ddmmyy,
      CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN strftime(date, '%Y-01-01') ELSE strftime(date, '%Y-%m-01') END AS month_name,
      CASE WHEN id % 4 = 0 THEN NULL ELSE strftime(date, '%Y-%m-01') END AS month_digits FROM speeches_o""")
def date_from_url(v):
    def fmt(pattern):
        return F.date_format("date", pattern)

    k = F.col("id") % 4
    none = F.lit("/about/index.htm")
    digits = F.when(k == 0, none).otherwise(F.concat(F.lit("/s/name"), fmt("yyyyMMdd"), F.lit("a.htm")))
    iso = (
        F.when(k == 0, none).when(k == 1, F.concat(F.lit("/sp/"), fmt("yyyy-MM-dd"), F.lit(".html")))
        .otherwise(F.concat(F.lit("/sp-ag-"), fmt("ddMMyy"), F.lit(".html")))
    )
    name = (
        F.when(k == 0, none).when(k == 1, F.concat(F.lit("/speech/"), fmt("yyyy"), F.lit("/speeches/x")))
        .when(k == 2, F.concat(F.lit("/speech/"), fmt("yyyy"), F.lit("/"), F.lower(fmt("MMMM")), F.lit("/x")))
        .otherwise(F.concat(F.lit("/speech/"), fmt("yyyy"), F.lit("/"), F.lower(fmt("MMM")), F.lit("/x")))
    )
    number = F.when(k == 0, none).otherwise(F.concat(F.lit("/"), fmt("yyyy/MM"), F.lit("/slug/")))
    return v.speeches_o.select(
        "id", dates.date_from_url(digits, "digits8", F.lit(2031)).alias("digits8"),
        dates.date_from_url(iso, "iso_or_ddmmyy").alias("iso_or_ddmmyy"),
        dates.date_from_url(name, "year_month_name").alias("month_name"),
        dates.date_from_url(number, "year_month").alias("month_digits"),
    )


@query("SELECT id, CAST(text_date AS VARCHAR) AS found FROM dated_d")
def date_from_text(v):
    return v.dated_d.select("id", dates.date_from_text(F.col("full_text")).alias("found"))


@query("""
    SELECT id, bank_code, CAST(CASE
      WHEN id % 6 = 0 AND (bank_code = 'BOE' OR month(true_date) = 5) THEN true_date
      WHEN id % 6 IN (1, 2) AND bank_code = 'BOJ' THEN true_date
      WHEN id % 6 = 3 THEN true_date
      WHEN id % 6 = 4 THEN true_date END AS VARCHAR) AS found FROM dated_d""")
def date_from_text_by_bank(v):
    """X9 in the forms that the banks' own pages use."""
    forms = F.expr("""CASE id % 6 WHEN 0 THEN concat('Published on ', date_format(true_date, 'd MMM yyyy'))
        WHEN 1 THEN concat('Tokyo, ', date_format(true_date, 'MMM'), '.', date_format(true_date, 'd, yyyy'))
        WHEN 2 THEN concat(date_format(true_date, 'MMM'), '. ', date_format(true_date, 'd,yyyy'))
        WHEN 3 THEN concat('Given on ', date_format(true_date, 'd MMMM yyyy'))
        WHEN 4 THEN concat('At noon, ', date_format(true_date, 'MMM d, yyyy')) ELSE 'No date here' END""")
    head = F.concat(forms, F.lit("\n"), F.col("full_text").substr(F.instr("full_text", "\n") + 1, F.length("full_text")))
    # BOJ writes the month first; a date that names the day first is found by the general form.
    return v.dated_d.select("id", "bank_code", dates.date_from_text(head, bank=F.col("bank_code")).alias("found"))


PLACEHOLDER_SQL = """(bank_code IN ('BOE', 'BOJ') AND (date LIKE '%-01-01' OR date LIKE '%-50-%'))
      OR (bank_code = 'BOE' AND (date LIKE '2021-%-01' OR date LIKE '2022-%-01' OR date LIKE '2023-%-01'))
      OR (bank_code = 'RBA' AND coalesce(date, '') = '')"""


@query(f"SELECT id, date FROM dated_d WHERE {PLACEHOLDER_SQL}")
def placeholder_dates(v):
    return v.dated_d.where(dates.is_placeholder_date(F.col("bank_code"), F.col("date"))).select("id", "date")


REPAIR_SQL = f"""
    SELECT id, CASE WHEN NOT coalesce({PLACEHOLDER_SQL}, FALSE) THEN date
      WHEN bank_code = 'RBA' THEN CAST(true_date AS VARCHAR)
      WHEN date LIKE '%-50-%' THEN coalesce(CAST(text_date AS VARCHAR), date[1:4] || '-01-01')
      WHEN date LIKE '%-01-01' AND date[1:4] = CAST(text_date AS VARCHAR)[1:4] THEN CAST(text_date AS VARCHAR)
      WHEN date NOT LIKE '%-01-01' AND date[1:7] = CAST(text_date AS VARCHAR)[1:7] THEN CAST(text_date AS VARCHAR)
      ELSE date END AS date FROM dated_d"""


@query(REPAIR_SQL)
def repair_date(v):
    fixed = dates.repair_date(F.col("bank_code"), F.col("date"), F.col("url"), F.col("full_text"))
    return v.dated_d.select("id", fixed.alias("date"))


@query("SELECT id, round(epoch_us(finished_at - started_at) / 1000000.0, 6) AS seconds, "
       "greatest(coalesce(round(epoch_us(started_at - finished_at) / 1000000.0, 6), 0), 0) AS reversed FROM runlog_e"
       .replace("epoch_us(finished_at - started_at)", "(epoch_us(finished_at) - epoch_us(started_at))")
       .replace("epoch_us(started_at - finished_at)", "(epoch_us(started_at) - epoch_us(finished_at))"))
def duration_seconds(v):
    return v.runlog_e.select(
        "id", dates.duration_seconds(F.col("started_at"), F.col("finished_at")).alias("seconds"),
        dates.duration_seconds(F.col("finished_at"), F.col("started_at"), negative_as_zero=True).alias("reversed"),
    )


@query("SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events")
def log_time(v):
    written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    return v.table("events").select("event_id", dates.log_time(written).alias("ts"))


@query("SELECT event_id, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S,%g') AS eastern FROM events")
def eastern_time(v):
    """January: New York is five hours behind."""
    return v.table("events").select("event_id", dates.eastern_time(F.col("ts")).alias("eastern"))


# --- people ---------------------------------------------------------------------------


def _cap(word: str) -> str:
    return f"upper({word}[1]) || lower({word}[2:])"


@query(f"""
    SELECT id, CASE
      WHEN kind IN (6, 7) AND bank_code <> 'x' THEN CASE kind WHEN 6 THEN 'Speech By ' || {_cap('w1')} || ' ' || {_cap('w2')} ELSE 'Ab' END
      WHEN bank_code = 'BOJ' AND kind IN (3, 8) THEN CASE kind WHEN 3 THEN {_cap('w2')} || ' ' || {_cap('w1')} ELSE {_cap('w1')} || ' ' || {_cap('w2')} END
      WHEN kind = 4 AND bank_code <> 'BOE' THEN {_cap('w1')} || ' ' || {_cap('w2')} || ' (may 2020)'
      WHEN kind = 5 AND bank_code <> 'BOE' THEN {_cap('w1')} || ' ' || {_cap('w2')} || ' Slides'
      ELSE {_cap('w1')} || ' ' || {_cap('w2')} END AS name FROM people_p""")
def normalize_person(v):
    return v.people_p.select("id", people.normalize_person(F.col("name"), F.col("bank_code")).alias("name"))


@query("SELECT id, CAST(kind IN (5, 6, 7) AS BIGINT) AS noise FROM people_p")
def is_noise_name(v):
    return v.people_p.select("id", people.is_noise_name(F.col("name")).alias("noise"))


@query("""
    SELECT id, CASE k WHEN 0 THEN 'Governor' WHEN 1 THEN 'Chair' WHEN 2 THEN 'President' WHEN 3 THEN 'Board Member'
      WHEN 4 THEN 'Governor' END AS role FROM (SELECT id, id % 7 AS k FROM people_p)""")
def role_from_title(v):
    k = F.col("id") % 7
    title = (
        F.when(k == 0, F.concat(F.lit("Remarks by Governor "), "name")).when(k == 1, F.concat("name", F.lit(", Chair")))
        .when(k == 2, F.concat("name", F.lit(", President"))).when(k == 3, F.concat(F.lit("Board Member "), "name"))
        .when(k == 4, F.concat(F.lit("Chair and Governor "), "name")).when(k == 5, F.concat(F.lit("governor "), "name"))
    )
    return v.people_p.select("id", people.role_from_title(title).alias("role"))


PERSON = f"{_cap('w1')} || ' ' || {_cap('w2')}"


@query(f"""
    SELECT id, CASE WHEN bank_code = 'ECB' THEN CASE WHEN k IN (0, 1) THEN {PERSON} WHEN k = 5 THEN 'Governor ' || {PERSON} || ')' END
      WHEN bank_code = 'BOE' THEN CASE WHEN k = 3 AND w1 || w2 LIKE '%at%' THEN NULL WHEN k IN (2, 3, 4) THEN {PERSON} WHEN k = 0 THEN NULL END
      WHEN bank_code = 'BOJ' THEN CASE WHEN k = 5 THEN {PERSON} END
      WHEN bank_code = 'BOC' THEN CASE WHEN k IN (3, 6, 7) THEN {PERSON} WHEN k = 2 THEN 'Money and credit' END
      WHEN bank_code = 'FRB' THEN CASE WHEN k IN (5, 8) THEN {PERSON} END END AS speaker
    FROM (SELECT id, w1, w2, (id // 3) % 9 AS k, (['ECB', 'BOE', 'BOJ', 'BOC', 'FRB'])[(id // 27) % 5 + 1] AS bank_code FROM people_p)""")
def speaker_from_title(v):
    k = F.expr("(id div 3) % 9")
    who = F.concat_ws(" ", F.initcap("w1"), F.initcap("w2"))
    bank = F.element_at(F.array(*[F.lit(b) for b in ("ECB", "BOE", "BOJ", "BOC", "FRB")]), F.expr("cast((id div 27) % 5 + 1 AS int)"))
    title = (
        F.when(k == 0, F.concat(F.lit("On growth. Speech by "), who, F.lit(", Member of the Board")))
        .when(k == 1, F.concat(F.lit("Interview with "), who, F.lit(", in a paper")))
        .when(k == 2, F.concat(F.lit("Money and credit - panel remarks by "), who, F.lit(" (pdf 2.1MB)")))
        .when(k == 3, F.concat(who, F.lit(": monetary policy")))
        .when(k == 4, F.concat(F.lit("Slides from "), who, F.lit("’s talk")))
        .when(k == 5, F.concat(F.lit("Prices (Speech by Governor "), who, F.lit(")")))
        .when(k == 6, F.concat(who, F.lit("—a new view of prices")))
        .when(k == 7, F.concat(who, F.lit(" - a new view of prices")))
        .otherwise(F.concat(F.lit("Outlook; Governor "), who, F.lit(", today")))
    )
    rows = v.people_p.select("id", title.alias("title"), bank.alias("bank_code"))
    return rows.select("id", people.speaker_from_title(F.col("title"), F.col("bank_code")).alias("speaker"))


@query(f"""
    SELECT id, CASE k WHEN 0 THEN {PERSON} WHEN 1 THEN {PERSON} WHEN 2 THEN {PERSON} END AS byline,
      CASE k WHEN 0 THEN {PERSON} WHEN 1 THEN {PERSON} WHEN 2 THEN {PERSON} WHEN 3 THEN {PERSON} END AS opening
    FROM (SELECT id, w1, w2, id % 5 AS k FROM people_p)""")
def speaker_from_lines(v):
    k = F.col("id") % 5
    who = F.concat_ws(" ", F.initcap("w1"), F.initcap("w2"))
    body = (
        F.when(k == 0, F.concat(F.lit("The outlook for prices in 2020\n\n "), who, F.lit(" \nGovernor\nText")))
        .when(k == 1, F.concat(F.lit("Transcript of Session 1\nOn the long road\n"), who, F.lit("\nGovernor")))
        .when(k == 2, F.concat(F.lit("What we know, in short\nDeputy Governor\n"), who, F.lit("\n2 May 2020")))
        .when(k == 3, F.concat(F.lit("1, one, more\n2. two\n3. three\n"), who, F.lit("\nrest")))
        .otherwise(F.lit("all lower case here\nand 1 more\n"))
    )
    rows = v.people_p.select("id", body.alias("t"))
    return rows.select(
        "id", people.speaker_from_lines(F.col("t"), "byline").alias("byline"),
        people.speaker_from_lines(F.col("t"), "any").alias("opening"),
    )


@query(f"""
    SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE '2020-05-' || lpad(CAST(id % 28 + 1 AS VARCHAR), 2, '0') END AS day,
      CASE WHEN id % 3 = 2 THEN {PERSON} END AS speaker, 'line one' || chr(10) || 'line two' AS body FROM people_p""")
def parse_header_lines(v):
    k = F.col("id") % 3
    who = F.concat_ws(" ", F.initcap("w1"), F.initcap("w2"))
    day = F.concat(F.lit("2020-05-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))
    body = (
        F.when(k == 0, F.lit("line one\nline two"))
        .when(k == 1, F.concat(F.lit("__DATE__:2000-01-01\n__DATE__: "), day, F.lit(" \nline one\nline two")))
        .otherwise(F.concat(F.lit("__SPEAKER__:"), who, F.lit("\nline one\n__DATE__:"), day, F.lit("\nline two\n")))
    )
    rows = v.people_p.select("id", body.alias("t"))
    return rows.select(
        "id", people.header_field(F.col("t"), "DATE").alias("day"),
        people.header_field(F.col("t"), "SPEAKER").alias("speaker"), people.strip_headers(F.col("t")).alias("body"),
    )


# --- texts ----------------------------------------------------------------------------

CHROME = "Share this page on X\nAvailable as:\nPDF\n"


@query(r"""
    SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(a, range(1, len(a) + 1)),
        lambda z: z[2] = 1 OR z[1] <> a[z[2] - 1]), lambda z: z[1]), chr(10)) AS body
    FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n'), lambda x: trim(x)), lambda x: x <> '') AS a FROM documents)""")
def clean_page_text(v):
    """Documents dressed up with page chrome; cleaning gives back their own lines."""
    dressed = F.concat(
        F.lit(CHROME), F.replace("text", F.lit("\n"), F.lit(" \n\n\u00a0")),
        F.lit("\nShare this page\nContent Type(s)\n:\nPress\nRelated Information\nmore"),
    )
    return v.table("documents").select("doc_id", text.clean_page_text(dressed).alias("body"))


@query(r"""
    SELECT doc_id, CAST(len(list_filter(range(1, len(a) + 1), lambda i: i = 1 OR a[i] <> a[i - 1])) AS BIGINT) AS kept
    FROM (SELECT doc_id, string_split(text, ' ') AS a FROM documents)""")
def collapse_repeats(v):
    return v.table("documents").select("doc_id", F.size(text.collapse_repeats(F.split("text", " "))).alias("kept"))


@query("""
    SELECT doc_id, CAST(doc_id % 4 = 0 OR doc_id % 4 = 1 AS BIGINT) AS dirty FROM documents""")
def dirty_text(v):
    k = F.col("doc_id") % 4
    dressed = F.when(k == 0, F.concat("text", F.lit("Share this page"))).when(
        k == 1, F.concat(F.lit("Content Type(s)"), F.col("text"))
    ).when(k == 2, F.col("text"))
    return v.table("documents").select("doc_id", text.is_dirty(dressed).alias("dirty"))


@query(r"""
    SELECT doc_id, CASE WHEN length(joined) < 50 THEN message ELSE joined END AS joined,
      CASE WHEN n_chars % 2 = 0 OR length(head) < 50 THEN message ELSE head END AS message
    FROM (SELECT doc_id, n_chars, 'This speech appears to be a scanned document or contains no extractable text.' AS message,
      regexp_replace(trim(replace(text, ' t', '-' || chr(10) || 't'), ' ' || chr(10)), '([\p{L}\p{N}_]+)-\n([a-z]+)', '\1\2', 'g') AS joined,
      trim(substring(text, 1, 60), ' ' || chr(10)) AS head FROM documents)""")
def dehyphenate(v):
    broken = F.replace("text", F.lit(" t"), F.lit("-\nt"))
    head = F.when(F.col("n_chars") % 2 == 0, F.lit("too little")).otherwise(F.rpad(F.substring("text", 1, 60), 60, " "))
    return v.table("documents").select("doc_id", text.dehyphenate(broken).alias("joined"), text.dehyphenate(head).alias("message"))


@query("SELECT doc_id, text AS clean FROM documents")
def strip_mojibake(v):
    spoiled = F.concat(F.lit("ζц"), F.substring("text", 1, 5), F.lit(text.MOJIBAKE[0]), F.expr("substring(text, 6)"))
    return v.table("documents").select("doc_id", text.strip_mojibake(spoiled).alias("clean"))


@query("""
    SELECT doc_id, CASE WHEN length(text) > 1000 THEN substring(text, 1, 1000) || '... [TEXT TRUNCATED]' ELSE text END AS cut,
      'Date: 2024-01-31' || chr(10) || 'Speaker: ' || CASE WHEN doc_id % 2 = 0 THEN 'P' ELSE 'Unknown' END || chr(10) || chr(10)
      || 'Speech Text:' || chr(10) || text || chr(10) AS prompt FROM documents""")
def truncate_text(v):
    who = F.when(F.col("doc_id") % 2 == 0, F.lit("P"))
    return v.table("documents").select(
        "doc_id", text.truncate_text(F.col("text"), 1000).alias("cut"),
        text.scorer_input(F.col("text"), as_date("2024-01-31"), who).alias("prompt"),
    )


@query("""
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'fetched' WHEN doc_id % 3 = 1 AND n_chars < 400 THEN 'fetched'
      WHEN doc_id % 3 = 1 THEN text ELSE text END AS chosen FROM documents""")
def choose_text(v):
    old = F.when(F.col("doc_id") % 3 != 0, F.col("text"))
    new = F.when(F.col("doc_id") % 3 != 2, F.lit("fetched"))
    return v.table("documents").select("doc_id", text.choose_text(old, new, 400).alias("chosen")).withColumn(
        "chosen", F.col("chosen")
    )


@query("""
    SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'from ' || page_id ELSE 'text ' || page_id END AS body FROM pages""")
def trim_menu(v):
    menu = F.when(F.col("page_id") % 2 == 0, F.lit("About us\nMenu")).otherwise(F.concat(F.lit("text "), "page_id"))
    return v.table("pages").select(
        "page_id", text.trim_menu(menu, F.concat(F.lit("from "), F.col("page_id"))).alias("body")
    )


# --- scores ---------------------------------------------------------------------------


@query("""
    SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN greatest(least(round(o_totalprice / 200000 - 1, 1), 1.0), -1.0) + 0.0 END AS score,
      CASE WHEN o_orderkey % 5 <> 0 THEN 'scored' ELSE 'no_signal' END AS status FROM orders""")
def clamp_score(v):
    raw = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice") / 200000 - 1)
    rows = v.table("orders").select(F.col("o_orderkey").alias("id"), raw.alias("raw"))
    return rows.select(
        "id", scoring.clamp_score(F.col("raw")).alias("score"), scoring.score_status(F.col("raw")).alias("status")
    )


@query("SELECT o_orderkey AS id, CASE WHEN o_totalprice > 100000 THEN 'scored' ELSE 'no_signal' END AS status FROM orders")
def score_status(v):
    score = F.when(F.col("o_totalprice") > 100000, F.lit(0.1))
    return v.table("orders").select(F.col("o_orderkey").alias("id"), scoring.score_status(score).alias("status"))


RESPONSES = (
    "CASE id % 6 WHEN 0 THEN concat('{\"stance_score\": ', stance_score * 3, ', \"stance_reason\": \"r\", \"keywords\": ', keywords, "
    "', \"main_risk\": \"m\"}') WHEN 1 THEN '{\"stance_score\": null, \"stance_reason\": \"none\", \"keywords\": [], \"main_risk\": null}' "
    "WHEN 2 THEN '{\"stance_reason\": \"no score key\"}' WHEN 3 THEN 'not json' WHEN 4 THEN NULL "
    "ELSE '{\"stance_score\": \"high\", \"stance_reason\": \"text score\"}' END"
)


@query("""
    SELECT speech_id AS id, CAST((speech_id % 6 = 0 AND stance_score IS NOT NULL) OR speech_id % 6 = 1 AS BIGINT) AS usable,
      CASE WHEN speech_id % 6 = 0 AND stance_score IS NOT NULL THEN greatest(least(round(stance_score * 3, 1), 1.0), -1.0) + 0.0 END AS stance_score,
      CASE WHEN speech_id % 6 = 0 AND stance_score IS NOT NULL THEN 'r' WHEN speech_id % 6 = 1 THEN 'none' END AS stance_reason,
      CASE WHEN speech_id % 6 = 0 AND stance_score IS NOT NULL THEN keywords[16:length(keywords) - 19] END AS category
    FROM analysis_o""".replace("keywords[16:length(keywords) - 19]", "json_extract_string(keywords, '$[0].category')"))
def parse_result_json(v):
    rows = v.analysis_o.withColumnRenamed("speech_id", "id").select(
        "id", scoring.parse_result(F.expr(RESPONSES)).alias("r")
    )
    return rows.select(
        "id", F.col("r").isNotNull().alias("usable"), "r.stance_score", "r.stance_reason",
        F.try_element_at("r.keywords", F.lit(1))["category"].alias("category"),
    )


@query("""
    SELECT json_extract_string(keywords, '$[0].category') AS category, json_extract_string(keywords, '$[0].detail') AS detail,
      count(*) AS n FROM analysis_o GROUP BY 1, 2""")
def keywords_json(v):
    there_and_back = scoring.keywords_from_json(scoring.keywords_to_json(scoring.keywords_from_json(F.col("keywords"))))
    exploded = v.analysis_o.select(F.explode(there_and_back).alias("k")).select("k.category", "k.detail")
    return exploded.groupBy("category", "detail").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 25 = 0 THEN 'Skipped: Missing full text.'
      ELSE 'Skipped: Text too short for meaningful analysis (<= 500 chars).' END AS reason FROM documents""")
def skip_reason(v):
    return v.speeches_d.select(F.col("id").alias("doc_id"), scoring.skip_reason(F.col("full_text")).alias("reason"))


# --- pages ----------------------------------------------------------------------------

TEXT_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0},
    '<!--.*?-->', '', 'gs'), '<nav\b[^>]*>.*?</nav\s*>', '', 'gis'), '<header\b[^>]*>.*?</header\s*>', '', 'gis'),
    '<footer\b[^>]*>.*?</footer\s*>', '', 'gis'), '<script\b[^>]*>.*?</script\s*>', '', 'gis'),
    '<style\b[^>]*>.*?</style\s*>', '', 'gis')"""
DECODE_SQL = (
    "replace(replace(replace(replace(replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), "
    "'&quot;', '\"'), '&#39;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&ndash;', '–'), "
    "'&mdash;', '—'), '&amp;', '&')"
)
NODES_SQL = (
    "array_to_string(list_filter(list_transform(string_split(regexp_replace({0}, '<[^>]*>', chr(1), 'gs'), chr(1)), "
    "lambda p: trim(" + DECODE_SQL.format("p") + ", ' ' || chr(10) || chr(9) || chr(13) || chr(160))), lambda p: p <> ''), {1})"
)


@query(r"""
    SELECT page_id, CASE WHEN body = '' THEN NULL ELSE """ + NODES_SQL.format(TEXT_SQL.format("body"), "chr(10)") + r""" END AS full_text
    FROM (SELECT page_id, regexp_extract(html, '<article\b[^>]*>(.*)</article\s*>', 1, 'is') AS body FROM pages)""")
def extract_page_text(v):
    return v.table("pages").select("page_id", pages.page_text(F.col("html"), pages.GENERIC).alias("full_text"))


@query(r"""
    SELECT page_id, list_reduce(list_prepend('', list_transform(regexp_extract_all(html, '<p\b[^>]*>(.*?)</p\s*>', 1, 'is'),
      lambda s: """ + NODES_SQL.format("s", "chr(10)") + r""")), lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END) AS longest FROM pages""")
def longest_section(v):
    return v.table("pages").select(
        "page_id", F.coalesce(pages.longest_section(F.col("html"), r"(?is)<p\b[^>]*>(.*?)</p\s*>"), F.lit("")).alias("longest")
    )


LINKS_SQL = r"""
    SELECT page_id, position, href, title FROM (
      SELECT page_id, CAST(i - 1 AS BIGINT) AS position, """ + DECODE_SQL.format(
    r"""regexp_extract(a, '\bhref\s*=\s*["'']([^"'']*)["'']', 1, 'is')"""
) + r""" AS href,
        trim(regexp_replace(""" + NODES_SQL.format("a", "' '") + r""", '\s+', ' ', 'g')) AS title
      FROM (SELECT page_id, unnest(anchors) AS a, unnest(range(1, len(anchors) + 1)) AS i
        FROM (SELECT page_id, regexp_extract_all(html, '<a\b[^>]*>.*?</a\s*>', 0, 'is') AS anchors FROM pages)))
    WHERE contains(href, '/') AND length(title) >= 5"""


def _links(v):
    return pages.page_links(v.table("pages").withColumn("bank_code", F.lit("*")), pages.GENERIC)


@query(f"SELECT page_id, position, title, CASE WHEN href[1] = '/' THEN 'https://x' || href ELSE href END AS url FROM ({LINKS_SQL})")
def extract_page_links(v):
    return _links(v).select("page_id", "position", "title", "url")


@query("""
    SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'https://www.federalreserve.gov/newsevents/speech/barr20240105a.htm'
      WHEN 1 THEN 'https://www.ecb.europa.eu/press/key/date/2024/html/a.html'
      WHEN 2 THEN 'https://www.bankofengland.co.uk/speech/2024/january/a'
      WHEN 3 THEN 'https://www.boj.or.jp/en/about/press/koen_2024/ko240105a.htm'
      WHEN 4 THEN 'https://www.rba.gov.au/speeches/2024/sp-gov-2024-01-05.html'
      ELSE 'https://www.bankofcanada.ca/2024/01/a-talk/' END AS url,
      CASE page_id % 6 WHEN 1 THEN NULL WHEN 2 THEN '2024-01-01' WHEN 5 THEN '2024-01-09' ELSE '2024-01-05' END AS date,
      CASE page_id % 6 WHEN 5 THEN 'Remarks' ELSE 'speech' END AS speech_type, 'Title of talk ' || page_id AS title,
      CASE page_id % 6 WHEN 3 THEN 'Hana Mori' WHEN 4 THEN 'Ann Bee' WHEN 5 THEN 'Cy Dee' END AS speaker
    FROM pages""")
def extractor_rules(v):
    """List pages of the six layouts, one per given page, read by the per-bank rules."""
    t = F.concat(F.lit("Title of talk "), F.col("page_id").cast("string"))

    def html(*parts):
        return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])

    k = F.col("page_id") % 6
    listing = (
        F.when(k == 0, html('<a href="/">Home</a><p><a href="/newsevents/speech/barr20240105a.htm"><em>', t, "</em></a></p>",
                            '<a href="/newsevents/speech/x20240101a.htm">Speeches</a>'))
        .when(k == 1, html('<a href="https://www.ecb.europa.eu/press/key/date/2024/html/a.html">', t, "</a>",
                           '<a href="/press/pr/b.html">A press release</a>'))
        .when(k == 2, html('<a href="/speech/2024/january/a"><h3 class="list">', t, "</h3><p>more</p></a>",
                           '<a href="/news/speeches">All of the speeches</a>'))
        .when(k == 3, html("<table><tr><th>Date</th></tr><tr><td>Jan.&nbsp;5,&nbsp;2024</td>",
                           "<td>MORI Hana, Counsellor</td><td><a href='/en/about/press/koen_2024/ko240105a.htm'>", t,
                           "</a></td></tr><tr><td>x</td><td>y</td><td><a href='/en/koen_2024/index.htm'>Index</a></td></tr></table>"))
        .when(k == 4, html('<li><a href="/speeches/2024/sp-gov-2024-01-05.html">', t, '</a> <span class="author-name">Ann Bee</span></li>',
                           '<li><a href="/speeches/2024/sp-gov-2024-01-05.html">Audio</a></li>'))
        .otherwise(html('<div class="media"><h3><a href="/2023/01/outside-main/">Outside of the main part</a></h3><a>Remarks</a></div>',
                        '<main><div class="media"><h3><a href="/multimedia/a-webcast/">A webcast of a talk</a></h3><a>Webcasts</a></div>',
                        '<div class="media"><span class="media-date">January 9, 2024</span><h3><a href="/2024/01/a-talk/">', t,
                        '</a></h3><p>Remarks <a href="/profile/cy-dee/">Cy Dee</a></p><a>Press</a><a>Remarks</a></div></main>'))
    )
    bank = F.element_at(F.array(*[F.lit(r.bank_code) for r in pages.RULES]), (k + 1).cast("int"))
    listed = v.table("pages").select("page_id", bank.alias("bank_code"), listing.alias("html"))
    return pages.all_page_links(listed).select("page_id", "url", "date", "speech_type", "title", "speaker")


@query("""
    SELECT doc_id, CAST(doc_id % 4 IN (1, 3) AS BIGINT) AS keep,
      CASE doc_id % 4 WHEN 1 THEN 'Remarks' WHEN 2 THEN 'Lectures' WHEN 3 THEN 'Comments' ELSE 'speech' END AS primary_type
    FROM documents""")
def content_type_filter(v):
    k = F.col("doc_id") % 4
    labels = (
        F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(F.lit("Press"), F.lit("Remarks")))
        .when(k == 2, F.array(F.lit("Webcasts"), F.lit("Lectures"))).otherwise(F.array(F.lit("Comments"), F.lit("Remarks")))
    )
    return v.table("documents").select(
        "doc_id", pages.is_collectable(labels).alias("keep"), pages.primary_type(labels).alias("primary_type")
    )


@query("""
    SELECT event_id, CASE event_type WHEN 'view' THEN 'Remarks' WHEN 'click' THEN 'Lectures' WHEN 'error' THEN 'Comments' ELSE 'speech' END
      AS primary_type FROM events""")
def primary_type(v):
    kind = F.col("event_type")
    label = F.when(kind == "view", "Remarks").when(kind == "click", "Lectures").when(kind == "error", "Comments").otherwise("Press")
    labels = F.array(F.lit("Press"), label, F.when(kind == "view", F.lit("Lectures")).otherwise(F.lit("Webcasts")))
    return v.table("events").select("event_id", pages.primary_type(labels).alias("primary_type"))


@query("""
    SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'https://www.federalreserve.gov/newsevents/speech/a' || page_id || '.htm'
      WHEN 1 THEN 'dropped' WHEN 2 THEN 'dropped' WHEN 3 THEN 'dropped' ELSE 'dropped' END AS url FROM pages WHERE page_id % 5 = 0""")
def candidate_predicates(v):
    """Link and title rules of one bank over hrefs built from the pages."""
    k = F.col("page_id") % 5
    href = (
        F.when(k == 0, F.concat(F.lit("/newsevents/speech/a"), "page_id", F.lit(".htm"))).when(k == 1, F.lit("/newsevents/press/a.htm"))
        .otherwise(F.lit("/newsevents/speech/b.htm"))
    )
    title = F.when(k == 2, F.lit("short")).when(k == 3, F.lit("Speeches")).when(k == 4, F.lit("")).otherwise(
        F.concat(F.lit("A long enough title "), "page_id")
    )
    rule = pages.RULES[0]
    return v.table("pages").select("page_id", href.alias("href"), title.alias("title")).where(
        pages.is_candidate(F.col("href"), F.col("title"), rule)
    ).select("page_id", F.concat(F.lit(rule.base_url), "href").alias("url"))


# --- dataset and feed rows --------------------------------------------------------------


@query("""
    SELECT id, CASE WHEN id % 2 = 0 THEN title || ' - sub' ELSE title END AS title, CAST(date AS VARCHAR) AS date,
      'ecb://speeches/' || CAST(date AS VARCHAR) || '/' || substring(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), 1, 60) AS url,
      'sp' || speaker_id AS speaker, coalesce(full_text, '') AS full_text
    FROM (SELECT id, trim(title, ' ' || chr(10)) AS title, date, speaker_id, trim(full_text, ' ' || chr(10)) AS full_text FROM speeches_d WHERE id % 7 <> 0)
    """.replace("'sp' || speaker_id AS speaker", "coalesce('sp' || speaker_id, '') AS speaker"))
def scan_speech_csv(v):
    """Rows of the pipe dataset: fields made from the documents, every seventh date unreadable."""
    written = F.when(F.col("id") % 7 == 0, F.lit("soon")).when(
        F.col("id") % 3 == 0, F.date_format("date", "d MMMM yyyy")
    ).otherwise(F.date_format("date", "dd/MM/yyyy"))
    raw = v.speeches_d.select(
        "id", written.alias("date"), F.concat(F.lit("sp"), F.col("speaker_id").cast("string")).alias("speakers"), "title",
        F.when(F.col("id") % 2 == 0, F.lit(" sub ")).alias("subtitle"), F.col("full_text").alias("contents"),
    )
    rows = datasets.dataset_rows(raw.select("date", "speakers", "title", "subtitle", F.concat_ws("\u0002", F.col("id").cast("string"), F.col("contents")).alias("contents")))
    parts = F.split("full_text", "\u0002")
    return rows.select(
        F.element_at(parts, 1).cast("long").alias("id"), "title", "date", "url", "speaker",
        strip(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))).alias("full_text"),
    )


@query("""
    SELECT id, title, CAST(date AS VARCHAR) AS date, coalesce('sp' || speaker_id, '') AS speaker, coalesce(full_text, '') AS full_text
    FROM (SELECT id, trim(title, ' ' || chr(10)) AS title, date, speaker_id, trim(full_text, ' ' || chr(10)) AS full_text FROM speeches_d
      WHERE trim(title, ' ' || chr(10)) <> '')""")
def scan_speech_csv_file(v):
    """S2 from real files: the documents written as quoted records with their line breaks, and read in many splits."""
    def quoted(c):
        return F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))

    def plain(c):  # a field without quotes
        return F.coalesce(c.cast("string"), F.lit(""))

    body = F.concat(F.col("id").cast("string"), F.lit("\u0002"), F.coalesce("full_text", F.lit("")))
    line = F.concat_ws("|", F.date_format("date", "dd/MM/yyyy"), plain(F.concat(F.lit("sp"), F.col("speaker_id").cast("string"))),
                       quoted(F.col("title")), F.lit(""), quoted(body))
    path = work_folder(v.spark, "speech-csv")
    v.speeches_d.select(line.alias("value")).write.option("lineSep", "\n").text(path)
    # The files have no header line, so no record is left out.
    rows = datasets.csv_records(read_log(v.spark, path))
    options = {"sep": "|", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    raw = rows.select(F.from_csv("record", F.lit(datasets.CSV_COLUMNS), options).alias("r")).select("r.*")
    parts = F.split("full_text", "\u0002")
    return datasets.dataset_rows(raw).where("title <> ''").select(
        F.element_at(parts, 1).cast("long").alias("id"), "title", "date", "speaker",
        strip(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))).alias("full_text"))


@query("""
    SELECT event_id, 'https://e.eu/press/' || CASE event_id % 3 WHEN 0 THEN 'key' ELSE 'inter' END || '/' || event_id AS url,
      CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
      CASE event_id % 3 WHEN 0 THEN 'Person ' || user_id WHEN 1 THEN 'Ann ' || user_id END AS speaker
    FROM events WHERE event_id % 3 <> 2""")
def scan_feed_items(v):
    k = F.col("event_id") % 3
    items = v.table("events").select(
        F.concat(F.lit(" https://e.eu/press/"), F.when(k == 0, "key").when(k == 1, "inter").otherwise("pr"), F.lit("/"), "event_id")
        .alias("link"),
        F.when(k == 0, F.concat(F.lit("Money. Speech by Person "), "user_id", F.lit(", at a place")))
        .otherwise(F.concat(F.lit("Interview with Ann "), "user_id", F.lit(", a paper"))).alias("title"),
        F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0100")).alias("pubDate"),
    )
    return datasets.feed_rows(items).select(
        F.regexp_extract("url", r"(\d+)\z", 1).cast("long").alias("event_id"), "url", "date", "speaker"
    )


@query(SQL["scan_feed_items"])
def scan_feed_file(v):
    """S3 from real files of feed items."""
    k = F.col("event_id") % 3
    title = F.when(k == 0, F.concat(F.lit("Money. Speech by Person "), "user_id", F.lit(", at a place"))).otherwise(
        F.concat(F.lit("Interview with Ann "), "user_id", F.lit(", a paper")))
    kind = F.when(k == 0, "key").when(k == 1, "inter").otherwise("pr")
    path = work_folder(v.spark, "feed-files")
    v.table("events").select(
        title.alias("title"), F.concat(F.lit("https://e.eu/press/"), kind, F.lit("/"), F.col("event_id").cast("string")).alias("link"),
        F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0100")).alias("pubDate"),
    ).write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(path)
    return datasets.read_feed(v.spark, path).select(
        F.regexp_extract("url", r"(\d+)\z", 1).cast("long").alias("event_id"), "url", "date", "speaker")


@query("""
    SELECT url, src FROM (SELECT 'https://e/' || doc_id AS url, 'dataset' AS src FROM documents WHERE doc_id % 2 = 0
      UNION ALL SELECT 'https://e/' || doc_id, 'feed' FROM documents WHERE doc_id % 3 = 0 AND doc_id % 2 <> 0)""")
def feed_minus_dataset(v):
    docs = v.table("documents").select("doc_id", F.concat(F.lit("https://e/"), "doc_id").alias("url"))
    dataset = docs.where("doc_id % 2 = 0").select("url", F.lit("dataset").alias("src"))
    feed = docs.where("doc_id % 3 = 0").select("url", F.lit("feed").alias("src"))
    return datasets.dataset_and_feed(dataset, feed)


@query("""
    SELECT src, count(*) AS n, count(speaker) AS with_speaker FROM (
      SELECT 'page' AS src, speaker FROM candidates_p UNION ALL SELECT 'dataset', 'x' FROM documents
      UNION ALL SELECT 'feed', NULL FROM events) GROUP BY 1""")
def union_all_sources(v):
    page = v.candidates_p.select("title", "date", "url", "speaker", F.lit("page").alias("src"))
    dataset = v.speeches_d.select("title", "date", "url", F.lit("x").alias("speaker"), "full_text", F.lit("dataset").alias("src"))
    feed = v.table("events").select(F.col("event_type").alias("title"), F.col("ts").cast("date").alias("date"), F.lit("feed").alias("src"))
    return datasets.union_sources(page, dataset, feed).groupBy("src").agg(
        F.count(F.lit(1)).alias("n"), F.count("speaker").alias("with_speaker")
    )


@query(f"""
    SELECT bank_code, count(*) AS n FROM dated_d WHERE true_date <= DATE '{AS_OF_O}' + 9000 GROUP BY 1""")
def union_banks(v):
    """Per-bank frames in one relation."""
    rows = v.dated_d.where(F.col("true_date") <= F.date_add(as_date(AS_OF_O), 9000))
    frames = [rows.where(F.col("bank_code") == b) for b in ("BOE", "BOJ", "RBA", "FRB")]
    return datasets.union_sources(*frames).groupBy("bank_code").agg(F.count(F.lit(1)).alias("n"))
