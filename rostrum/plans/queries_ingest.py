"""Candidate intake, deduplication and repair."""

from pyspark.sql import functions as F

from rostrum.operators import ingest
from rostrum.operators.common import as_time
from rostrum.plans.registry import query
from rostrum.plans.queries_text import REPAIR_SQL
from rostrum.plans.views import AS_OF_D, NOW_D
from rostrum.session import materialize


@query("""
    SELECT url, CAST(min(position) AS BIGINT) AS position, arg_min(page_id, position) AS page_id
    FROM (SELECT page_id * 1000 + i AS position, page_id, url FROM (
      SELECT page_id, unnest(a) AS url, unnest(range(0, len(a))) AS i FROM (
        SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS a FROM pages))) GROUP BY 1""")
def dedupe_first(v):
    """Every link of the pages; the same navigation links recur on many pages."""
    return ingest.dedupe_first(_all_hrefs(v)).select("url", "position", "page_id")


def _all_hrefs(v):
    return v.table("pages").select(
        "page_id", F.posexplode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("p", "url")
    ).select("page_id", (F.col("page_id") * 1000 + F.col("p")).alias("position"), "url")


@query("""
    SELECT url, CAST(max(position) AS BIGINT) AS position, arg_max(page_id, position) AS page_id
    FROM (SELECT page_id * 1000 + i AS position, page_id, url FROM (
      SELECT page_id, unnest(a) AS url, unnest(range(0, len(a))) AS i FROM (
        SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS a FROM pages))) GROUP BY 1""")
def dedupe_last(v):
    return ingest.dedupe_last(_all_hrefs(v)).select("url", "position", "page_id")


@query("""
    SELECT position FROM (SELECT position, row_number() OVER (PARTITION BY lower(trim(title)), date
        ORDER BY CASE WHEN split_part(lower(url), '?', 1) LIKE '%.pdf' THEN 1 ELSE 0 END, position) AS rn
      FROM (SELECT position, date, url, replace(replace(title, ' (Summary)', ''), ' (Full Text)', '') AS title FROM candidates_p))
    WHERE rn = 1""")
def dedupe_prefer_html(v):
    bare = F.replace(F.replace("title", F.lit(" (Summary)"), F.lit("")), F.lit(" (Full Text)"), F.lit(""))
    return ingest.dedupe_prefer_html(v.candidates_p.withColumn("title", bare)).select("position")


@query("""
    SELECT position FROM (SELECT position, row_number() OVER (PARTITION BY
        lower(trim(replace(replace(title, ' (Summary)', ''), ' (Full Text)', ''))), date
        ORDER BY CASE WHEN lower(title) LIKE '%full text%' OR split_part(lower(url), '?', 1) NOT LIKE '%.pdf' THEN 0 ELSE 1 END,
          position) AS rn FROM candidates_p) WHERE rn = 1""")
def dedupe_prefer_full(v):
    return ingest.dedupe_prefer_full(v.candidates_p).select("position")


@query("SELECT position, CAST(date AS VARCHAR) AS date FROM candidates_p ORDER BY 2 DESC")
def sort_date_desc(v):
    return ingest.newest_first(v.candidates_p).select("position", "date")


NORM = "split_part(regexp_replace(regexp_replace(lower(trim({0})), '/$', ''), '^http://', 'https://'), '?', 1)"


@query(f"""
    SELECT position FROM candidates_p c WHERE NOT EXISTS (SELECT 1 FROM known_p k
      WHERE k.bank_code = c.bank_code AND {NORM.format('k.url')} = {NORM.format('c.url')})""")
def new_by_url(v):
    return ingest.new_by_url(v.candidates_p, v.known_p).select("position")


@query("""
    SELECT position FROM candidates_p c WHERE NOT EXISTS (SELECT 1 FROM known_p k
      WHERE k.bank_code = c.bank_code AND trim(k.title) = trim(c.title) AND k.date = c.date)""")
def new_by_logical_key(v):
    return ingest.new_by_logical_key(v.candidates_p, v.known_p).select("position")


INSERTED_SQL = f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bank_code, trim(title), date ORDER BY position) AS rn2 FROM (
      SELECT c.*, row_number() OVER (PARTITION BY c.bank_code, {NORM.format('c.url')} ORDER BY position) AS rn
      FROM candidates_p c WHERE NOT EXISTS (SELECT 1 FROM known_p k
        WHERE k.bank_code = c.bank_code AND {NORM.format('k.url')} = {NORM.format('c.url')})
      AND NOT EXISTS (SELECT 1 FROM known_p k
        WHERE k.bank_code = c.bank_code AND trim(k.title) = trim(c.title) AND k.date = c.date)) WHERE rn = 1)
    WHERE rn2 = 1"""


def _intake(v):
    no_members = v.members_d.where(F.lit(False))
    selected = materialize(ingest.select_new(v.candidates_p, v.known_p), "selected")
    return ingest.enter_selected(selected, v.known_p, no_members, as_time(NOW_D))


@query(f"""
    SELECT url, bank_code, title, CAST(date AS VARCHAR) AS date, CAST(speaker IS NOT NULL AS BIGINT) AS has_speaker
    FROM ({INSERTED_SQL}) UNION ALL SELECT url, bank_code, title, CAST(date AS VARCHAR), 0 FROM known_p""")
def insert_new_speeches(v):
    result = _intake(v)
    return result.speeches.select(
        "url", "bank_code", "title", "date", F.col("speaker_id").isNotNull().alias("has_speaker")
    )


@query(f"""
    SELECT bank_code, speaker AS name, CAST(max(date) AS VARCHAR) AS last_speech_date FROM ({INSERTED_SQL})
    WHERE speaker IS NOT NULL GROUP BY 1, 2""")
def last_speech_max(v):
    """Members created by an intake, with their latest speech."""
    return _intake(v).members.select("bank_code", "name", "last_speech_date")


INCOMPLETE_SQL = """(full_text IS NULL OR length(full_text) < 500 OR full_text ILIKE '%to be published%')
      AND date BETWEEN DATE '2024-01-31' - 30 AND DATE '2024-01-31'"""


@query(f"SELECT id, bank_code FROM speeches_d WHERE {INCOMPLETE_SQL}")
def incomplete_speeches(v):
    return v.speeches_d.where(ingest.is_incomplete(AS_OF_D)).select("id", "bank_code")


@query("SELECT id FROM speeches_d WHERE (full_text IS NULL OR length(full_text) < 500) AND bank_code IN ('en', 'fr')")
def backfill_candidates(v):
    return v.speeches_d.where(ingest.needs_backfill(("en", "fr"))).select("id")


def _fetched(v):
    body = F.concat(F.lit("__DATE__:2024-01-15\n"), F.repeat(F.lit("word "), (F.col("doc_id") % 3 * 60 + 20).cast("int")))
    return v.table("documents").select(F.concat(F.lit("https://x/d/"), "doc_id").alias("url"), body.alias("full_text"))


@query(f"""
    SELECT id, CASE WHEN hit THEN '2024-01-15' ELSE CAST(date AS VARCHAR) END AS date,
      CAST(CASE WHEN hit THEN length(trim(repeat('word ', CAST(id % 3 * 60 + 20 AS INTEGER)))) ELSE length(full_text) END AS BIGINT) AS chars,
      CAST(CASE WHEN hit THEN FALSE ELSE synced_at IS NOT NULL END AS BIGINT) AS synced
    FROM (SELECT *, coalesce({INCOMPLETE_SQL} AND (id % 3 * 60 + 20) * 5 - 1 > 500, FALSE) AS hit FROM speeches_d)""")
def refresh_text(v):
    out = ingest.refresh_text(v.speeches_d, _fetched(v), AS_OF_D)
    return out.select("id", "date", F.length("full_text").alias("chars"), F.col("synced_at").isNotNull().alias("synced"))


@query("""
    SELECT id, CAST(CASE WHEN (full_text IS NULL OR length(full_text) < 500) AND bank_code IN ('en', 'fr')
        AND id % 3 = 2 THEN 20 + (id % 3 * 60 + 20) * 5 ELSE length(full_text) END AS BIGINT) AS chars FROM speeches_d""")
def backfill_text(v):
    out = ingest.backfill_text(v.speeches_d, _fetched(v), ("en", "fr"))
    return out.select("id", F.length("full_text").alias("chars"))


def _listed(v):
    """What the list pages say now about the stored pages: some fields changed."""
    known = v.stored_p
    return known.select(
        "url", F.when(F.col("id") % 4 == 0, F.concat("title", F.lit("!"))).otherwise(F.col("title")).alias("title"),
        F.when(F.col("id") % 5 == 0, F.date_add("date", 1)).otherwise(F.col("date")).alias("date"),
        "speech_type", F.when(F.col("id") % 7 == 0, F.lit("Ann Bee")).alias("speaker"),
    )


@query("""
    SELECT id, CAST(id % 4 = 0 OR id % 5 = 0 OR id % 7 = 0 AS BIGINT) AS metadata_changed,
      CAST(id % 2 = 0 AS BIGINT) AS dirty_text FROM stored_p WHERE id % 2 = 0 OR id % 4 = 0 OR id % 5 = 0 OR id % 7 = 0""")
def detect_changes(v):
    no_members = v.members_d.where(F.lit(False))
    return ingest.detect_changes(v.stored_p, no_members, _listed(v)).select("id", "metadata_changed", "dirty_text")


@query("""
    SELECT id, CASE WHEN id % 4 = 0 THEN title || '!' ELSE title END AS title,
      CAST(CASE WHEN id % 5 = 0 THEN date + 1 ELSE date END AS VARCHAR) AS date,
      CASE WHEN id % 2 = 0 THEN 'new text' ELSE full_text END AS full_text, CAST(id % 7 = 0 AS BIGINT) AS has_speaker,
      CAST(NOT (id % 2 = 0 OR id % 4 = 0 OR id % 5 = 0 OR id % 7 = 0) AS BIGINT) AS synced FROM stored_p""")
def refresh_changed(v):
    no_members = v.members_d.where(F.lit(False))
    fetched = v.stored_p.where("id % 2 = 0").select("url", F.lit("new text").alias("full_text"))
    out, _ = ingest.refresh_changed(v.stored_p, no_members, _listed(v), fetched, as_time(NOW_D))
    return out.select(
        "id", "title", "date", "full_text", F.col("speaker_id").isNotNull().alias("has_speaker"),
        F.col("synced_at").isNotNull().alias("synced"),
    )


@query("""
    SELECT id, CASE WHEN bank_code = 'en' AND date >= DATE '2024-01-01' AND speech_type = 'speech' AND id % 4 <> 0
      THEN 'non_speech' ELSE speech_type END AS speech_type FROM speeches_d""")
def unlisted_to_nonspeech(v):
    listed = v.speeches_d.where("id % 4 = 0").select("bank_code", "url")
    return ingest.mark_unlisted(v.speeches_d, listed, "en", 2024).select("id", "speech_type")


@query(f"SELECT r.id, r.date, CAST(r.date IS DISTINCT FROM d.date AS BIGINT) AS changed FROM ({REPAIR_SQL}) r JOIN dated_d d ON r.id = d.id")
def repair_dates(v):
    old = v.dated_d.select("id", "bank_code", "date", "url", "full_text", as_time(NOW_D).alias("synced_at"))
    return ingest.repair_dates(old).select("id", "date", F.col("synced_at").isNull().alias("changed"))


GROUP = "bank_code, title, speaker_id, date"


@query(f"""
    SELECT bank_code, title, speaker_id, CAST(date AS VARCHAR) AS date, count(*) AS copies,
      arg_min(id, length(coalesce(full_text, '')) * -1000000000 + id) AS keep_id
    FROM speeches_d GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""")
def duplicate_groups(v):
    return ingest.duplicate_groups(v.speeches_d)


KEEP_SQL = f"""SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY {GROUP}
      ORDER BY length(coalesce(full_text, '')) DESC, id) AS rn FROM speeches_d) WHERE rn = 1"""


@query(KEEP_SQL)
def keep_longest(v):
    return ingest.drop_duplicates_keep_longest(v.speeches_d).select("id")


@query(f"SELECT id, bank_code, CAST(date AS VARCHAR) AS date FROM speeches_d WHERE id NOT IN ({KEEP_SQL})")
def drop_duplicates_keep_longest(v):
    """The copies that are removed, one row each."""
    return ingest.duplicate_ids(v.speeches_d)

