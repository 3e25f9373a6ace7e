"""Score queue and search."""

from pyspark.sql import functions as F

from rostrum.operators import queue, search
from rostrum.operators.common import as_time
from rostrum.plans.registry import SQL, query
from rostrum.plans.views import NOW_D
from rostrum.session import work_folder
from rostrum.sinks import postings

OPEN_SQL = "coalesce(analysis_status, 'pending') = 'pending'"
JOINED = "speeches_d s LEFT JOIN (SELECT * EXCLUDE (synced_at) FROM analysis_d) a ON s.id = a.speech_id"
QUEUE_SQL = f"""SELECT s.id, s.bank_code, s.date, s.full_text, s.speaker_id FROM {JOINED}
    WHERE length(full_text) > 500 AND {OPEN_SQL} AND coalesce(analysis_attempts, 0) < 3"""


@query(f"SELECT q.id, q.bank_code, coalesce(m.name, 'Unknown') AS speaker FROM ({QUEUE_SQL}) q LEFT JOIN members_d m ON q.speaker_id = m.id")
def pending_queue(v):
    return queue.pending_queue(v.speeches_d, v.analysis_d, v.members_d).select("id", "bank_code", "speaker")


@query(f"SELECT id FROM ({QUEUE_SQL}) ORDER BY date DESC, id LIMIT 50")
def pending_queue_limited(v):
    return queue.pending_queue(v.speeches_d, v.analysis_d, v.members_d, limit=50).select("id")


TIER_SQL = f"""SELECT id, date, CASE WHEN coalesce(analysis_attempts, 0) = 0 THEN 0
      WHEN coalesce(keywords, '[]') = '[]' AND analysis_attempts BETWEEN 1 AND 5 THEN 1 END AS tier
    FROM {JOINED} WHERE length(full_text) > 500"""


@query(f"SELECT id, CAST(tier AS BIGINT) AS tier FROM ({TIER_SQL}) WHERE tier IS NOT NULL AND date >= DATE '2024-01-01'")
def untried_then_failed(v):
    return queue.untried_then_failed(v.speeches_d, v.analysis_d, since_year=2024).select("id", "tier")


@query(f"SELECT id, CAST(tier AS BIGINT) AS tier FROM ({TIER_SQL}) WHERE tier IS NOT NULL ORDER BY tier, date DESC, id LIMIT 1")
def top1_queue(v):
    return queue.untried_then_failed(v.speeches_d, v.analysis_d, limit=1).select("id", "tier")


@query(f"""
    SELECT s.id, s.title FROM {JOINED} JOIN members_d m ON s.speaker_id = m.id
    WHERE m.name = 'Supplier#000000007' AND length(full_text) > 1000 AND stance_score IS NULL""")
def unscored_of_speaker(v):
    return queue.unscored_of_speaker(v.speeches_d, v.analysis_d, v.members_d, "Supplier#000000007").select("id", "title")


SKIP_SQL = f"""SELECT s.id AS speech_id, CASE WHEN full_text IS NULL THEN 'Skipped: Missing full text.'
      ELSE 'Skipped: Text too short for meaningful analysis (<= 500 chars).' END AS reason
    FROM {JOINED} WHERE (full_text IS NULL OR length(full_text) <= 500) AND {OPEN_SQL}"""


@query(SKIP_SQL)
def short_text(v):
    return queue.skippable(v.speeches_d, v.analysis_d)


@query(f"""
    SELECT coalesce(a.speech_id, k.speech_id) AS speech_id, CASE WHEN reason IS NOT NULL THEN 'skipped' ELSE analysis_status END AS analysis_status,
      CAST(CASE WHEN reason IS NOT NULL THEN 1 ELSE analysis_attempts END AS BIGINT) AS analysis_attempts,
      coalesce(reason, stance_reason) AS stance_reason, CASE WHEN reason IS NOT NULL THEN '[]' ELSE keywords END AS keywords
    FROM analysis_d a FULL OUTER JOIN ({SKIP_SQL}) k ON a.speech_id = k.speech_id""")
def mark_skipped(v):
    return queue.mark_skipped(v.speeches_d, v.analysis_d).select(
        "speech_id", "analysis_status", "analysis_attempts", "stance_reason", "keywords"
    )


READY_SQL = "speech_id IN (SELECT id FROM speeches_d WHERE length(full_text) > 500) AND analysis_status = 'skipped'"


@query(f"SELECT speech_id FROM analysis_d WHERE {READY_SQL}")
def semi_has_text(v):
    return queue.has_text_now(v.analysis_d, v.speeches_d).select("speech_id")


@query(f"""
    SELECT speech_id, CASE WHEN hit THEN 'pending' ELSE analysis_status END AS analysis_status,
      CAST(CASE WHEN hit THEN 0 ELSE analysis_attempts END AS BIGINT) AS analysis_attempts,
      CASE WHEN NOT hit THEN stance_reason END AS stance_reason, CASE WHEN NOT hit THEN keywords END AS keywords,
      CAST(NOT hit AND synced_at IS NOT NULL AS BIGINT) AS synced FROM (SELECT *, {READY_SQL} AS hit FROM analysis_d)""")
def revive_skipped(v):
    return queue.revive_skipped(v.analysis_d, v.speeches_d).select(
        "speech_id", "analysis_status", "analysis_attempts", "stance_reason", "keywords",
        F.col("synced_at").isNotNull().alias("synced"),
    )


def _responses(v):
    """Responses to the queue: scores, no-signal answers, failures."""
    due = queue.pending_queue(v.speeches_d, v.analysis_d, v.members_d)
    k = F.col("id") % 4
    return due.select(
        F.col("id").alias("speech_id"),
        F.when(k == 0, F.lit('{"stance_score": 0.72, "stance_reason": "r", "keywords": [], "main_risk": "m"}'))
        .when(k == 1, F.lit('{"stance_score": null, "stance_reason": "none", "keywords": []}'))
        .when(k == 2, F.lit("oops")).alias("response"),
    )


@query(f"""
    SELECT coalesce(a.speech_id, q.id) AS speech_id,
      CASE WHEN q.id % 4 = 0 THEN 0.7 WHEN q.id % 4 = 1 THEN NULL ELSE stance_score END AS stance_score,
      CASE WHEN q.id % 4 = 0 THEN 'scored' WHEN q.id % 4 = 1 THEN 'no_signal' WHEN q.id IS NOT NULL THEN coalesce(analysis_status, 'pending')
        ELSE analysis_status END AS analysis_status,
      CAST(coalesce(analysis_attempts, 0) + CASE WHEN q.id IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS analysis_attempts,
      CASE WHEN q.id % 4 = 0 THEN 'r' WHEN q.id % 4 = 1 THEN 'none' ELSE stance_reason END AS stance_reason
    FROM analysis_d a FULL OUTER JOIN ({QUEUE_SQL}) q ON a.speech_id = q.id""")
def apply_scores(v):
    out, _ = queue.apply_scores(v.speeches_d, v.analysis_d, _responses(v), as_time(NOW_D))
    return out.select("speech_id", "stance_score", "analysis_status", "analysis_attempts", "stance_reason")


@query(f"""
    SELECT s.id, CAST(synced_at IS NOT NULL AND coalesce(q.id % 4, 9) NOT IN (0, 1) AS BIGINT) AS synced
    FROM speeches_d s LEFT JOIN ({QUEUE_SQL}) q ON s.id = q.id""")
def scores_clear_sync(v):
    _, out = queue.apply_scores(v.speeches_d, v.analysis_d, _responses(v), as_time(NOW_D))
    return out.select("id", F.col("synced_at").isNotNull().alias("synced"))


@query(f"""
    SELECT id AS speech_id, round(((length(doc) - length(replace(doc, 'a', ''))) % 21 - 10) / 10.0, 6) + 0.0 AS stance_score
    FROM (SELECT q.id, 'Date: ' || q.date || chr(10) || 'Speaker: ' || coalesce(m.name, 'Unknown') || chr(10) || chr(10)
      || 'Speech Text:' || chr(10) || full_text || chr(10) AS doc FROM ({QUEUE_SQL}) q LEFT JOIN members_d m ON q.speaker_id = m.id)""")
def score_batch(v):
    """A user's scorer over the whole queue."""
    import json

    from rostrum.functions import scoring

    def count_letters(inputs):
        def answer(text):
            score = (text.count("a") % 21 - 10) / 10
            return json.dumps({"stance_score": score, "stance_reason": "a", "keywords": []})

        return inputs.map(answer)

    due = queue.pending_queue(v.speeches_d, v.analysis_d, v.members_d)
    out = queue.score_batch(due, count_letters)
    return out.select("speech_id", scoring.parse_result(F.col("response"))["stance_score"].alias("stance_score"))


@query("SELECT json_extract_string(keywords, '$[0].category') AS category, count(*) AS n FROM analysis_d WHERE keywords <> '[]' GROUP BY 1")
def keyword_counts(v):
    return queue.keyword_counts(v.analysis_d)


STATS_SQL = """SELECT bank_code, count(*) AS total, count(*) FILTER (WHERE analysis_status IN ('scored', 'no_signal')) AS analyzed
    FROM speeches_d s LEFT JOIN analysis_d a ON s.id = a.speech_id"""


@query(f"{STATS_SQL} GROUP BY 1")
def bank_stats(v):
    out = queue.bank_stats(v.speeches_d, v.analysis_d)
    return out.where(F.col("is_total") == 0).select("bank_code", "total", "analyzed")


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE analysis_status IN ('scored', 'no_signal')) AS analyzed
    FROM speeches_d s LEFT JOIN analysis_d a ON s.id = a.speech_id""")
def grand_total(v):
    return queue.bank_stats(v.speeches_d, v.analysis_d).where(F.col("is_total") == 1).select("total", "analyzed")


@query("SELECT DISTINCT speaker_id FROM speeches_d JOIN analysis_d ON id = speech_id WHERE stance_score IS NOT NULL AND speaker_id IS NOT NULL")
def distinct_scored_members(v):
    return queue.scored_members(v.speeches_d, v.analysis_d)


@query("SELECT DISTINCT bank_code FROM speeches_o")
def distinct_values(v):
    return queue.banks(v.speeches_o)


# --- search -----------------------------------------------------------------------------

TOKENS_SQL = r"""SELECT id, list_filter(regexp_split_to_array(lower(strip_accents(concat_ws(chr(10), title, full_text))), '[^\p{L}\p{N}]+'),
      lambda w: w <> '') AS words FROM speeches_d"""


@query(f"SELECT term, id, count(*) AS tf FROM (SELECT id, unnest(words) AS term FROM ({TOKENS_SQL})) GROUP BY 1, 2")
def build_term_index(v):
    return search.build_term_index(v.speeches_d)


def _bm25(terms, score="round({0}, 6)"):
    tf = {t: f"len(list_filter(words, lambda w: w = '{t}'))" for t in terms}
    counted = ", ".join(f"{tf[t]} AS tf{i}" for i, t in enumerate(terms))
    parts = " + ".join(
        f"(SELECT CASE WHEN ln((count(*) - count(*) FILTER (WHERE tf{i} > 0) + 0.5) / (count(*) FILTER (WHERE tf{i} > 0) + 0.5)) > 0 "
        f"THEN ln((count(*) - count(*) FILTER (WHERE tf{i} > 0) + 0.5) / (count(*) FILTER (WHERE tf{i} > 0) + 0.5)) ELSE 1e-6 END FROM c)"
        f" * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * n / (SELECT avg(n) FROM c)))"
        for i in range(len(terms))
    )
    where = " AND ".join(f"tf{i} > 0" for i in range(len(terms)))
    return (
        f"WITH c AS (SELECT id, len(words) AS n, {counted} FROM ({TOKENS_SQL})) "
        f"SELECT id, {score.format(parts)} AS score FROM c WHERE {where}"
    )


@query(_bm25(["ou", "une"]))
def keyword_search(v):
    return search.search(v.speeches_d, "Une où")


@query(_bm25(["ou", "une"]))
def keyword_search_index(v):
    index, lengths = search.build_term_index(v.speeches_d), search.document_lengths(v.speeches_d)
    return search.search_index(index, lengths, "Une où")


@query(f"SELECT id FROM ({_bm25(['the'], '{0}')}) ORDER BY score DESC, id LIMIT 20")
def rank_matches(v):
    return search.search(v.speeches_d, "the", limit=20).select("id")


def _stored_index(v):
    """Two batches, as they arrive."""
    root = work_folder(v.spark, "term-index")
    postings.store_index(v.speeches_d.where("id % 2 = 0"), root)
    postings.store_index(v.speeches_d.where("id % 2 = 1"), root, 1)
    return root


@query(SQL["keyword_search"])
def keyword_search_stored(v):
    """J13 over stored postings in folders by term."""
    return postings.search_stored(v.spark, _stored_index(v), "Une où")


@query(SQL["rank_matches"])
def rank_matches_stored(v):
    """R7 over stored postings: blocks that can't reach the best are left out."""
    return postings.search_stored(v.spark, _stored_index(v), "the", limit=20).select("id")
