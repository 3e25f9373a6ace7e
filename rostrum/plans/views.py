"""Mapping of the driver's tables onto the data model.

The only place that knows both vocabularies: each view exists as a DataFrame and as SQL
with the same rows. Everything is derived from the given tables and grows with them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import logs
from rostrum.plans import derive
from rostrum.session import materialize
from rostrum.sources.tables import spread

AS_OF_O = "2001-08-01"
AS_OF_D = "2024-01-31"
NOW_O = "2001-08-01 12:00:00"
NOW_D = "2024-01-31 12:00:00"
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id"}
JOB_KEYS = [job[0] for job in logs.JOBS]


class Views:
    """The mapping views over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            self._tables[name] = spread(df, TEXT_TABLES[name]) if name in TEXT_TABLES else df
        return self._tables[name]

    def _banked_customers(self) -> DataFrame:
        return self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select("c_custkey", "c_name", F.col("n_name").alias("bank_code"))

    @cached_property
    def speeches_o(self) -> DataFrame:
        key = F.col("o_orderkey")
        joined = self.table("orders").join(self._banked_customers(), F.col("o_custkey") == F.col("c_custkey"))
        return joined.select(
            key.alias("id"), "bank_code", F.col("o_custkey").alias("speaker_id"), F.col("o_orderpriority").alias("title"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.concat(F.lit("https://x/"), key.cast("string")).alias("url"),
            F.lit(None).cast("string").alias("full_text"), F.lit("speech").alias("speech_type"),
            F.lit("en").alias("language"),
            derive.plus_days("o_orderdate", "o_orderkey % 5").alias("fetched_at"),
            derive.plus_days("o_orderdate", "o_orderkey % 6").alias("created_at"),
            F.when(key % 3 != 0, F.lit("2001-07-01 00:00:00")).cast("timestamp_ntz").alias("synced_at"),
        )

    @cached_property
    def analysis_o(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS speech_id",
            "CASE WHEN o_orderstatus = 'P' OR o_orderkey % 11 = 0 THEN NULL ELSE "
            "greatest(least(round((o_totalprice - 250000) / 250000, 1), 1.0D), -1.0D) END AS stance_score",
            "concat('reason ', o_orderkey) AS stance_reason",
            "concat('[{\"category\": \"', o_orderpriority, '\", \"detail\": \"d', o_custkey % 10, '\"}]') AS keywords",
            "CASE WHEN o_orderkey % 2 = 0 THEN 'inflation' END AS main_risk",
            "cast(o_orderkey % 4 AS int) AS analysis_attempts",
            "CASE WHEN o_orderkey % 13 = 0 THEN 'pending' WHEN o_orderstatus = 'P' THEN 'no_signal' "
            "ELSE 'scored' END AS analysis_status",
            "o_orderdate + make_dt_interval(cast(o_orderkey % 9 AS int)) AS analyzed_at",
            "CASE WHEN o_orderkey % 4 <> 0 THEN timestamp_ntz'2001-07-01 00:00:00' END AS synced_at",
        )

    @cached_property
    def members_o(self) -> DataFrame:
        last = self.table("orders").groupBy("o_custkey").agg(F.max(F.col("o_orderdate").cast("date")).alias("last"))
        return self._banked_customers().join(last, F.col("c_custkey") == F.col("o_custkey"), "left").selectExpr(
            "c_custkey AS id", "bank_code", "c_name AS name",
            "CASE c_custkey % 4 WHEN 0 THEN 'Governor' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'Chair' END AS role",
            "CASE WHEN c_custkey % 3 = 0 THEN 'retired' ELSE 'active' END AS status",
            "CAST(NULL AS date) AS term_start",
            "CASE WHEN c_custkey % 6 = 0 THEN date'2001-01-01' END AS term_end",
            "last AS last_speech_date", "CAST(NULL AS date) AS last_verified_at",
            "timestamp_ntz'2001-07-01 00:00:00' + make_dt_interval(cast(c_custkey % 50 AS int)) AS last_updated",
            "CAST(NULL AS double) AS avg_stance_score",
            "CASE WHEN c_custkey % 4 <> 0 THEN timestamp_ntz'2001-07-20 00:00:00' END AS synced_at",
        )

    @cached_property
    def events_o(self) -> DataFrame:
        from rostrum.operators.common import as_time
        from rostrum.operators.marts import events_mart

        return events_mart(self.speeches_o, self.analysis_o, self.members_o, as_time(NOW_O))

    @cached_property
    def events_at_rest(self) -> DataFrame:
        """The event rows as a written table, for jobs that read them more than once."""
        return materialize(self.events_o, "events")

    @cached_property
    def rates_l(self) -> DataFrame:
        shipped = self.table("lineitem").groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("date")).agg(
            F.sum("l_extendedprice").alias("total"), F.count("l_extendedprice").alias("n")
        )
        where = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return shipped.join(where, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(
            "date", F.col("n_name").alias("bank_code")
        ).agg((F.sum("total") / F.sum("n")).alias("rate"))

    @cached_property
    def speeches_d(self) -> DataFrame:
        return self.table("documents").selectExpr(
            "doc_id AS id", "lang AS bank_code",
            "CASE WHEN n_chars % 10 <> 0 THEN n_chars % 120 END AS speaker_id",
            "substring(split_part(text, '\n', 1), 1, 60) AS title",
            "date_sub(date'2024-01-31', cast(n_chars % 60 AS int)) AS date",
            "concat('https://x/d/', doc_id) AS url",
            "CASE WHEN doc_id % 25 <> 0 THEN text END AS full_text",
            "CASE WHEN doc_id % 5 = 0 THEN 'Remarks' ELSE 'speech' END AS speech_type", "'en' AS language",
            "timestamp_ntz'2024-01-31 00:00:00' AS fetched_at", "timestamp_ntz'2024-01-31 00:00:00' AS created_at",
            "CASE WHEN doc_id % 2 = 0 THEN timestamp_ntz'2024-01-30 00:00:00' END AS synced_at",
        )

    @cached_property
    def analysis_d(self) -> DataFrame:
        return self.table("labels").selectExpr(
            "doc_id AS speech_id", "CASE WHEN quality = 1 AND doc_id % 5 <> 0 THEN 0.5D END AS stance_score",
            "'because' AS stance_reason",
            "CASE WHEN doc_id % 2 = 0 THEN '[]' ELSE '[{\"category\": \"Inflation\", \"detail\": \"x\"}]' END AS keywords",
            "CAST(NULL AS string) AS main_risk", "cast(doc_id % 7 AS int) AS analysis_attempts",
            "CASE WHEN doc_id % 3 = 0 THEN 'pending' WHEN doc_id % 3 = 1 THEN 'skipped' WHEN quality = 1 THEN 'scored' "
            "ELSE 'no_signal' END AS analysis_status",
            "timestamp_ntz'2024-01-20 00:00:00' AS analyzed_at",
            "CASE WHEN doc_id % 4 = 0 THEN timestamp_ntz'2024-01-25 00:00:00' END AS synced_at",
        )

    @cached_property
    def members_d(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS id", "element_at(array('en', 'fr', 'de', 'es'), cast(s_suppkey % 4 + 1 AS int)) AS bank_code",
            "s_name AS name", "CAST(NULL AS string) AS role",
            "CASE WHEN s_suppkey % 5 = 0 THEN 'retired' ELSE 'active' END AS status",
            "CAST(NULL AS date) AS term_start", "CAST(NULL AS date) AS term_end",
            "date_sub(date'2024-01-31', cast(s_suppkey * 17 % 700 AS int)) AS last_speech_date",
            "CAST(NULL AS date) AS last_verified_at", "timestamp_ntz'2024-01-01 00:00:00' AS last_updated",
            "CAST(NULL AS double) AS avg_stance_score", "CAST(NULL AS timestamp_ntz) AS synced_at",
        )

    @cached_property
    def roster_d(self) -> DataFrame:
        """Two-word 'names' taken from the documents themselves."""
        return self.table("documents").where("doc_id % 40 = 3").selectExpr(
            "lang AS bank_code", "doc_id AS position", "array_join(slice(split(text, '[ \n]'), 1, 2), ' ') AS name"
        )

    @cached_property
    def candidates_p(self) -> DataFrame:
        """Three listed variants of every page."""
        return self.table("pages").selectExpr(
            "page_id", "regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS bank_code", "url AS page_url",
            "regexp_extract(html, '<title>([^<]*)</title>', 1) AS page_title", "explode(array(0, 1, 2)) AS k"
        ).selectExpr(
            "page_id", "bank_code", "page_id * 3 + k AS position",
            "CASE k WHEN 0 THEN concat(page_title, ' (Summary)') WHEN 1 THEN concat('  ', replace(page_title, 'e', 'E'), ' ') "
            "ELSE concat(page_title, ' (Full Text)') END AS title",
            "date_add(date'2024-01-01', cast(page_id % 30 AS int)) AS date",
            "CASE k WHEN 0 THEN concat(page_url, '.pdf') WHEN 1 THEN upper(page_url) ELSE concat(page_url, '/x.PDF?v=2') "
            "END AS url",
            "CASE WHEN page_id % 4 <> 0 THEN concat('Person ', page_id % 20) END AS speaker",
            "concat('text of ', page_id) AS full_text", "'speech' AS speech_type",
        )

    @cached_property
    def known_p(self) -> DataFrame:
        """Already stored speeches for the candidates: every third page, the others being new."""
        return self.stored_p.where("id % 3 = 0")

    @cached_property
    def stored_p(self) -> DataFrame:
        """All pages as stored speeches."""
        return self.table("pages").selectExpr(
            "page_id AS id", "regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS bank_code",
            "CAST(NULL AS bigint) AS speaker_id",
            "CASE WHEN page_id % 2 = 0 THEN concat(' ', regexp_extract(html, '<title>([^<]*)</title>', 1), ' (Summary) ') "
            "ELSE 'other' END AS title",
            "date_add(date'2024-01-01', cast(page_id % 30 AS int)) AS date", "url",
            "CASE WHEN page_id % 2 = 0 THEN 'Share this page' ELSE 'clean' END AS full_text", "'speech' AS speech_type",
            "'en' AS language", "timestamp_ntz'2024-01-01 00:00:00' AS fetched_at",
            "timestamp_ntz'2024-01-01 00:00:00' AS created_at", "timestamp_ntz'2024-01-02 00:00:00' AS synced_at",
        )

    @cached_property
    def runlog_e(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS id", "concat('run', user_id) AS run_id", "event_type AS stage_name", "ts AS started_at",
            "CASE WHEN event_id % 9 <> 0 THEN ts + make_dt_interval(0, 0, 0, cast(value AS decimal(18, 6))) END "
            "AS finished_at",
            "CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'partial' WHEN 'click' THEN 'running' "
            "WHEN 'view' THEN 'success' ELSE 'skipped' END AS status",
            "cast(get_json_object(props, '$.k') AS bigint) AS item_count", "CAST(NULL AS string) AS error_message",
            "CASE WHEN event_id % 10 = 0 THEN concat('bad ', event_id) ELSE props END AS details_json",
        )

    @cached_property
    def status_e(self) -> DataFrame:
        """Status events: a third of all rows belong to one bank."""
        return self.table("events").selectExpr(
            "event_id", "CASE WHEN user_id % 3 = 0 THEN 'B0' ELSE concat('B', user_id % 6) END AS bank_code",
            "event_type AS stage",
            "CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'partial' WHEN 'click' THEN 'running' "
            "WHEN 'view' THEN 'success' ELSE 'skipped' END AS state", "ts AS event_at",
        )

    @cached_property
    def log_fields_e(self) -> DataFrame:
        """Fields of one log line per event; about a third of the lines are in one file."""
        jobs = ", ".join(f"'{j}'" for j in JOB_KEYS)
        return spread(self.table("events"), "event_id").selectExpr(
            "event_id", "ts", "event_type", "value", "cast(get_json_object(props, '$.k') AS int) AS k",
            "CASE WHEN user_id < 50 THEN 'app_0' ELSE concat('app_', user_id) END AS source",
            "event_id div 1000 AS block", "event_id AS seq",
        ).selectExpr(
            "*",
            "CASE WHEN event_type <> 'error' THEN 'INFO' WHEN k % 2 = 0 THEN 'ERROR' ELSE 'WARNING' END AS level",
            "CASE event_type WHEN 'signup' THEN 'Starting sync run' WHEN 'purchase' THEN 'Finished sync run' "
            "WHEN 'error' THEN 'Request failed' ELSE 'Pipeline job status' END AS message",
            f"element_at(array({jobs}), k % 13 + 1) AS job_name",
            "CASE event_type WHEN 'click' THEN 'running' ELSE element_at(array('success', 'partial', 'fail', 'skipped'), "
            "k % 4 + 1) END AS status",
        )

    @cached_property
    def log_lines_e(self) -> DataFrame:
        extra = F.expr(
            "CASE event_type "
            "WHEN 'signup' THEN array(named_struct('key', 'run_id', 'value', concat('R', event_id)), "
            "  named_struct('key', 'mode', 'value', 'recent')) "
            "WHEN 'purchase' THEN array(named_struct('key', 'run_id', 'value', concat('F', event_id)), "
            "  named_struct('key', 'status', 'value', status), "
            "  named_struct('key', 'duration_sec', 'value', cast(value AS string)), "
            "  named_struct('key', 'total_new', 'value', cast(k AS string)), "
            "  named_struct('key', 'analyzed_items', 'value', cast(k % 5 AS string))) "
            "WHEN 'click' THEN array(named_struct('key', 'job_name', 'value', job_name), "
            "  named_struct('key', 'status', 'value', status)) "
            "WHEN 'view' THEN array(named_struct('key', 'job_name', 'value', job_name), "
            "  named_struct('key', 'status', 'value', status), "
            "  named_struct('key', 'duration_sec', 'value', cast(value AS string)), "
            "  named_struct('key', 'new_items', 'value', cast(k AS string))) "
            "ELSE array(named_struct('key', 'error_message', 'value', concat('code=', k, ', url\nlost'))) END"
        )
        line = logs.format_line(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.col("level"), F.lit("rostrum"), F.col("message"), extra
        )
        return self.log_fields_e.select("source", "block", "seq", line.alias("value"))

    @cached_property
    def rough_lines_e(self) -> DataFrame:
        """Log lines as they also occur: a quarter has no readable time, a fifth of the reports no status."""
        rows = self.log_fields_e.selectExpr(
            "*", "CASE WHEN event_id % 5 <> 0 THEN status END AS given", "event_type IN ('view', 'purchase') AS told")
        pairs = [
            ("run_id", "event_type IN ('signup', 'purchase')", "concat('R', event_id)"),
            ("job_name", "event_type IN ('click', 'view')", "job_name"),
            ("status", "event_type IN ('click', 'view', 'purchase')", "given"),
            ("duration_sec", "told", "cast(value AS string)"), ("new_items", "event_type = 'view'", "cast(k AS string)"),
            ("total_new", "event_type = 'purchase'", "cast(k AS string)"), ("synced_items", "told AND k % 2 = 0", "cast(k AS string)"),
            ("source_synced_items", "told", "cast(k + 1 AS string)"), ("tableau_mart_items", "told", "cast(k + 2 AS string)"),
            ("mart_daily_rows", "event_type = 'view'", "cast(k + 3 AS string)"),
        ]
        extra = F.expr("filter(array(" + ", ".join(
            f"named_struct('key', '{name}', 'value', CASE WHEN {when} THEN {value} END)" for name, when, value in pairs)
            + "), e -> e.value IS NOT NULL)")
        ts = F.when(F.col("event_id") % 4 != 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")).otherwise("soon")
        line = logs.format_line(ts, F.col("level"), F.lit("rostrum"), F.col("message"), extra)
        return rows.select("source", "block", "seq", line.alias("value"))

    @cached_property
    def dated_d(self) -> DataFrame:
        """Documents with a rough date, a dated first line and an archive link."""
        return self.table("documents").selectExpr(
            "doc_id AS id", "element_at(array('BOE', 'BOJ', 'RBA', 'FRB'), cast(doc_id % 4 + 1 AS int)) AS bank_code",
            "date_add(date'2019-01-01', cast(doc_id * 37 % 1800 AS int)) AS true_date", "text", "doc_id",
        ).selectExpr(
            "id", "bank_code", "true_date",
            "CASE WHEN bank_code = 'RBA' THEN CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' "
            "  ELSE cast(true_date AS string) END "
            "WHEN bank_code = 'FRB' OR doc_id % 5 = 0 THEN cast(true_date AS string) "
            "WHEN doc_id % 5 = 1 THEN concat(year(true_date), '-50-01') "
            "WHEN doc_id % 5 = 2 THEN concat(date_format(true_date, 'yyyy-MM'), '-01') "
            "ELSE concat(year(true_date), '-01-01') END AS date",
            "concat('https://x/speeches/sp-gov-', date_format(true_date, 'ddMMyy'), '.html') AS url",
            "concat(CASE doc_id % 7 WHEN 0 THEN concat('Published on ', date_format(true_date, 'd MMMM yyyy')) "
            "  WHEN 1 THEN date_format(true_date, 'MMMM d, yyyy') "
            "  WHEN 2 THEN concat('Tokyo, ', date_format(true_date, 'MMM'), '. ', date_format(true_date, 'd, yyyy')) "
            "  WHEN 3 THEN concat('Given ', date_format(add_months(true_date, 13), 'd MMMM yyyy')) "
            "  WHEN 4 THEN date_format(true_date, 'd MMMM yyyy') ELSE 'No date here' END, '\n', text) AS full_text",
            "CAST(NULL AS timestamp_ntz) AS synced_at",
        )

    @cached_property
    def people_p(self) -> DataFrame:
        """Member names in the spellings found in lists, derived from the part names."""
        return self.table("part").selectExpr(
            "p_partkey AS id", "p_name", "p_partkey",
            "element_at(array('BOJ', 'BOE', 'FRB'), cast(p_partkey % 3 + 1 AS int)) AS bank_code",
            "split_part(p_name, ' ', 1) AS w1", "split_part(p_name, ' ', 2) AS w2",
        ).selectExpr(
            "id", "bank_code", "w1", "w2",
            "CASE p_partkey % 10 WHEN 0 THEN p_name WHEN 1 THEN concat('Sir ', p_name) "
            "WHEN 2 THEN concat('deputy governor  ', upper(p_name)) WHEN 3 THEN concat(upper(w1), ' ', initcap(w2)) "
            "WHEN 4 THEN concat(' ', initcap(p_name), ' (May 2020)') WHEN 5 THEN concat(p_name, ' Slides') "
            "WHEN 6 THEN concat('Speech by ', p_name) WHEN 7 THEN 'ab' "
            "WHEN 8 THEN concat(initcap(w1), ' ', upper(w2)) ELSE concat('Dr. ', p_name) END AS name",
        )


SQL_VIEWS: dict[str, str] = {
    "speeches_o": """
        SELECT o_orderkey AS id, n_name AS bank_code, o_custkey AS speaker_id, c_name AS speaker,
          o_orderpriority AS title, CAST(o_orderdate AS DATE) AS date, 'https://x/' || o_orderkey AS url,
          CAST(NULL AS VARCHAR) AS full_text, 'speech' AS speech_type, 'en' AS language,
          o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) AS fetched_at,
          o_orderdate + to_days(CAST(o_orderkey % 6 AS INTEGER)) AS created_at,
          CASE WHEN o_orderkey % 3 <> 0 THEN TIMESTAMP '2001-07-01 00:00:00' END AS synced_at
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "analysis_o": """
        SELECT o_orderkey AS speech_id,
          CASE WHEN o_orderstatus = 'P' OR o_orderkey % 11 = 0 THEN NULL
            ELSE greatest(least(round((o_totalprice - 250000) / 250000, 1), 1.0), -1.0) + 0.0 END AS stance_score,
          'reason ' || o_orderkey AS stance_reason,
          '[{"category": "' || o_orderpriority || '", "detail": "d' || (o_custkey % 10) || '"}]' AS keywords,
          CASE WHEN o_orderkey % 2 = 0 THEN 'inflation' END AS main_risk,
          o_orderkey % 4 AS analysis_attempts,
          CASE WHEN o_orderkey % 13 = 0 THEN 'pending' WHEN o_orderstatus = 'P' THEN 'no_signal' ELSE 'scored' END
            AS analysis_status,
          o_orderdate + to_days(CAST(o_orderkey % 9 AS INTEGER)) AS analyzed_at,
          CASE WHEN o_orderkey % 4 <> 0 THEN TIMESTAMP '2001-07-01 00:00:00' END AS synced_at
        FROM orders""",
    "members_o": """
        SELECT c_custkey AS id, n_name AS bank_code, c_name AS name,
          CASE c_custkey % 4 WHEN 0 THEN 'Governor' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'Chair' END AS role,
          CASE WHEN c_custkey % 3 = 0 THEN 'retired' ELSE 'active' END AS status,
          CAST(NULL AS DATE) AS term_start,
          CASE WHEN c_custkey % 6 = 0 THEN DATE '2001-01-01' END AS term_end, last AS last_speech_date,
          TIMESTAMP '2001-07-01 00:00:00' + to_days(CAST(c_custkey % 50 AS INTEGER)) AS last_updated,
          CASE WHEN c_custkey % 4 <> 0 THEN TIMESTAMP '2001-07-20 00:00:00' END AS synced_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
    "events_o": """
        SELECT s.id AS speech_id, s.url, s.date, s.bank_code, s.speaker, s.title, a.stance_score, a.stance_reason,
          a.keywords, a.main_risk, a.analysis_status, a.analyzed_at, s.fetched_at, s.created_at,
          CAST(datediff('day', s.date, CAST(s.fetched_at AS DATE)) AS BIGINT) AS collection_lag_days,
          CAST(datediff('day', s.date, CAST(a.analyzed_at AS DATE)) AS BIGINT) AS analysis_lag_days
        FROM speeches_o s JOIN analysis_o a ON s.id = a.speech_id
        WHERE a.analysis_status IN ('scored', 'no_signal')""",
    "daily_o": """
        SELECT date, bank_code, daily_stance_score, scored, total, level, last_scored, days_since,
          power(0.5, days_since / 14.0) AS weight
        FROM (
          SELECT *, CAST(datediff('day', last_scored, date) AS BIGINT) AS days_since FROM (
            SELECT d.date, d.bank_code, avg_score AS daily_stance_score, coalesce(scored, 0) AS scored,
              coalesce(total, 0) AS total,
              last_value(avg_score IGNORE NULLS) OVER w AS level,
              max(CASE WHEN scored > 0 THEN d.date END) OVER w AS last_scored
            FROM (
              SELECT bank_code, CAST(unnest(generate_series(CAST(first AS TIMESTAMP), TIMESTAMP '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS date
              FROM (SELECT bank_code, min(date) AS first FROM events_o GROUP BY 1)) d
            LEFT JOIN (
              SELECT bank_code, date, count(*) AS total,
                count(*) FILTER (WHERE analysis_status = 'scored' AND stance_score IS NOT NULL) AS scored,
                avg(stance_score) FILTER (WHERE analysis_status = 'scored') AS avg_score
              FROM events_o GROUP BY 1, 2) x ON d.bank_code = x.bank_code AND d.date = x.date
            WINDOW w AS (PARTITION BY d.bank_code ORDER BY d.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))""",
    "rates_l": """
        SELECT CAST(l_shipdate AS DATE) AS date, n_name AS bank_code, avg(l_extendedprice) AS rate
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""",
    "speeches_d": """
        SELECT doc_id AS id, lang AS bank_code, CASE WHEN n_chars % 10 <> 0 THEN n_chars % 120 END AS speaker_id,
          substring(split_part(text, chr(10), 1), 1, 60) AS title,
          DATE '2024-01-31' - CAST(n_chars % 60 AS INTEGER) AS date, 'https://x/d/' || doc_id AS url,
          CASE WHEN doc_id % 25 <> 0 THEN text END AS full_text,
          CASE WHEN doc_id % 5 = 0 THEN 'Remarks' ELSE 'speech' END AS speech_type,
          CASE WHEN doc_id % 2 = 0 THEN TIMESTAMP '2024-01-30 00:00:00' END AS synced_at
        FROM documents""",
    "analysis_d": """
        SELECT doc_id AS speech_id, CASE WHEN quality = 1 AND doc_id % 5 <> 0 THEN CAST(0.5 AS DOUBLE) END AS stance_score,
          'because' AS stance_reason,
          CASE WHEN doc_id % 2 = 0 THEN '[]' ELSE '[{"category": "Inflation", "detail": "x"}]' END AS keywords,
          CAST(NULL AS VARCHAR) AS main_risk, doc_id % 7 AS analysis_attempts,
          CASE WHEN doc_id % 3 = 0 THEN 'pending' WHEN doc_id % 3 = 1 THEN 'skipped' WHEN quality = 1 THEN 'scored'
            ELSE 'no_signal' END AS analysis_status,
          TIMESTAMP '2024-01-20 00:00:00' AS analyzed_at,
          CASE WHEN doc_id % 4 = 0 THEN TIMESTAMP '2024-01-25 00:00:00' END AS synced_at
        FROM labels""",
    "members_d": """
        SELECT s_suppkey AS id, (['en', 'fr', 'de', 'es'])[s_suppkey % 4 + 1] AS bank_code, s_name AS name,
          CASE WHEN s_suppkey % 5 = 0 THEN 'retired' ELSE 'active' END AS status,
          DATE '2024-01-31' - CAST(s_suppkey * 17 % 700 AS INTEGER) AS last_speech_date
        FROM supplier""",
    "roster_d": """
        SELECT lang AS bank_code, doc_id AS position,
          array_to_string(list_slice(regexp_split_to_array(text, '[ \\n]'), 1, 2), ' ') AS name
        FROM documents WHERE doc_id % 40 = 3""",
    "candidates_p": """
        SELECT page_id, bank_code, page_id * 3 + k AS position,
          CASE k WHEN 0 THEN page_title || ' (Summary)' WHEN 1 THEN '  ' || replace(page_title, 'e', 'E') || ' '
            ELSE page_title || ' (Full Text)' END AS title,
          DATE '2024-01-01' + CAST(page_id % 30 AS INTEGER) AS date,
          CASE k WHEN 0 THEN page_url || '.pdf' WHEN 1 THEN upper(page_url) ELSE page_url || '/x.PDF?v=2' END AS url,
          CASE WHEN page_id % 4 <> 0 THEN 'Person ' || (page_id % 20) END AS speaker
        FROM (SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS bank_code, url AS page_url,
            regexp_extract(html, '<title>([^<]*)</title>', 1) AS page_title, unnest([0, 1, 2]) AS k FROM pages)""",
    "stored_p": """
        SELECT page_id AS id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS bank_code,
          CASE WHEN page_id % 2 = 0 THEN ' ' || regexp_extract(html, '<title>([^<]*)</title>', 1) || ' (Summary) '
            ELSE 'other' END AS title,
          DATE '2024-01-01' + CAST(page_id % 30 AS INTEGER) AS date, url,
          CASE WHEN page_id % 2 = 0 THEN 'Share this page' ELSE 'clean' END AS full_text
        FROM pages""",
    "known_p": "SELECT * FROM stored_p WHERE id % 3 = 0",
    "runlog_e": """
        SELECT event_id AS id, 'run' || user_id AS run_id, event_type AS stage_name, ts AS started_at,
          CASE WHEN event_id % 9 <> 0 THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS finished_at,
          CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'partial' WHEN 'click' THEN 'running'
            WHEN 'view' THEN 'success' ELSE 'skipped' END AS status,
          CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_count,
          CASE WHEN event_id % 10 = 0 THEN 'bad ' || event_id ELSE props END AS details_json
        FROM events""",
    "status_e": """
        SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'B0' ELSE 'B' || (user_id % 6) END AS bank_code,
          event_type AS stage,
          CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'partial' WHEN 'click' THEN 'running'
            WHEN 'view' THEN 'success' ELSE 'skipped' END AS state, ts AS event_at
        FROM events""",
    "log_fields_e": f"""
        SELECT *, CASE WHEN event_type <> 'error' THEN 'INFO' WHEN k % 2 = 0 THEN 'ERROR' ELSE 'WARNING' END AS level,
          CASE event_type WHEN 'signup' THEN 'Starting sync run' WHEN 'purchase' THEN 'Finished sync run'
            WHEN 'error' THEN 'Request failed' ELSE 'Pipeline job status' END AS message,
          ({JOB_KEYS})[k % 13 + 1] AS job_name,
          CASE event_type WHEN 'click' THEN 'running'
            ELSE (['success', 'partial', 'fail', 'skipped'])[k % 4 + 1] END AS status
        FROM (SELECT event_id, date_trunc('millisecond', ts) AS ts, event_type, value,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
            CASE WHEN user_id < 50 THEN 'app_0' ELSE 'app_' || user_id END AS source FROM events)""",
    "log_runs_e": """
        SELECT * FROM (
          SELECT *, min(CASE WHEN message = 'Finished sync run' THEN event_id END) OVER (PARTITION BY source, run_no) AS run_end,
            max(run_no) OVER (PARTITION BY source) AS last_run
          FROM (SELECT *, CAST(count(CASE WHEN message = 'Starting sync run' THEN 1 END) OVER (
              PARTITION BY source ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run_no
            FROM log_fields_e))
        WHERE (run_no > 0 AND (run_end IS NULL OR event_id <= run_end)) OR last_run = 0""",
    "log_jobs_e": """
        SELECT source, run_no, job_name AS job, start.ts AS start_ts, final.ts AS end_ts, final.k AS k,
          CASE WHEN final.event_type = 'click' THEN 'running' WHEN final.status = 'partial' THEN 'warning'
            WHEN final.status = 'fail' THEN 'failed' ELSE final.status END AS status,
          CASE WHEN final.event_type = 'view' THEN final.value
            ELSE greatest(epoch_us(final.ts) - epoch_us(start.ts), 0) / 1000000.0 END AS duration,
          CASE WHEN final.event_type = 'view' THEN final.k END AS new_items, job_events
        FROM (SELECT source, run_no, job_name, coalesce(running, first) AS start,
            coalesce(done, running, first) AS final, job_events
          FROM (SELECT source, run_no, job_name, count(*) AS job_events,
              arg_min(e, event_id) FILTER (WHERE event_type = 'click') AS running, arg_min(e, event_id) AS first,
              arg_max(e, event_id) FILTER (WHERE event_type = 'view') AS done
            FROM (SELECT *, {'ts': ts, 'k': k, 'value': value, 'status': status, 'event_type': event_type} AS e
              FROM log_runs_e WHERE message = 'Pipeline job status')
            GROUP BY 1, 2, 3))""",
    "rough_runs_e": """
        SELECT * FROM (
          SELECT *, min(CASE WHEN message = 'Finished sync run' THEN event_id END) OVER (PARTITION BY source, run_no) AS run_end,
            max(run_no) OVER (PARTITION BY source) AS last_run
          FROM (SELECT event_id, source, level, message, event_type, job_name, k, value, CASE WHEN event_id % 4 <> 1 THEN ts END AS ts,
              CASE WHEN event_id % 5 <> 0 THEN status END AS status,
              CAST(count(CASE WHEN message = 'Starting sync run' THEN 1 END) OVER (
                PARTITION BY source ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run_no
            FROM log_fields_e))
        WHERE (run_no > 0 AND (run_end IS NULL OR event_id <= run_end)) OR last_run = 0""",
    "rough_jobs_e": """
        SELECT source, run_no, job_name AS job, start.ts AS start_ts, final.ts AS end_ts, final.status AS reported, job_events,
          CASE WHEN final.event_type = 'view' THEN CAST(final.k AS BIGINT) END AS new_items,
          CASE WHEN final.event_type = 'view' AND final.k % 2 = 0 THEN CAST(final.k AS BIGINT) END AS synced_items,
          CASE WHEN final.event_type = 'view' THEN CAST(final.k + 1 AS BIGINT) END AS source_synced_items,
          CASE WHEN final.event_type = 'view' THEN CAST(final.k + 2 AS BIGINT) END AS tableau_mart_items,
          CASE WHEN final.event_type = 'view' THEN CAST(final.k + 3 AS BIGINT) END AS mart_daily_rows
        FROM (SELECT source, run_no, job_name, coalesce(running, first) AS start, coalesce(done, running, first) AS final, job_events
          FROM (SELECT source, run_no, job_name, count(*) AS job_events,
              arg_min(e, event_id) FILTER (WHERE status = 'running') AS running, arg_min(e, event_id) AS first,
              arg_max(e, event_id) FILTER (WHERE coalesce(status, '') <> 'running') AS done
            FROM (SELECT *, {'ts': ts, 'k': k, 'status': status, 'event_type': event_type} AS e
              FROM rough_runs_e WHERE message = 'Pipeline job status')
            GROUP BY 1, 2, 3))""",
    "rough_inside_e": """
        SELECT r.event_id, r.source, r.run_no, j.job, r.level FROM rough_runs_e r JOIN rough_jobs_e j ON r.source = j.source AND r.run_no = j.run_no
          AND r.ts IS NOT NULL AND (j.start_ts IS NULL OR r.ts >= j.start_ts) AND (j.end_ts IS NULL OR r.ts <= j.end_ts)""",
    "rough_spans_e": """
        SELECT * FROM rough_inside_e UNION ALL
        SELECT event_id, source, run_no, job_name, level FROM rough_runs_e r WHERE message = 'Pipeline job status' AND NOT EXISTS (
          SELECT 1 FROM rough_inside_e i WHERE i.source = r.source AND i.run_no = r.run_no AND i.job = r.job_name)""",
    "dated_d": """
        SELECT id, bank_code, true_date, doc_id,
          CASE WHEN bank_code = 'RBA' THEN CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN ''
              ELSE CAST(true_date AS VARCHAR) END
            WHEN bank_code = 'FRB' OR doc_id % 5 = 0 THEN CAST(true_date AS VARCHAR)
            WHEN doc_id % 5 = 1 THEN year(true_date) || '-50-01'
            WHEN doc_id % 5 = 2 THEN strftime(true_date, '%Y-%m') || '-01'
            ELSE year(true_date) || '-01-01' END AS date,
          CASE doc_id % 7 WHEN 3 THEN CAST(true_date + INTERVAL 13 MONTH AS DATE) WHEN 5 THEN NULL WHEN 6 THEN NULL
            ELSE true_date END AS text_date
        FROM (SELECT doc_id AS id, doc_id, (['BOE', 'BOJ', 'RBA', 'FRB'])[doc_id % 4 + 1] AS bank_code,
          DATE '2019-01-01' + CAST(doc_id * 37 % 1800 AS INTEGER) AS true_date FROM documents)""",
    "people_p": """
        SELECT id, bank_code, w1, w2, p_partkey % 10 AS kind,
          CASE p_partkey % 10 WHEN 0 THEN p_name WHEN 1 THEN 'Sir ' || p_name
            WHEN 2 THEN 'deputy governor  ' || upper(p_name)
            WHEN 3 THEN upper(w1) || ' ' || upper(w2[1]) || w2[2:]
            WHEN 4 THEN ' ' || upper(w1[1]) || w1[2:] || ' ' || upper(w2[1]) || w2[2:] || ' (May 2020)'
            WHEN 5 THEN p_name || ' Slides' WHEN 6 THEN 'Speech by ' || p_name WHEN 7 THEN 'ab'
            WHEN 8 THEN upper(w1[1]) || w1[2:] || ' ' || upper(w2) ELSE 'Dr. ' || p_name END AS name
        FROM (SELECT p_partkey AS id, p_partkey, p_name, (['BOJ', 'BOE', 'FRB'])[p_partkey % 3 + 1] AS bank_code,
          split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2 FROM part)""",
}
