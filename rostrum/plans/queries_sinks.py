"""Sinks, sync state and migrations."""

from functools import reduce

from pyspark.sql import functions as F

from rostrum.operators import migrate, queue, sync
from rostrum.operators.common import as_time
from rostrum.plans.registry import SQL, query
from rostrum.plans.views import NOW_O
from rostrum.session import work_folder
from rostrum.sinks import casts, deltas, manifest, tables, upsert

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def _incoming(v):
    """Changed and new members: every other one, and as many newcomers."""
    changed = v.members_o.where("id % 2 = 0").select(
        "id", F.lit("X").alias("bank_code"), F.lit("renamed").alias("name"), F.lit("Chair").alias("role"),
        F.when(F.col("id") % 4 != 0, "active").alias("status"),
    )
    new = v.members_o.where("id % 2 = 1").select(
        (F.col("id") + 10_000_000_000).alias("id"), "bank_code", F.concat("name", F.lit(" jr")).alias("name"),
        F.lit("Chair").alias("role"), F.lit("active").alias("status"),
    )
    return changed.unionByName(new)


@query("""
    SELECT id, bank_code, name, CASE WHEN id % 2 = 0 THEN 'Chair' ELSE role END AS role,
      CASE WHEN id % 4 = 0 THEN NULL WHEN id % 2 = 0 THEN 'active' ELSE status END AS status,
      CAST(last_speech_date AS VARCHAR) AS last_speech_date FROM members_o
    UNION ALL SELECT id + 10000000000, bank_code, name || ' jr', 'Chair', 'active', NULL FROM members_o WHERE id % 2 = 1""")
def upsert_by_key(v):
    keys = upsert.default_keys(v.members_o.columns, "members")
    out = upsert.upsert_by_key(v.members_o, _incoming(v), keys)
    return out.select("id", "bank_code", "name", "role", "status", "last_speech_date")


@query("""
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, round(CAST(o_totalprice AS FLOAT)::DOUBLE, 6) AS score_raw, o_orderkey AS order_id,
      CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS member_id, o_orderpriority AS url FROM orders""")
def cast_for_sink(v):
    loose = v.table("orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_totalprice").alias("score_raw"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise("n/a").alias("member_id"),
        F.col("o_orderpriority").alias("url"),
    )
    return casts.cast_for_sink(loose)


@query("""
    SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, CAST(year(l_shipdate) AS BIGINT) AS year, l_orderkey AS code,
      CAST(l_returnflag = 'A' AS BIGINT) AS returned, round(CAST(l_tax AS FLOAT)::DOUBLE, 6) AS tax_ratio,
      round(l_extendedprice, 6) AS price, l_linestatus AS label FROM lineitem""")
def cast_for_fact(v):
    loose = v.table("lineitem").select(
        F.col("l_shipdate").alias("date"), F.year("l_shipdate").alias("year"), F.col("l_orderkey").alias("code"),
        (F.col("l_returnflag") == "A").alias("returned"), F.col("l_tax").alias("tax_ratio"),
        F.col("l_extendedprice").alias("price"), F.col("l_linestatus").alias("label"),
    )
    return casts.cast_for_fact(loose)


@query("""
    SELECT CAST(event_id AS DOUBLE) AS event_id, CASE WHEN user_id % 3 <> 0 THEN value END AS value, event_type FROM events""")
def cast_for_extract(v):
    loose = v.table("events").select(
        "event_id", F.when(F.col("user_id") % 3 == 0, F.lit("NaN").cast("double")).otherwise(F.col("value")).alias("value"), "event_type"
    )
    return casts.cast_for_extract(loose)


@query("SELECT CAST(p_partkey AS VARCHAR) AS instrument, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part")
def write_master(v):
    return casts.master_table(v.table("part").select(
        F.col("p_partkey").alias("instrument"), F.col("p_name").alias("name"), F.col("p_size").alias("size")
    ))


@query("""
    SELECT 'ds_code' AS "column", p_brand AS value, count(*) AS n FROM part GROUP BY 2 HAVING count(*) > 1""")
def master_key_conflicts(v):
    return casts.master_key_conflicts(v.table("part").select(
        F.col("p_partkey").alias("instrument"), F.col("p_brand").alias("ds_code"), "p_name"
    ))


@query("SELECT p_partkey, p_retailprice FROM part")
def slim_fact(v):
    fact = v.table("part").select("p_partkey", "p_retailprice", F.col("p_name").alias("name"), F.lit("x").alias("TickerFull"))
    return casts.slim_fact(fact, "prices")


@query("""
    SELECT o_orderkey AS id, CAST(o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AS BIGINT) AS landed FROM orders""")
def quarantine_bad_rows(v):
    loose = v.table("orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 == 0, "soon").otherwise("2020-01-01").alias("date"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("title"),
    )
    good, bad = upsert.split_valid(casts.cast_for_sink(loose), ("id", "date", "title"))
    return good.select("id", F.lit(1).alias("landed")).unionByName(bad.select("id", F.lit(0).alias("landed")))


@query("SELECT id, bank_code, name, role, status FROM members_o WHERE synced_at IS NULL OR last_updated > synced_at")
def unsynced_members(v):
    return sync.unsynced_members(v.members_o).select("id", "bank_code", "name", "role", "status")


@query("""
    SELECT s.id, s.speaker, s.title, a.stance_score, a.main_risk FROM speeches_o s LEFT JOIN analysis_o a ON s.id = a.speech_id
    WHERE s.synced_at IS NULL""")
def unsynced_rows(v):
    return sync.unsynced_speeches(v.speeches_o, v.members_o, v.analysis_o).select(
        "id", "speaker", "title", "stance_score", "main_risk"
    )


@query("SELECT id FROM speeches_o WHERE synced_at IS NULL ORDER BY date DESC, id LIMIT 100")
def newest_n(v):
    return sync.unsynced_speeches(v.speeches_o, v.members_o, v.analysis_o, limit=100).select("id")


@query("""
    SELECT url, speech_id, analysis_attempts FROM analysis_o JOIN speeches_o ON speech_id = id
    WHERE analysis_o.synced_at IS NULL AND analysis_status IN ('scored', 'no_signal')""")
def unsynced_analysis(v):
    return sync.unsynced_analysis(v.analysis_o, v.speeches_o).select("url", "speech_id", "analysis_attempts")


@query("""
    SELECT s.id, s.bank_code, s.speaker, s.speaker_id, s.title, CAST(s.date AS VARCHAR) AS date, s.url, s.speech_type, s.language,
      a.stance_score, a.stance_reason, a.keywords FROM speeches_o s LEFT JOIN analysis_o a ON s.id = a.speech_id""")
def sync_views(v):
    everything = sync.unsynced_speeches(sync.reset_synced(v.speeches_o), v.members_o, v.analysis_o)
    return everything.select(
        "id", "bank_code", "speaker", "speaker_id", "title", "date", "url", "speech_type", "language", "stance_score",
        "stance_reason", "keywords",
    )


@query("SELECT id, CAST(synced_at IS NOT NULL OR id % 2 = 0 AS BIGINT) AS synced, '2001-08-01 12:00:00.000000' AS last FROM speeches_o"
       .replace("'2001-08-01 12:00:00.000000' AS last", f"CASE WHEN id % 2 = 0 THEN '2001-08-01 12:00:00.000000' ELSE {STAMP.format('synced_at')} END AS last"))
def mark_synced(v):
    out = sync.mark_synced(v.speeches_o, v.speeches_o.where("id % 2 = 0"), "id", as_time(NOW_O))
    return out.select("id", F.col("synced_at").isNotNull().alias("synced"), F.col("synced_at").alias("last"))


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS synced FROM speeches_o")
def reset_synced(v):
    return sync.reset_synced(v.speeches_o).agg(F.count(F.lit(1)).alias("n"), F.count("synced_at").alias("synced"))


def _sync(v):
    target = v.analysis_o.join(v.speeches_o.select(F.col("id").alias("speech_id"), "url"), "speech_id").where(
        "speech_id % 3 = 0"
    ).select(*sync.ANALYSIS_COLUMNS).withColumn("stance_reason", F.lit("old"))
    outgoing = sync.unsynced_analysis(v.analysis_o, v.speeches_o).withColumn(
        "main_risk", F.when(F.col("speech_id") % 10 != 0, F.coalesce("main_risk", F.lit("none")))
    )
    return sync.incremental_sync(v.analysis_o, outgoing, target, ["url"], "speech_id", as_time(NOW_O), ("url", "main_risk"))


OUT_SQL = "a.synced_at IS NULL AND a.analysis_status IN ('scored', 'no_signal') AND a.speech_id % 10 <> 0"


@query(f"""
    SELECT 'https://x/' || speech_id AS url, CASE WHEN {OUT_SQL} THEN stance_reason ELSE 'old' END AS stance_reason
    FROM analysis_o a WHERE speech_id % 3 = 0 OR ({OUT_SQL})""")
def incremental_sync(v):
    return _sync(v).target.select("url", "stance_reason")


@query(f"SELECT speech_id, CAST(a.synced_at IS NOT NULL OR ({OUT_SQL}) AS BIGINT) AS synced FROM analysis_o a")
def incremental_sync_marks(v):
    return _sync(v).source.select("speech_id", F.col("synced_at").isNotNull().alias("synced"))


@query("SELECT speech_id FROM analysis_o a WHERE a.synced_at IS NULL AND a.analysis_status IN ('scored', 'no_signal') AND a.speech_id % 10 = 0")
def incremental_sync_rejects(v):
    return _sync(v).rejected.select("speech_id")


def _wide(v):
    return v.speeches_o.join(v.analysis_o.drop("synced_at").withColumnRenamed("speech_id", "id"), "id").withColumn(
        "analysis_status", F.when(F.col("id") % 5 != 0, F.col("analysis_status"))
    ).drop("analyzed_at")


@query("SELECT speech_id, stance_score, analysis_status FROM analysis_o WHERE speech_id % 5 <> 0")
def split_columns(v):
    speeches, analysis = migrate.split_columns(_wide(v))
    return analysis.select("speech_id", "stance_score", "analysis_status")


@query("SELECT id, bank_code, CAST(NULL AS VARCHAR) AS role, CAST(NULL AS DOUBLE) AS avg_stance_score FROM members_o")
def add_missing_columns(v):
    old = v.members_o.select("id", "bank_code", "name")
    return migrate.add_missing_columns(old, "members").select("id", "bank_code", "role", "avg_stance_score")


@query("SELECT id, role FROM members_o WHERE id % 2 = 0")
def replace_table(v):
    """Two published versions; readers see the newer one."""
    root = work_folder(v.spark, "published")
    tables.replace_table(v.members_o.select("id", "role"), root, 1)
    tables.replace_table(v.members_o.where("id % 2 = 0").select("id", "role"), root, 2)
    return tables.read_latest(v.spark, root)


@query(f"""
    SELECT run_id, strftime(started_at, '%Y-%m') AS month, status, round(duration_sec, 3) AS duration_sec FROM (
      SELECT 'r' || id AS run_id, started_at, status, (epoch_us(finished_at) - epoch_us(started_at)) / 1000000.0 AS duration_sec FROM runlog_e)
    WHERE duration_sec IS NOT NULL""")
def append_summary(v):
    path = work_folder(v.spark, "summary")
    timed = v.runlog_e.where("finished_at IS NOT NULL").select(
        F.concat(F.lit("r"), "id").alias("run_id"), "started_at", "status", _seconds().alias("duration_sec"),
        F.lit(0).alias("total_new"), F.lit(0).alias("total_refreshed"), F.lit(0).alias("analyzed_items"),
        F.lit(0).alias("synced_items"), F.lit(None).cast("string").alias("failed_steps"),
    )
    tables.append_summary(timed.where("status = 'success'"), path)
    tables.append_summary(timed.where("status <> 'success'"), path)
    back = v.spark.read.option("header", True).option("basePath", path).schema(
        "run_id STRING, started_at STRING, status STRING, duration_sec DOUBLE, month STRING"
    ).csv(path)
    return back.select("run_id", "month", "status", "duration_sec")


def _seconds():
    from rostrum.functions.dates import duration_seconds

    return duration_seconds(F.col("started_at"), F.col("finished_at"))


def shown_tables(store):
    """The rows of the four base tables in one relation, as `SNAPSHOT_SQL` shows them."""
    shown = {
        "members": ("id", ("bank_code", "name", "role", "status", "last_speech_date")),
        "analysis": ("speech_id", ("analysis_status", "analysis_attempts", "keywords")),
        "speeches": ("id", ("bank_code", "speaker_id", "title", "date", "url")),
        "stage_runs": ("id", ("run_id", "stage_name", "status", "item_count")),
    }
    rows = [
        store[name].select(
            F.lit(name).alias("tab"), F.col(key).cast("string").alias("row_key"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("content"))
        for name, (key, columns) in shown.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


SNAPSHOT_SQL = f"""
    SELECT 'members' AS tab, CAST(id AS VARCHAR) AS row_key, concat_ws('|', bank_code, name, role, status, CAST(last_speech_date AS VARCHAR)) AS content FROM members_o
    UNION ALL SELECT 'analysis', CAST(speech_id AS VARCHAR), concat_ws('|', analysis_status, CAST(analysis_attempts AS VARCHAR), keywords) FROM analysis_o
    UNION ALL SELECT 'speeches', CAST(id AS VARCHAR), concat_ws('|', bank_code, CAST(speaker_id AS VARCHAR), title, CAST(date AS VARCHAR), url) FROM speeches_o
    UNION ALL SELECT 'stage_runs', CAST(id AS VARCHAR), concat_ws('|', run_id, stage_name, status, CAST(item_count AS VARCHAR)) FROM runlog_e"""


@query(SNAPSHOT_SQL)
def export_snapshot(v):
    """All four tables at one version; a later version that its writer did not finish is not read."""
    root = work_folder(v.spark, "snapshot")
    store = {"members": v.members_o, "analysis": v.analysis_o, "speeches": v.speeches_o.drop("full_text"), "stage_runs": v.runlog_e}
    tables.export_snapshot(store, root, 20010801)
    manifest.write_part(v.members_o.limit(0), root)  # a writer that dies before it publishes
    return shown_tables(tables.read_snapshot(v.spark, root))


@query(SQL["upsert_by_key"])
def upsert_merge_on_read(v):
    """S10 as a change file beside the table: nothing but the incoming rows is written."""
    root = work_folder(v.spark, "members")
    keys = upsert.default_keys(v.members_o.columns, "members")
    deltas.create(v.members_o, root)
    deltas.upsert(_incoming(v), root, keys)
    return deltas.read(v.spark, root, keys).select("id", "bank_code", "name", "role", "status", "last_speech_date")


@query(SQL["mark_synced"])
def mark_synced_merge_on_read(v):
    """D9 as a change file of ids and times; the speeches are not written again."""
    root = work_folder(v.spark, "speeches")
    deltas.create(v.speeches_o, root)
    deltas.write_change(sync.synced_rows(v.speeches_o.where("id % 2 = 0"), "id", as_time(NOW_O)), root, ["id"])
    out = deltas.read(v.spark, root, ["id"])
    return out.select("id", F.col("synced_at").isNotNull().alias("synced"), F.col("synced_at").alias("last"))


@query("""
    SELECT id, CASE WHEN id % 4 = 0 THEN 1 ELSE 0 END AS rescored,
      CAST(synced_at IS NOT NULL AND id % 4 <> 0 AS BIGINT) AS synced, CAST(id % 5 AS BIGINT) AS attempts FROM (
      SELECT s.id, s.synced_at FROM speeches_o s JOIN analysis_o a ON s.id = a.speech_id)""")
def apply_scores_merge_on_read(v):
    """D6 as two change files, and compaction: a speech with a new result syncs again; all others keep their time."""
    root = work_folder(v.spark, "speeches")
    wide = v.speeches_o.join(v.analysis_o.select(F.col("speech_id").alias("id")), "id", "left_semi").withColumn(
        "attempts", F.lit(0).cast("long"))
    deltas.create(wide, root)
    responses = wide.select(F.col("id").alias("speech_id"), F.when(F.col("id") % 4 == 0, F.lit(
        '{"stance_score": 0.5, "stance_reason": "r", "keywords": []}')).otherwise("no answer").alias("response"))
    deltas.write_change(queue.rescored(responses), root, ["id"])
    deltas.write_change(wide.select("id", (F.col("id") % 5).alias("attempts")), root, ["id"])
    deltas.compact(v.spark, root, ["id"])
    return deltas.read(v.spark, root, ["id"]).select(
        "id", (F.col("id") % 4 == 0).alias("rescored"), F.col("synced_at").isNotNull().alias("synced"), "attempts")
