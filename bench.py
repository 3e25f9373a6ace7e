"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data and
the number of cores. Every query runs in full: all rows and columns are produced and
thrown away by the noop sink. `value` sums the first run of each headline query; `warm` has a
second run of each, and `further` the first run of the dearer composite queries.
"""

from __future__ import annotations

import json
import os
import time

from rostrum.plans import catalog
from rostrum.session import build_session

HEADLINE = (
    "daily_mart", "events_mart", "plot_mart", "late_recompute", "daily_score", "rate_on_daily",
    "weighted_stance", "fill_member_attrs", "activity_status", "bank_stats",
    "pending_queue", "apply_scores", "mark_skipped", "revive_skipped",
    "insert_new_speeches", "dedupe_first", "drop_duplicates_keep_longest", "merge_members", "remap_ids", "name_in_text",
    "normalize_url", "parse_date_multi", "repair_dates", "clean_page_text", "extract_page_text", "extract_page_links",
    "upsert_by_key", "incremental_sync", "cast_for_fact", "quality_report",
    "build_term_index", "keyword_search", "split_runs", "job_first_last", "run_summary", "latest_status",
)
FURTHER = (
    "incremental_dedupe", "late_recompute_stream", "issues_in_job", "refresh_changed", "repair_speakers", "lastname_lookup",
    "score_batch", "export_snapshot", "apply_scores_merge_on_read", "log_search_stored",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    queries = catalog.queries()

    def timed(names: tuple[str, ...]) -> dict[str, float]:
        times = {}
        for name in names:
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        return times

    times, warm, further = timed(HEADLINE), timed(HEADLINE), timed(FURTHER)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "warm": warm, "further": further, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
