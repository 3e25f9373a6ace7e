"""Published versions, merge on read, partitioned marts and bucketed keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rostrum.operators import marts
from rostrum.sinks import deltas, manifest, tables
from rostrum.streaming import ingest as intake
from rostrum.streaming import late as late_module

STAMP = dt.datetime(2024, 1, 1)


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_a_version_is_there_as_a_whole_or_not_at_all(spark, frame, tmp_path):
    root = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        manifest.tables_of(spark, root)
    tables.export_snapshot({"a": frame("id long", (1,)), "b": frame("id long, t string", (1, "x"))}, root, 1)
    # A writer that dies after its files, or while its manifest is still aside, publishes nothing.
    manifest.write_part(frame("id long", (2,)), root)
    (tmp_path / "store" / manifest.MANIFESTS / ".half").write_text("{")
    assert manifest.versions(spark, root) == [1]
    both = tables.read_snapshot(spark, root)
    assert rows_of(both["a"]) == ["(1,)"] and rows_of(both["b"]) == ["(1, 'x')"]
    tables.export_snapshot({"a": frame("id long", (3,)), "b": frame("id long, t string")}, root, 2)
    assert rows_of(tables.read_snapshot(spark, root)["b"]) == []
    assert rows_of(tables.read_snapshot(spark, root, 1)["a"]) == ["(1,)"]  # the older version as it was


def test_parts_have_folders_of_their_own(spark, frame, tmp_path):
    root = str(tmp_path / "t")
    df = frame("k string, v long", ("a|2024-01-01", 1), ("b c/=", 2), ("b c/=", 3))
    parts = manifest.write_parts(df.withColumn("_k", F.col("k")), root, "_k")
    assert sorted(p.key for p in parts) == ["a|2024-01-01", "b c/="]
    table = manifest.Published(df.schema, parts)
    assert rows_of(table.read(spark, ["b c/="])) == ["('b c/=', 2)", "('b c/=', 3)"]
    assert rows_of(table.read(spark, [])) == []


SPEECH = "id long, url string, title string, full_text string, synced_at timestamp_ntz"


def test_a_flag_is_changed_without_writing_the_table(spark, frame, tmp_path):
    root = str(tmp_path / "speeches")
    base = frame(SPEECH, *[(i, f"u{i}", "t", "long text " * 50, None) for i in range(40)], (None, "none", "t", "x", None))
    deltas.create(base, root)
    marks = frame("id long, synced_at timestamp_ntz", (3, STAMP), (5, STAMP), (99, STAMP))
    deltas.write_change(marks, root, ["id"])
    table = manifest.tables_of(spark, root)
    assert [len(table[n].parts) for n in (deltas.BASE, deltas.CHANGES)] == [1, 1]
    written = spark.read.parquet(table[deltas.CHANGES].parts[0].path)
    assert written.count() == 3 and written.where("full_text IS NOT NULL OR title IS NOT NULL").count() == 0
    got = deltas.read(spark, root, ["id"])
    assert got.columns == base.columns
    want = base.withColumn("synced_at", F.when(F.col("id").isin(3, 5), F.lit(STAMP).cast("timestamp_ntz")))
    assert rows_of(got) == rows_of(want)
    # A later change wins; a null is a value like others; a key of one change only keeps the rest.
    deltas.write_change(frame("id long, synced_at timestamp_ntz", (3, None)), root, ["id"])
    deltas.write_change(frame("id long, title string", (5, "new")), root, ["id"])
    changed = {r["id"]: (r["title"], r["synced_at"]) for r in deltas.read(spark, root, ["id"]).where("id in (3, 5)").collect()}
    assert changed == {3: ("t", None), 5: ("new", STAMP)}
    before = rows_of(deltas.read(spark, root, ["id"]))
    version = deltas.compact(spark, root, ["id"])
    assert rows_of(deltas.read(spark, root, ["id"])) == before
    assert manifest.tables_of(spark, root)[deltas.CHANGES].parts == ()
    assert rows_of(deltas.read(spark, root, ["id"], version - 3)) == rows_of(want)


def test_upserts_on_read_equal_the_rewriting_upsert(spark, frame, tmp_path):
    from rostrum.sinks.upsert import upsert_by_key

    root = str(tmp_path / "members")
    schema = "id long, name string, role string, status string"
    rng, state = random.Random(3), frame(schema, *[(i, f"n{i}", "r", "active") for i in range(20)])
    deltas.create(state, root)
    for turn in range(4):
        ids = rng.sample(range(40), 9)
        incoming = frame("id long, name string, status string", *[(i, f"n{i}-{turn}", rng.choice(["active", None])) for i in ids])
        deltas.upsert(incoming, root, ["id"])
        state = upsert_by_key(state, incoming, ["id"])
    assert rows_of(deltas.read(spark, root, ["id"])) == rows_of(state)
    deltas.compact(spark, root, ["id"])
    assert rows_of(deltas.read(spark, root, ["id"])) == rows_of(state)


def test_updates_alone_do_not_shuffle_the_base(spark, frame, tmp_path):
    root = str(tmp_path / "speeches")
    deltas.create(frame(SPEECH, *[(i, f"u{i}", "t", "x", None) for i in range(40)]), root)
    deltas.write_change(frame("id long, synced_at timestamp_ntz", (3, STAMP)), root, ["id"])
    plan = deltas.read(spark, root, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


EVENTS = "speech_id long, bank_code string, date date, analysis_status string, stance_score double"


def events_of(rng, n):
    return [(i, rng.choice("ABC"), dt.date(2023, 1, 1) + dt.timedelta(days=rng.randint(0, 420)), *rng.choice(
        [("scored", 0.5), ("scored", -0.3), ("no_signal", None)])) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_touched_parts_equal_the_full_rebuild(spark, frame, tmp_path, seed):
    rng, root = random.Random(seed), str(tmp_path / "daily")
    rows = events_of(rng, 60)
    chosen = set(rng.sample(range(60), 4))
    late = [r for r in rows if r[0] in chosen]
    old, new = [r for r in rows if r[0] not in chosen], list(rows)
    if seed == 2:  # an event moves to another day
        moved = new[10]
        new[10] = (*moved[:2], moved[2] + dt.timedelta(days=50), *moved[3:])
        late += [moved, new[10]]
    as_of, later = "2024-02-20", "2024-03-05" if seed == 1 else "2024-02-20"
    late_module.publish_daily(marts.daily_mart(frame(EVENTS, *old), as_of), root, 0)
    before = {p.key: p.path for p in manifest.tables_of(spark, root, 0)[tables.TABLE].parts}
    touched = late_module.update_daily(
        spark, root, 1, frame(EVENTS, *new), frame(EVENTS, *late).select("bank_code", "date"), as_of, later)
    got = tables.read_latest(spark, root).drop("updated_at")
    assert rows_of(got) == rows_of(marts.daily_mart(frame(EVENTS, *new), later).drop("updated_at"))
    after = {p.key: p.path for p in manifest.tables_of(spark, root, 1)[tables.TABLE].parts}
    untouched = set(before) - set(touched)
    assert untouched and all(after[k] == before[k] for k in untouched)  # their files keep their names
    assert all(after[k] != before[k] for k in set(touched) & set(before) & set(after))


def test_a_change_reaches_to_the_next_score_only(spark, frame):
    d = dt.date
    events = frame(EVENTS, (1, "A", d(2024, 1, 5), "scored", 0.5), (2, "A", d(2024, 2, 9), "no_signal", None), (3, "A", d(2024, 3, 20), "scored", 1.0))
    late = frame("bank_code string, date date", ("A", d(2024, 2, 9)), ("A", None), ("A", d(2025, 1, 1)))
    got = marts.changed_segments(events, late, "2024-12-31", "2024-12-31").collect()
    assert [tuple(r) for r in got] == [("A", d(2024, 2, 9), d(2024, 3, 19))]
    parts = marts.touched_parts(frame("bank_code string, first date, last date", *[tuple(r) for r in got]), "2024-12-31").collect()
    assert sorted((r["part"], r["run_first"], r["run_last"]) for r in parts) == [
        (f"A|2024-0{m}-01", d(2024, 2, 1), d(2024, 3, 31)) for m in (2, 3)]


CANDIDATE = "bank_code string, position long, title string, date date, url string, speaker string, full_text string, speech_type string"


def test_a_batch_reads_the_buckets_of_its_keys_alone(spark, frame, tmp_path):
    speeches, people, source = str(tmp_path / "s"), str(tmp_path / "m"), str(tmp_path / "in")
    day = dt.date(2024, 1, 1)
    intake.create_roots(spark, speeches, people)

    def arrive(*rows):
        frame(CANDIDATE, *rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(CANDIDATE).option("maxFilesPerTrigger", 1).parquet(source)
        intake.ingest_stream(stream, speeches, people, str(tmp_path / "cp"), "2024-02-01 00:00:00", buckets=16, most_parts=2).awaitTermination()

    first = [("A", i, f"Title {i}", day, f"http://a/{i}", "Jane", "t", "speech") for i in range(60)]
    arrive(*first)
    again = frame(CANDIDATE, ("A", 0, " Title 3", day, "https://a/3/?x", "Jane", "t", "speech"))
    touched = intake.touched_buckets(again, 16)
    assert 1 <= len(touched) <= 3
    keys = intake.read_keys(spark, speeches, 1, touched)
    wanted = {p.path for p in intake.key_parts(spark, speeches, 1) if p.key in touched}
    read = {f.rsplit("/", 1)[0].split(":", 1)[-1].replace("//", "") for f in keys.inputFiles()}
    assert {r.rsplit("/", 2)[-1] for r in read} <= {w.rsplit("/", 2)[-1] for w in wanted}
    assert "full_text" not in keys.columns and keys.count() < 3 * 60
    # By URL after normalization, by title and date, by neither; and a title without a date is no key.
    arrive(("A", 0, "Other", day, "https://A/3/", "Jane", "t", "speech"), ("A", 1, " Title 4 ", day, "https://a/new4", "Jane", "t", "speech"),
           ("A", 2, "Title 5", None, "https://a/undated", "Jane", "t", "speech"), ("B", 3, "Title 5", day, "https://a/5", "Joe", "t", "speech"))
    arrive(*first[:5], ("A", 9, "Title 900", day, "http://a/900", "Jane", "t", "speech"))
    arrive(("A", 9, "Title 900", day, "http://a/901", "Jane", "t", "speech"))
    urls = sorted(r["url"] for r in intake.stored_speeches(spark, speeches).collect())
    assert urls == sorted([*[r[4] for r in first], "https://a/undated", "https://a/5", "http://a/900"])
    counts = {}
    for p in intake.key_parts(spark, speeches, 4):
        counts[p.key] = counts.get(p.key, 0) + 1
    assert max(counts.values()) <= 2  # compacted
    stored = intake.stored_speeches(spark, speeches)
    assert intake.read_keys(spark, speeches, 4, [str(b) for b in range(16)]).where("kind = 'id'").count() == stored.count()


def test_log_filters_open_the_folders_they_need(spark, frame, tmp_path):
    from rostrum.operators import runlog
    from rostrum.sinks import logstore
    from rostrum.sources.runlogs import parse_log

    root = str(tmp_path / "log")
    schema = "source string, block long, seq long, value string"

    def batch(first, day):
        levels = ["INFO", "WARNING", "ERROR", "DEBUG"]
        return parse_log(frame(schema, *[
            ("a", i // 5, i, f"{day if i % 9 else 'soon'} 00:00:00,000 | {levels[i % 4]} | x | Line {i} of {day} über alles |") for i in range(first, first + 40)]))

    both = [batch(0, "2024-01-01"), batch(40, "2024-01-02")]
    for version, lines in enumerate(both):
        logstore.store_log(lines, root, version)
    lines = both[0].unionByName(both[1])
    columns = ["seq", "level", "raw"]
    assert rows_of(logstore.stored_issues(spark, root).select(columns)) == rows_of(runlog.issues(lines).select(columns))
    opened = {f.split("_part=")[1].split("/")[0] for f in logstore.stored_issues(spark, root).inputFiles()}
    assert {o.split("%7C")[0].split("|")[0] for o in opened} == {"WARNING", "ERROR"}
    for level, word in ((None, " ÜBER "), ("INFO", "2024-01-02"), (None, "line 17 "), ("DEBUG", "x"), (None, "nowhere"), ("INFO", None), (None, None)):
        got = logstore.search_stored(spark, root, level, word).select(columns)
        assert rows_of(got) == rows_of(runlog.search_lines(lines, level, word).select(columns)), (level, word)
    assert logstore.matching_parts(spark, root, None, "nowhere") == []
    assert all(k.startswith("1|") for k in logstore.matching_parts(spark, root, None, "line 77 of"))


def test_stored_index_ranks_like_the_full_scan(spark, frame, tmp_path):
    from rostrum.operators import search
    from rostrum.sinks import postings

    rng, root = random.Random(5), str(tmp_path / "index")
    words = ["rate", "où", "bread", "the", "port", "wage"]
    rows = [(i, rng.choice([None, "The rate"]), " ".join(rng.choices(words, weights=[1, 1, 2, 9, 1, 1], k=rng.randint(0, 60))) if i % 17 else None)
            for i in range(300)]
    speeches = frame("id long, title string, full_text string", *rows)
    postings.store_index(speeches.where("id < 200"), root, 0, buckets=8, block_documents=20)
    postings.store_index(speeches.where("id >= 200"), root, 1, buckets=8, block_documents=20)

    def shown(df):
        return [(r["id"], round(r["score"], 9)) for r in df.collect()]

    for keyword in ("the", "Ou", "rate où", "bread wage port rate", "nowhere", ""):
        for limit in (None, 1, 7, 1000):
            got = postings.search_stored(spark, root, keyword, limit, buckets=8, first=2)
            assert shown(got) == shown(search.search(speeches, keyword, limit)), (keyword, limit)
    whole = {f for f in postings._read(spark, root, postings.POSTINGS, words[:1], 8).inputFiles()}
    assert len({f.split("_bucket=")[1].split("/")[0] for f in whole}) == 1  # the folders of one term


def counted_text(spark, df, column):
    """`df` with a counter of how often `column` is evaluated."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def look(text):
        seen.add(1)
        return text

    return df.withColumn(column, look(column)), seen


def test_a_line_is_parsed_once_and_its_grams_are_those_stored(spark, frame, tmp_path):
    from rostrum.sinks import logstore
    from rostrum.sources.runlogs import parse_log

    lines = ["2024-01-01 00:00:00,000 | INFO | x | Ab😀c | é", "2024-01-02 00:00:00,000 | INFO | x | zz", "soon | ERROR | x | y"]
    logged, seen = counted_text(spark, frame("source string, block long, seq long, value string", *[
        ("a", i, i, line) for i, line in enumerate(lines)]), "value")
    root = str(tmp_path / "log")
    logstore.store_log(parse_log(logged), root)
    assert seen.value == len(lines)
    found = manifest.tables_of(spark, root)[logstore.GRAMS].read(spark)
    want = {(part, line.lower()[i:i + 3], 0) for part, line in zip(("INFO|2024-01-01", "INFO|2024-01-02", "ERROR|"), lines)
            for i in range(len(line) - 2)}
    assert sorted(tuple(r) for r in found.select("part", "gram", "version").collect()) == sorted(want)


def test_an_index_reads_each_text_once_and_has_a_file_per_folder(spark, frame, tmp_path):
    from rostrum.sinks import postings

    rows = [(i, "T", " ".join(["b", "a", "b"] + [f"w{i}"] * (i % 3))) for i in range(40)] + [(50, None, None), (None, "x", "y z")]
    speeches, seen = counted_text(spark, frame("id long, title string, full_text string", *rows), "full_text")
    root = str(tmp_path / "index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        postings.store_index(speeches, root, buckets=8, block_documents=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert seen.value == len(rows)  # the one without an id for its words alone
    kept = manifest.tables_of(spark, root)
    stored = kept[postings.POSTINGS].read(spark)
    folders = [f.rsplit("/", 1)[0] for f in stored.inputFiles()]
    assert len(folders) == len(set(folders))
    want = {(term, i, n, 4 + i % 3) for i in range(40) for term, n in (("a", 1), ("b", 2), ("t", 1), (f"w{i}", i % 3)) if n}
    assert sorted(tuple(r) for r in stored.select("term", "id", "tf", "words").collect()) == sorted(want)
    assert tuple(kept[postings.FIGURES].read(spark).first()) == (42, sum(4 + i % 3 for i in range(40)) + 3)


def test_rows_that_share_an_id_have_their_words_together(spark, frame, tmp_path):
    from rostrum.sinks import postings

    root = str(tmp_path / "index")
    rows = [(1, None, "a b"), (1, None, "a c d"), (2, None, "a"), (None, None, "a a"), (None, None, "b")]
    postings.store_index(frame("id long, title string, full_text string", *rows), root, buckets=8, block_documents=2)
    kept = manifest.tables_of(spark, root)
    want = [("a", 1, 2, 2), ("a", 1, 2, 3), ("a", 2, 1, 1), *((t, 1, 1, n) for t in "bcd" for n in (2, 3))]
    assert sorted(tuple(r) for r in kept[postings.POSTINGS].read(spark).select("term", "id", "tf", "words").collect()) == want
    assert tuple(kept[postings.FIGURES].read(spark).first()) == (5, 9)
