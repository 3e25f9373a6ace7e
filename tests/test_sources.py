"""Readers and page extraction on small files and pages."""

from pyspark.sql import functions as F

from rostrum.sources import datasets, pages, runlogs, tables



def card(tag, css, day, href, title, kinds, author=""):
    """One result of a list page, with markup nested around its parts."""
    who = f'<div class="by"><a href="/profile/{author.lower().replace(" ", "-")}/"><b>{author}</b></a></div>' if author else ""
    labels = "".join(f"<li><a>{k}</a></li>" for k in kinds)
    return (f'<{tag} class="{css}"><div><span class="media-date">{day}</span></div><div><h5><a href="{href}"><i>{title}</i></a></h5>{who}'
            f"<ul>{labels}</ul></div></{tag}>")


def table_row(day, who, href, title):
    return f'<tr class="odd"><td><span>{day}</span></td><td>{who}</td><td><p><a href="{href}">{title}</a></p></td></tr>'


CARDS = [
    card("article", "mtt-result", "September 9, 2031", "/2031/09/bread-and-rents/", "Bread, rents and what a basket leaves out", ["Lectures"], "Nadia Okafor"),
    card("div", "media wide", "June 2, 2031", "/2031/06/payments-panel/", "A panel on payments in small towns", ["Lectures", "Webcasts"]),
    card("div", "media", "May 30, 2031", "/multimedia/2031/05/clip/", "Clip of the morning session", ["Remarks"]),
    card("div", "media", "May 30, 2031", "/2031/05/brief/", "In brief", ["Remarks"]),
    card("div", "media", "May 4, 2031", "/2031/05/housing/", "What more houses can and cannot do", ["Press", "Opening statements"], "Ilse Brandt"),
]
CARD_PAGE = "<body>" + card(
    "div", "media", "July 1, 2031", "/2031/07/museum/", "Holiday hours of the money museum", ["Remarks"]) + f"<main><div>{''.join(CARDS)}</div></main></body>"
TABLE_PAGE = "<div><table>" + "".join([
    table_row("Nov.&nbsp;3,&nbsp; 2031", "ARAI Midori, Counsellor", "/en/koen_2031/a1103.htm", "Wages in the\n service trades"),
    table_row("Oct. 12, 2031", "Tomas Lindqvist", "https://elsewhere.example/koen/notes.htm", "Cash after the floods"),
    table_row("Sep. 1, 2031", "-", "/en/koen_2031/index.htm", "All talks of the year"),
    table_row("Aug. 8, 2031", "-", "/en/koen_all/x.htm", "All talks of all years"),
    table_row("Aug. 8, 2031", "-", "/en/statistics/x.htm", "Tables of the month"),
]) + "</table></div>"


def rule(bank):
    return next(r for r in pages.RULES if r.bank_code == bank)


def test_list_pages(frame):
    listed = frame("page_id long, bank_code string, url string, html string", (1, "BOC", "u", CARD_PAGE), (2, "BOJ", "u", TABLE_PAGE),
                   (3, "BOJ", "u", "<p>no table</p>"))
    rows = {(r["bank_code"], r["title"]): (str(r["date"]), r["speaker"], r["speech_type"], r["url"].split("/", 3)[-1])
            for r in pages.all_page_links(listed, year=2031).collect()}
    # Dropped: a card outside the main part, a webcast, a clip, a short title; two lists and a page that is no talk.
    assert rows == {
        ("BOC", "Bread, rents and what a basket leaves out"): ("2031-09-09", "Nadia Okafor", "Lectures", "2031/09/bread-and-rents/"),
        ("BOC", "What more houses can and cannot do"): ("2031-05-04", "Ilse Brandt", "Opening statements", "2031/05/housing/"),
        ("BOJ", "Wages in the service trades"): ("2031-11-03", "Midori Arai", "speech", "en/koen_2031/a1103.htm"),
        ("BOJ", "Cash after the floods"): ("2031-10-12", "Tomas Lindqvist", "speech", "koen/notes.htm"),
    }


def test_page_text(frame):
    nested = '<body><div id="main"><div>in<div>ner</div></div><nav>menu</nav><p>A &amp; <b>B</b></p><!-- c --></div><div>after</div></body>'
    menu = "<main><div>About us</div><h2>Title</h2><p>Body</p><form>x</form></main>"
    sections = '<section>Search Options</section><section>The longest of all</section>'
    rows = frame(
        "page_id long, bank_code string, url string, html string",
        (1, "BOJ", "u", nested), (2, "BOC", "u", menu), (3, "ECB", "u", sections), (4, "FRB", "a.pdf?x", "<main>x</main>"),
        (5, "FRB", "u", "<body>none</body>"), (6, "??", "u", "<p>a</p>"),
    )
    got = {r["page_id"]: r["full_text"] for r in pages.page_texts(rows).collect()}
    assert got == {1: "in\nner\nA &\nB", 2: "Title\nBody", 3: "The longest of all", 4: None, 5: None, 6: None}


def test_search_form_is_no_text(value):
    assert value(pages.longest_section, "<section>Search Options</section>") is None
    assert value(pages.longest_section, "<section>first</section><section>other</section>") == "first"


def test_speech_csv(spark, tmp_path):
    path = tmp_path / "all.csv"
    path.write_text(
        "date|speakers|title|subtitle|contents\n"
        '2024-03-05|Jane Doe|Prices & Growth|at a place|"Text with | and ""quotes""\nsecond line"\n'
        "05/03/2023|Jane Doe|Only title\n"
        "soon|Jane Doe|No date|x|y\n"
        "2024-03-05|two fields\n"
    )
    rows = {r["title"]: r for r in datasets.read_speech_csv(spark, str(path)).collect()}
    assert set(rows) == {"Prices & Growth - at a place", "Only title"}
    full = rows["Prices & Growth - at a place"]
    assert full["full_text"] == 'Text with | and "quotes"\nsecond line'
    assert full["url"] == "ecb://speeches/2024-03-05/prices-growth"
    assert rows["Only title"]["full_text"] == "" and str(rows["Only title"]["date"]) == "2023-03-05"
    assert [r["title"] for r in datasets.read_speech_csv(spark, str(path), year=2023).collect()] == ["Only title"]


def test_speech_csv_over_splits(spark, tmp_path):
    """Records with line breaks, quotes and bars inside quotes, cut at every few bytes."""
    import random

    rng, rows = random.Random(1), []
    for i in range(120):
        body = "".join(rng.choice(["word ", "\n", "|", '"', "ü", "\n\n", " "]) for _ in range(rng.randint(0, 40)))
        rows.append((f"2024-01-{i % 28 + 1:02d}", f"Person {i}", f"Title {i}", "", body))
    lines = ["date|speakers|title|subtitle|contents"]
    lines += ["|".join([*r[:4], '"' + r[4].replace('"', '""') + '"']) for r in rows]
    for part in range(2):
        (tmp_path / f"part{part}.csv").write_text("\n".join([lines[0], *lines[1 + part::2]]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        read = datasets.read_speech_csv(spark, str(tmp_path))
        assert runlogs.read_log(spark, str(tmp_path)).rdd.getNumPartitions() > 8
        got = {r["title"]: (str(r["date"]), r["speaker"], r["full_text"]) for r in read.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {r[2]: (r[0], r[1], r[4].strip(" \t\n\r\x0b\x0c\u00a0")) for r in rows}


def test_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(
        "<rss><channel>"
        "<item><title>Speech by Jane Doe, Member: on money</title><link> https://e/press/key/1 </link>"
        "<pubDate>Thu, 16 Apr 2026 15:15:00 +0200</pubDate></item>"
        "<item><title>Press release</title><link>https://e/press/pr/2</link></item>"
        "<item><title>Interview with Ann Bee, X</title><link>https://e/press/inter/3</link><pubDate>later</pubDate></item>"
        "</channel></rss>"
    )
    rows = sorted(tuple(r) for r in datasets.read_feed(spark, str(tmp_path / "feed.xml")).select("url", "speaker", F.col("date").cast("string")).collect())
    assert rows == [("https://e/press/inter/3", "Ann Bee", None), ("https://e/press/key/1", "Jane Doe", "2026-04-16")]


def test_log_file_keeps_line_order(spark, tmp_path):
    lines = [f"2026-01-01 00:00:{i % 60:02d},000 | INFO | log | line {i} | n={i}" for i in range(500)]
    (tmp_path / "app.log").write_text("\n".join(["not a line", "", *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        parsed = runlogs.parse_log(runlogs.read_log(spark, str(tmp_path)))
        assert parsed.select("block").distinct().count() > 3
        order = [r["message"] for r in parsed.orderBy("source", "block", "seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert order == [f"line {i}" for i in range(500)]


def test_status_events(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"service": "s", "stage": "sync", "status": "success", "event_at": "2026-01-01T00:00:00", "synced_items": 3}\n')
    row = runlogs.read_status_events(spark, str(tmp_path)).first()
    assert row["stage"] == "sync" and row["synced_items"] == 3 and row["new_items"] is None


def test_dataset_and_feed(frame):
    dataset = frame("url string, title string, full_text string", ("a", "A", "t"))
    feed = frame("url string, title string", ("a", "again"), ("b", "B"), ("b", "B"))
    got = sorted((r["url"], r["title"], r["full_text"]) for r in datasets.dataset_and_feed(dataset, feed).collect())
    assert got == [("a", "A", "t"), ("b", "B", None)]


def test_year_slices_prune(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame("id long, bank_code string, date string", (1, "FRB", "2005-12-31"), (2, "FRB", "2006-01-01"), (3, "BOJ", "2018-01-01"),
          (4, "ECB", "2000-01-01"), (5, "ECB", None)).withColumn("date", F.col("date").cast("date")).write.parquet(path)
    out = tables.year_slices(spark.read.parquet(path), 2024)
    assert sorted(r["id"] for r in out.collect()) == [2, 4]
    assert sorted(r["id"] for r in tables.year_slices(spark.read.parquet(path), 2017, 2005).collect()) == [1, 2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2000-01-01)" in plan


def test_all_banks_are_read_in_one_scan(spark, frame, tmp_path):
    frame("page_id long, bank_code string, url string, html string", (1, "BOC", "u", CARD_PAGE)).write.parquet(str(tmp_path / "p"))
    plan = pages.all_page_links(spark.read.parquet(str(tmp_path / "p")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
