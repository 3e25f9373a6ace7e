"""Dataset and feed sources: S2, S3, J16, U3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import dates, people, urls
from rostrum.functions.basic import strip
from rostrum.operators.blocked import running_count, running_sum
from rostrum.sources.runlogs import read_log

CSV_COLUMNS = "date STRING, speakers STRING, title STRING, subtitle STRING, contents STRING"
FEED_COLUMNS = "link STRING, title STRING, pubDate STRING"
FEED_PATHS = ("/press/key/", "/press/inter/")


def csv_records(lines: DataFrame) -> DataFrame:
    """Records of quoted text files from their lines (source, block, seq, value): (source, record_no, record).

    A line that ends inside quotes goes on in the next one. Quotes are counted per block, the few block sums are added
    up in order, and each line knows from its own block whether it begins a record, so a file is read in as many
    tasks as it has splits, and a record may cross them. Lines that are records of their own are not shuffled again
    to be put together. Records are numbered from 1 in each file.
    """
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"')))).cast("long")
    counted = running_sum(lines.withColumn("_quotes", quotes), "source", "block", "seq", F.col("_quotes"), "_upto")
    begins = (F.col("_upto") - F.col("_quotes")) % 2 == 0
    numbered = running_count(counted, "source", "block", "seq", begins, "record_no")
    whole = (F.col("_quotes") % 2 == 0) & ((F.col("_upto") - F.col("_quotes")) % 2 == 0)
    alone = numbered.where(whole).select("source", "record_no", F.col("value").alias("record"))
    pieces = numbered.where(~whole).groupBy("source", "record_no").agg(
        F.sort_array(F.collect_list(F.struct("block", "seq", "value"))).alias("_lines"))
    joined = pieces.select("source", "record_no", F.array_join(F.transform("_lines", lambda p: p["value"]), "\n").alias("record"))
    return alone.unionByName(joined)


def read_speech_csv(spark: SparkSession, path: str, year: int | None = None, scheme: str = "ecb") -> DataFrame:
    """The pipe-separated dataset with full text, in as many tasks as its files have splits. The first record of a
    file is its header."""
    records = csv_records(read_log(spark, path)).where((F.col("record_no") > 1) & (F.trim("record") != ""))
    options = {"sep": "|", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    raw = records.select(F.from_csv("record", F.lit(CSV_COLUMNS), options).alias("r")).select("r.*")
    return dataset_rows(raw, year, scheme)


def dataset_rows(raw: DataFrame, year: int | None = None, scheme: str = "ecb") -> DataFrame:
    """Rows (date, speakers, title, subtitle, contents) -> candidates.

    A row needs its third field; later ones may be missing. A row without a date that can
    be read is dropped.
    """
    def field(name: str):
        return strip(F.coalesce(F.col(name), F.lit("")))

    rows = raw.where(F.col("title").isNotNull()).select(
        dates.parse_date(F.col("date"), "dataset").alias("date"),
        field("speakers").alias("speaker"),
        field("title").alias("bare_title"),
        field("subtitle").alias("subtitle"),
        field("contents").alias("full_text"),
    ).where(F.col("date").isNotNull())
    if year is not None:
        rows = rows.where(F.year("date") == year)
    return rows.select(
        F.when(F.col("subtitle") != "", F.concat_ws(" - ", "bare_title", "subtitle"))
        .otherwise(F.col("bare_title")).alias("title"),
        "date",
        urls.slug_url(F.lit(scheme), F.col("date"), F.col("bare_title")).alias("url"),
        "speaker",
        "full_text",
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """S3: items of feed files."""
    return feed_rows(spark.read.format("xml").option("rowTag", "item").schema(FEED_COLUMNS).load(path))


def feed_rows(items: DataFrame) -> DataFrame:
    """S3: feed items (link, title, pubDate) -> candidates; only speech and interview links."""
    link, title = strip(F.col("link")), strip(F.coalesce(F.col("title"), F.lit("")))
    wanted = link.contains(FEED_PATHS[0]) | link.contains(FEED_PATHS[1])
    return items.where(wanted).select(
        title.alias("title"),
        dates.parse_rfc822(F.col("pubDate")).alias("date"),
        link.alias("url"),
        people.speaker_from_title(title, F.lit("ECB")).alias("speaker"),
    )


def dataset_and_feed(dataset: DataFrame, feed: DataFrame) -> DataFrame:
    """The dataset plus the feed rows whose URL it does not have."""
    new = feed.join(dataset.select("url").distinct(), "url", "left_anti").dropDuplicates(["url"])
    return dataset.unionByName(new, allowMissingColumns=True)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Candidates of page, dataset and feed sources in one typed relation."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
