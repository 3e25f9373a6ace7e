"""Substring deduplication by sliding sentence spans (operator 4).

Shortest runs of consecutive sentences, and long single ones, are hashed; runs are joined over all
documents, and sentences covered by a repeated run other than its first are removed.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import fields, record_batch, table, text_slices
from rostrum.session import materialize

#: A sentence ends at white space behind a full stop, question or exclamation mark, or at a line break.
BORDER = re.compile(r"(?<=[.!?])\s+|\n\s*")
#: The hash of a run is `high` and `low`; `part` splits the rows of a very frequent run.
SPANS = fields("id long, text_key long, at int, width int, high long, low long, part int")


def sentences(text: str) -> list[str]:
    """The text cut behind each border; joined again they give the text."""
    cuts = [0, *(m.end() for m in BORDER.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def runs(text: str, least: int, words: int) -> list[tuple[int, int, bytes]]:
    """(start, sentences, hash) of the shortest run that starts, and of the shortest that ends, at every
    sentence. A run has `words` words, in one sentence or in at least `least`. Runs depend on nothing
    outside them, so equal passages have equal runs, which cover them from first to last sentence."""
    split = [s.lower().encode("utf-8", "surrogatepass").split() for s in sentences(text)]
    sizes = [len(s) for s in split]

    def reach(order: range) -> int:
        """How many sentences of `order` a run needs; 0 if they do not suffice."""
        n = 0
        for k, i in enumerate(order, 1):
            n += sizes[i]
            if n >= words and (k == 1 or k >= least):
                return k
        return 0

    found = {(i, k) for i in range(len(split)) if (k := reach(range(i, len(split))))}
    found |= {(i - k + 1, k) for i in range(len(split)) if (k := reach(range(i, -1, -1)))}
    return [(i, k, xxhash.xxh3_128_digest(b" ".join(w for s in split[i:i + k] for w in s))) for i, k in sorted(found)]


def _spans(least: int, words: int, frequent=None, parts: int = 1):
    def run(batches):
        hot = frequent.value if frequent else ()
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows, hashes = [], []
                for doc, key, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for at, width, span in runs(text or "", least, words):
                        hashes.append(span)
                        # Behind 0, the parts of a frequent run are 1 and more.
                        rows.append((doc, key, at, width, 1 + key % parts if span in hot else 0))
                halves = np.frombuffer(b"".join(hashes), ">i8").reshape(-1, 2)
                columns = {n: [r[i] for r in rows] for i, n in enumerate(("id", "text_key", "at", "width", "part"))}
                yield record_batch(SPANS, columns | {"high": halves[:, 0].astype("i8"), "low": halves[:, 1].astype("i8")})

    return run


def frequent_runs(docs: DataFrame, least: int, words: int, most: int = 1_000, part: int = 16, rows: int = 200) -> set[bytes]:
    """The hashes of at most `most` runs that fill the most rows, `rows` at least in a hash sample of one text in `part`.

    The sample only decides how rows are dealt to tasks, never what is found: a run it misses fills
    less than a `most`-th of all rows.
    """
    drawn = docs.where(F.pmod(F.xxhash64("id", "text_key"), F.lit(part)) == 0)
    counts = drawn.mapInArrow(_spans(least, words), SPANS).groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= rows)
    return {np.array([r["high"], r["low"]], ">i8").tobytes() for r in counts.orderBy(F.desc("n"), "high", "low").limit(most).collect()}


def _cut(text: str | None, gone: list | None) -> str | None:
    if not gone or text is None:
        return text
    dropped = {k for at, width in gone for k in range(at, at + width)}
    return "".join(s for k, s in enumerate(sentences(text)) if k not in dropped)


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", least: int = 2, words: int = 20,
                   parts: int = 64) -> DataFrame:
    """`docs` with repeated passages cut from the text; columns and rows stay, the text may become empty.

    The first place of a run, by id, text hash and position, keeps it. Rows equal in id and text
    are one document and stay equal. A passage goes in whole sentences: what it has of a sentence it
    begins or ends in the middle of stays, and so does a passage without a run inside. Null and empty texts have no runs
    and stay; a null id comes first.

    Runs are shuffled once, by their hash; a task walks them in order of place and keeps the rank alone. The rows of a
    run that a sample shows to be very frequent are dealt to `parts` places by text; the first of each is then
    compared with the others, a few thousand rows in all.
    """
    text, key = F.col(f"`{text_col}`"), F.xxhash64(F.col(f"`{text_col}`"))
    ident = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63)))
    narrow = docs.select(ident.alias("id"), key.alias("text_key"), text.alias("text"))
    hot = docs.sparkSession.sparkContext.broadcast(frequent_runs(narrow, least, words))
    spans = narrow.mapInArrow(_spans(least, words, hot, parts), SPANS)
    place = ("id", "text_key", "at")
    ranked = spans.withColumn("_rank", F.rank().over(Window.partitionBy("high", "low", "part").orderBy(*place)))
    ranked = materialize(ranked.where((F.col("_rank") > 1) | (F.col("part") > 0)), "span-ranked")
    firsts = ranked.where("_rank = 1").withColumn("_all", F.rank().over(Window.partitionBy("high", "low").orderBy(*place)))
    covered = ranked.where("_rank > 1").select("id", "text_key", "at", "width").unionByName(
        firsts.where("_all > 1").select("id", "text_key", "at", "width"))
    gone = covered.groupBy("id", "text_key").agg(F.collect_set(F.struct("at", "width")).alias("_gone"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, None if g is None else [(r["at"], r["width"]) for r in g]) for t, g in zip(texts, lists, strict=True)], dtype=object)

    # One column of its own beside the input's, so that no name of theirs can clash.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("_row"),
                        ident.alias("id"), key.alias("text_key"))
    joined = keyed.join(gone, ["id", "text_key"], "left")
    return joined.select(*[
        (cut(F.col(f"_row.c{i}"), F.col("_gone")) if c == text_col else F.col(f"_row.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents with their repeated passages removed."""
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "text")
