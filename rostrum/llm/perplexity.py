"""Quality by perplexity under an interpolated modified Kneser-Ney model (operator 10).

The model is one of characters, trained on the text of documents labelled as good. Counts of
all n-grams, trusted and not, are one table spread by n-gram; joins over it give each n-gram of
the corpus its probability, and a pass over the texts sums those up to a perplexity per document.
Thresholds are quantiles per language.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import fields, held_out, mix, record_batch, table, text_slices
from rostrum.session import materialize

START, END = "\u0002", "\u0003"
GRAMS = fields("code long, gram string, n_trusted long, n_all long")
SUMS = fields("row long, n_chars long, log_prob double")
_MUL = np.random.default_rng(10).integers(1, 1 << 62, 16, dtype=np.uint64) | np.uint64(1)


def points(text: str | None, order: int) -> np.ndarray:
    """Code points of a text in lower case, white space as one space, with start and end marks;
    empty for a text without any other character."""
    line = " ".join((text or "").lower().split())
    if not line:
        return np.zeros(0, dtype=np.uint32)
    return np.frombuffer((START * (order - 1) + line + END).encode("utf-32-le", "surrogatepass"), dtype="<u4")


def gram_codes(joined: np.ndarray, order: int) -> np.ndarray:
    """64-bit code of the n-gram that starts at each place of `joined`."""
    count = max(0, len(joined) - order + 1)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(order):
        out += joined[k:k + count].astype(np.uint64) * _MUL[k]
    return mix(out).view(np.int64)


def _places(texts: list, order: int):
    """Codes and first places of all n-grams of some texts, and the count of each text's."""
    parts = [points(t, order) for t in texts]
    sizes = np.array([max(0, len(p) - order + 1) for p in parts], dtype=np.int64)
    joined = np.concatenate([*parts, np.zeros(0, dtype=np.uint32)])
    starts = np.cumsum([0, *(len(p) for p in parts)])[:-1]
    # Windows that begin inside a text's last order - 1 code points reach into the next one.
    inside = np.ones(max(0, len(joined) - order + 1), dtype=bool)
    for at, size, part in zip(starts, sizes, parts, strict=True):
        inside[at + size:at + len(part)] = False
    where = np.flatnonzero(inside)
    return joined, where, gram_codes(joined, order)[where], sizes


def _count(order: int, flush: int):
    """Counts per n-gram of a task's texts, given out when `flush` n-grams are held and at the end."""
    def run(batches):
        held: list[pd.DataFrame] = []

        def merged() -> pd.DataFrame:
            return pd.concat(held).groupby("code", sort=False, as_index=False).agg({"gram": "first", "n_trusted": "sum", "n_all": "sum"})

        for batch in batches:
            for part in text_slices(batch, "text"):
                joined, where, codes, sizes = _places(part.column(0).to_pylist(), order)
                if not len(codes):
                    continue
                trusted = np.repeat(np.asarray(part.column(1).to_pylist(), dtype=bool), sizes)
                index, unique = pd.factorize(codes)
                first = np.full(len(unique), len(codes), dtype=np.int64)
                np.minimum.at(first, index, np.arange(len(codes)))
                at = where[first]
                held.append(pd.DataFrame({
                    "code": unique,
                    "gram": [joined[i:i + order].tobytes().decode("utf-32-le", "replace") for i in at],
                    "n_trusted": np.bincount(index, weights=trusted, minlength=len(unique)).astype(np.int64),
                    "n_all": np.bincount(index, minlength=len(unique))}))
                if len(held) > 8:
                    held[:] = [merged()]
                    if len(held[0]) > flush:
                        out = held.pop()
                        yield record_batch(GRAMS, {n: out[n].to_numpy() for n in GRAMS.names})
        if held:
            out = merged()
            yield record_batch(GRAMS, {n: out[n].to_numpy() for n in GRAMS.names})

    return run


def _sums(order: int, shared):
    """n-grams and their summed log probability, per row, for one block of the n-gram table."""
    def run(batches):
        known, logs = shared.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                _, _, codes, sizes = _places(part.column(1).to_pylist(), order)
                total = np.zeros(len(sizes))
                if len(codes) and len(known):
                    index, unique = pd.factorize(codes)
                    at = np.minimum(np.searchsorted(known, unique), len(known) - 1)
                    value = np.where(known[at] == unique, logs[at], 0.0)[index]
                    ends = np.cumsum(sizes)
                    some = sizes > 0
                    total[some] = np.add.reduceat(value, (ends - sizes)[some])
                yield record_batch(SUMS, {"row": part.column(0), "n_chars": sizes, "log_prob": total})

    return run


def count_grams(docs: DataFrame, order: int = 5, flush: int = 1_000_000) -> DataFrame:
    """(code, gram, n_trusted, n_all) over all of `docs` (text, trusted)."""
    found = docs.select("text", "trusted").mapInArrow(_count(order, flush), GRAMS)
    return found.groupBy("code", "gram").agg(F.sum("n_trusted").alias("n_trusted"), F.sum("n_all").alias("n_all"))


def _discount(a: Column, d: list[float]) -> Column:
    return F.when(a >= 3, d[2]).when(a == 2, d[1]).when(a == 1, d[0]).otherwise(0.0)


def discounts(n: list[int]) -> list[float]:
    """The three discounts from the counts of counts n1..n4; 0.5, 1 and 1.5 where they can't be told."""
    if min(n) <= 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), float(k)) for k in (1, 2, 3)]


def log_probabilities(grams: DataFrame, order: int = 5) -> DataFrame:
    """(code, log_prob) of the last character given those before it, for every n-gram of `grams`.

    Below the highest order, an n-gram counts as often as different characters stand before it.
    An n-gram that trusted text lacks falls back to its shorter form with the weight of its context.
    Every join and aggregate is over different n-grams, by n-gram or context, never over the text.
    """
    counted = {order: grams.select("gram", F.col("n_trusted").alias("a"), "code")}
    for n in range(order - 1, 0, -1):
        counted[n] = materialize(counted[n + 1].groupBy(F.substring("gram", 2, n).alias("gram")).agg(
            F.sum((F.col("a") > 0).cast("long")).alias("a")), f"kn-counts-{n}")
    size = counted[1].count() + 1
    level: DataFrame | None = None
    for n in range(1, order + 1):
        figures = counted[n].agg(*[F.sum((F.col("a") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
        rest = _discount(F.col("a"), discounts([figures[f"n{k}"] or 0 for k in (1, 2, 3, 4)]))
        # A context has at most as many n-grams as there are characters.
        context = Window.partitionBy(F.substring("gram", 1, n - 1))
        out = counted[n].withColumn("rest", rest).withColumns({
            "total": F.sum("a").over(context), "left": F.sum("rest").over(context)}).withColumn("shorter", F.substring("gram", 2, n - 1))
        if level is None:
            out = out.withColumn("p", F.lit(1.0 / size))
        else:
            out = out.join(level.select(F.col("gram").alias("shorter"), "p"), "shorter")
        p = F.when(F.col("total") == 0, F.col("p")).otherwise(
            (F.col("a") - F.col("rest") + F.col("left") * F.col("p")) / F.col("total"))
        level = materialize(out.select("gram", *(["code"] if n == order else []), p.alias("p")), f"kn-level-{n}")
    return level.select("code", F.ln("p").alias("log_prob"))


def score_quality(
    docs: DataFrame, labels: DataFrame, order: int = 5, quantile: float = 0.99, margin: float = 1.15, block_grams: int = 2_000_000,
    broadcast_ids: int = 1_000_000,
) -> DataFrame:
    """Per row (doc_id, lang, held_out, n_chars, perplexity, threshold, kept) of `docs` (doc_id, text, lang).

    Trusted are the ids that `labels` calls good (quality 1, and nowhere 0). Four fifths of them
    by crc32 of the id are trained on; the threshold of a language is `margin` times the `quantile` of the
    perplexity of the others, over their rounded logarithms, and that of all languages where a language
    has none. Without any trusted text nothing is known and all texts are kept.
    A null, empty or blank text has no perplexity and isn't kept. A null lang is a language of its own; null ids
    are never trusted. Repeated rows are scored each; other columns are ignored; an empty table gives no rows.

    The n-gram table goes to the tasks in blocks of `block_grams` n-grams, with a pass over the texts each;
    its size follows the different n-grams of the corpus, not its length. Trusted ids are broadcast up to
    `broadcast_ids` (8 bytes each), which changes the plan and not the result.
    """
    good = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality")).where("quality = 1").select("doc_id", F.lit(True).alias("_good"))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out_of = held_out(F.col("doc_id"), 5, 0)
    # Up to this many ids are sent to the tasks; more are joined by a shuffle of the texts.
    if good.count() <= broadcast_ids:
        good = F.broadcast(good)
    marked = narrow.join(good, "doc_id", "left").select(
        "text", (F.coalesce("_good", F.lit(False)) & ~out_of).alias("trusted"))
    grams = materialize(count_grams(marked, order), "kn-grams")
    probs = log_probabilities(grams, order)
    blocks = max(1, -(-grams.count() // block_grams))
    spark, sums = docs.sparkSession, []
    # Equal texts may share an id or have none: sums of blocks meet by id and text hash.
    row = F.xxhash64("doc_id", "text", F.col("doc_id").isNull())
    for block in range(blocks):
        part = probs.where(F.pmod(F.xxhash64("code"), F.lit(blocks)) == block).toArrow()
        codes, logs = part.column("code").to_numpy(), part.column("log_prob").to_numpy()
        by_code = np.argsort(codes, kind="stable")
        shared = spark.sparkContext.broadcast((codes[by_code], logs[by_code]))
        sums.append(narrow.select(row.alias("row"), "text").mapInArrow(_sums(order, shared), SUMS))
    found = reduce(DataFrame.unionByName, sums).groupBy("row").agg(
        F.max("n_chars").alias("n_chars"), (F.sum("log_prob") / F.count(F.lit(1)) * blocks).alias("log_prob"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", row.alias("row"))
    found = keyed.join(found, "row").select(
        "doc_id", "lang", "n_chars", F.when(F.col("n_chars") > 0, F.round(-F.col("log_prob") / F.col("n_chars"), 9)).alias("cost"))
    found = materialize(found.join(good, "doc_id", "left"), "kn-scores")
    tested = found.where(F.col("_good") & out_of & F.col("cost").isNotNull()).select("lang", F.round("cost", 3).alias("cost"))
    by_lang = tested.groupBy("lang").agg(F.percentile("cost", quantile).alias("cut"))
    general = tested.agg(F.percentile("cost", quantile).alias("cut")).first()["cut"]
    limits = by_lang.select(F.col("lang").alias("_lang"), "cut")
    out = found.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    perplexity = F.round(F.exp("cost"), 6)
    threshold = F.round(F.exp(F.coalesce("cut", F.lit(general).cast("double"))) * margin, 6)
    return out.select("doc_id", "lang", out_of.alias("held_out"), "n_chars", perplexity.alias("perplexity"), threshold.alias("threshold"),
                      (F.col("cost").isNotNull() & (threshold.isNull() | (perplexity <= threshold))).alias("kept"))


def op10_kneser_ney(spark, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of all documents."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
