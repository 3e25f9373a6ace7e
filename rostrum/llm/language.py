"""Language identification by nearest centroid (operator 7).

A text is the normalised TF-IDF vector of its letter n-grams (1 to 3, hashed). Each language has
several centroids from spherical k-means; the highest cosine decides, and a text far from all is rejected.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import fields, held_out, mix, record_batch, table, text_slices

DIMS = 1 << 13
UNKNOWN = "und"
PREDICTED = fields("doc_id long, doc_lang string, lang_pred string, score double, rejected boolean")


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of letter 1-, 2- and 3-grams of a whole text; None without a letter.

    Runs of other characters are one word border, which takes part in the n-grams.
    """
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return None
    points = np.where(letter, points, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    one = np.concatenate([[32], points[keep], [32]])
    two = one[:-1] * 0x110000 + one[1:]
    three = two[:-1] * 0x110000 + one[2:]  # may wrap: it is only hashed
    grams = np.concatenate([one, -two, three]).astype(np.uint64)
    return np.bincount((mix(grams) & np.uint64(DIMS - 1)).astype(np.int64), minlength=DIMS)


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighed = np.log1p(counts) * idf
    return weighed / max(np.linalg.norm(weighed), 1e-12)


def _doc_freq(batches):
    """Partial document frequencies: one row per bucket and task; bucket -1 counts texts."""
    total, n = np.zeros(DIMS, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0):  # one text at a time as a Python string
            counts = ngram_counts(text.as_py())
            if counts is not None:
                total += counts > 0
                n += 1
    schema = fields("bucket int, df long")
    yield record_batch(schema, {"bucket": list(range(-1, DIMS)), "df": [n, *total.tolist()]})


def floors(cosines: np.ndarray, own: np.ndarray, k: int, slack: float, low: float = 0.01) -> np.ndarray:
    """`slack` times the `low` quantile of the cosines of each centroid's own members; 1 without any."""
    return np.array([slack * np.quantile(cosines[own == i], low) if (own == i).any() else 1.0 for i in range(k)])


def nearest(model: dict, text: str | None) -> tuple[str, float, bool]:
    """(language, cosine, rejected) of a text."""
    counts = ngram_counts(text)
    if counts is None or not model["langs"]:
        return UNKNOWN, 0.0, True
    near = model["centroids"] @ vector(counts, model["idf"])
    lang = model["langs"][int(np.argmax(near))]
    same = np.array([x == lang for x in model["langs"]])
    return lang, float(np.clip(near.max(), 0, 1)), not (near >= model["floors"])[same].any()


def _cluster(idf: np.ndarray, k: int, rounds: int, slack: float):
    """Spherical k-means over the sample of one language; rows (lang, centroid, floor)."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "text"])
        counts = [c for c in map(ngram_counts, frame["text"]) if c is not None]
        if not counts:
            # Typed, as a column without a value has no type of its own.
            return pd.DataFrame({"lang": pd.Series([], dtype=object), "centroid": pd.Series([], dtype=object), "floor": pd.Series([], dtype=float)})
        rows = np.stack([vector(c, idf).astype(np.float32) for c in counts])
        # Farthest-first seeding, then Lloyd steps with cosine.
        seeds = [0]
        while len(seeds) < min(k, len(rows)):
            seeds.append(int(np.argmin((rows @ rows[seeds].T).max(axis=1))))
        centres = rows[seeds]
        for _ in range(rounds):
            own = np.argmax(rows @ centres.T, axis=1)
            sums = np.stack([rows[own == i].sum(axis=0) if (own == i).any() else centres[i] for i in range(len(centres))])
            centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        near = rows @ centres.T
        return pd.DataFrame({
            "lang": frame["lang"].iloc[0], "centroid": [c.astype("<f4").tobytes() for c in centres],
            "floor": floors(near.max(axis=1), np.argmax(near, axis=1), len(centres), slack)})

    return run


def fit(train: DataFrame, per_lang: int = 400, k: int = 4, rounds: int = 8, slack: float = 0.5) -> dict:
    """The model of `train` (text, lang): idf, languages, centroids and rejection floors.

    Document frequencies count all rows of `train`. Centroids are fitted on a sample of about
    `per_lang` different texts per language (the documented bound), chosen by a hash of the text. A text is
    rejected when no centroid of its nearest language is as near as `slack` times the lowest hundredth of
    the cosines of that centroid's own sample texts, so that a few odd texts do not move the floor.
    Rows without a language or without a letter teach nothing; no rows give a model that rejects all.
    """
    known = train.where(F.col("lang").isNotNull())
    freq = known.select("text").mapInArrow(_doc_freq, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df"))
    df = {r["bucket"]: r["df"] for r in freq.collect()}  # DIMS + 1 rows
    n = df.get(-1, 0)
    idf = np.array([np.log((1 + n) / (1 + df.get(b, 0))) + 1.0 for b in range(DIMS)])
    keyed = known.select("text", "lang", F.xxhash64("text").alias("key"))
    # The draw is of different texts, so its share counts those, not rows.
    sizes = keyed.select("lang", "key").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    keyed = keyed.join(F.broadcast(sizes), "lang")
    sample = keyed.where(F.pmod("key", F.lit(1_000_000)) < 1_000_000.0 * per_lang / F.col("_n")).select("lang", "text", "key")
    # Equal texts have one key: they count once, so copies do not swell the sample.
    sample = sample.dropDuplicates(["lang", "key"])
    rows = sorted(
        (r.lang, r.floor, r.centroid) for r in sample.groupBy("lang").applyInPandas(
            _cluster(idf, k, rounds, slack), "lang string, centroid binary, floor double").collect())
    return {
        "idf": idf, "langs": [r[0] for r in rows], "floors": np.array([r[1] for r in rows]),
        "centroids": np.stack([np.frombuffer(r[2], "<f4") for r in rows]) if rows else np.zeros((0, DIMS), np.float32)}


def _predict(model):
    def run(batches):
        m = model.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                out = [nearest(m, text) for text in part.column(1).to_pylist()]
                yield record_batch(PREDICTED, {
                    "doc_id": part.column(0), "doc_lang": part.column(2), "lang_pred": [r[0] for r in out],
                    "score": [r[1] for r in out], "rejected": [r[2] for r in out]})

    return run


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """Per row (doc_id, doc_lang, lang_pred, score, rejected); text alone decides.

    Null texts and texts without a letter are `und`, score 0, rejected. Equal cosines go to the
    first language by name. Repeated rows are predicted each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages * k * DIMS floats
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("doc_lang")).mapInArrow(
        _predict(shared), PREDICTED)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents; a third of them is held out from learning."""
    docs = table(spark, sf_dir, "documents")
    out_of = held_out(F.col("doc_id"), 3, 1)
    model = fit(docs.where(~out_of).select("text", "lang"))
    return predict(docs, model).select("doc_id", out_of.alias("held_out"), "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame) -> DataFrame:
    """Rows of `docs` whose text is not rejected, learnt from `docs` themselves; all columns stay.

    Null texts, texts without a letter, and all texts where no row has a language to learn from are rejected.
    Rows with a null id teach nothing but are judged; repeated rows are judged alike; columns of
    any further names pass through.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"), 3, 1)).select("text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        return pd.Series([not nearest(shared.value, text)[2] for text in texts], dtype=bool)

    return docs.where(known(F.col("text")))
