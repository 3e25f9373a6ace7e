"""Keyword search: Q6, J13, R7."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.basic import let

K1, B = 1.2, 0.75
MIN_IDF = 1e-6
SEPARATORS = r"[^\p{L}\p{N}]+"


def _plain_letters() -> tuple[str, str]:
    """Accented Latin letters and the base letter of each, from the Unicode tables."""
    pairs = [
        (chr(c), unicodedata.normalize("NFD", chr(c))[0])
        for c in range(0xC0, 0x250)
        if len(unicodedata.normalize("NFD", chr(c))) > 1
    ]
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


def tokens(text: Column) -> Column:
    """Lower-case words without accents."""
    accented, plain = _plain_letters()
    folded = F.lower(F.translate(text, accented, plain))
    return F.filter(F.split(folded, SEPARATORS), lambda w: w != "")


def query_terms(keyword: str) -> list[str]:
    """Distinct words of a query, split like the text."""
    folded = "".join(
        unicodedata.normalize("NFD", c)[0] if 0xC0 <= ord(c) < 0x250 else c for c in keyword
    ).lower()
    return sorted({w for w in re.split(r"[\W_]+", folded) if w})


def _document(title: Column, text: Column) -> Column:
    return F.concat_ws("\n", title, text)


def build_term_index(speeches: DataFrame) -> DataFrame:
    """Q6: postings (term, id, tf) over title and text.

    Counting happens per document before the exchange on (term, id), so a term found in
    every document is spread over all partitions by the id in the key.
    """
    words = speeches.select("id", F.explode(tokens(_document(F.col("title"), F.col("full_text")))).alias("term"))
    return words.groupBy("term", "id").agg(F.count(F.lit(1)).alias("tf"))


def document_lengths(speeches: DataFrame) -> DataFrame:
    """Word count per document, for the ranking of an index."""
    return speeches.select("id", F.size(tokens(_document(F.col("title"), F.col("full_text")))).alias("words"))


def _occurrences(words: Column, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == term))


def _idf(found_in: Column, documents: Column) -> Column:
    raw = F.log((documents - found_in + F.lit(0.5)) / (found_in + F.lit(0.5)))
    return F.when(raw > 0, raw).otherwise(F.lit(MIN_IDF))


def _term_score(idf: Column, tf: Column, words: Column, mean_words: Column) -> Column:
    return idf * (tf * (K1 + 1)) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * words / mean_words))


def search(speeches: DataFrame, keyword: str, limit: int | None = None) -> DataFrame:
    """Documents with every word of the query, best first (BM25).

    One narrow pass counts the query's words per document; the collection figures are one
    row from a partial aggregate, used as scalar subqueries. Nothing is exploded and no
    text is shuffled.
    """
    terms = query_terms(keyword)
    if not terms:
        return speeches.where(F.lit(False)).select("id", F.lit(0.0).alias("score"))
    def count(words: Column) -> Column:
        per_term = [_occurrences(words, t).alias(f"tf{i}") for i, t in enumerate(terms)]
        return F.array(F.struct(F.size(words).alias("words"), *per_term))

    # `inline` keeps the filters below above the tokenizer: they would be evaluated by
    # tokenizing again if they were pushed into the scan.
    document = _document(F.col("title"), F.col("full_text"))
    counted = speeches.select("id", F.inline(let(tokens(document), count)))
    figures = counted.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.avg("words").alias("mean"),
            *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))],
        ).alias("figures")
    ).scalar()
    matching = counted
    for i in range(len(terms)):
        matching = matching.where(F.col(f"tf{i}") > 0)
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = _idf(figures[f"df{i}"], figures["n"])
        score = score + _term_score(idf, F.col(f"tf{i}"), F.col("words"), figures["mean"])
    return _ranked(matching.select("id", score.alias("score")), limit)


def search_index(index: DataFrame, lengths: DataFrame, keyword: str, limit: int | None = None) -> DataFrame:
    """J13, R7 over stored postings: only the postings of the query's words are read (the
    filter reaches the scan). Same ranking as `search`."""
    terms = query_terms(keyword)
    hits = index.where(F.col("term").isin(*terms))
    # One row per word of the query: small by construction.
    found_in = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    figures = lengths.agg(F.count(F.lit(1)).alias("n"), F.avg("words").alias("mean"))
    idf = _idf(F.col("df"), figures.select("n").scalar())
    scored = hits.join(F.broadcast(found_in), "term").join(lengths, "id").select(
        "id", _term_score(idf, F.col("tf"), F.col("words"), figures.select("mean").scalar()).alias("part")
    )
    whole = scored.groupBy("id").agg(F.sum("part").alias("score"), F.count(F.lit(1)).alias("terms"))
    return _ranked(whole.where(F.col("terms") == len(terms)).select("id", "score"), limit)


def _ranked(hits: DataFrame, limit: int | None) -> DataFrame:
    ranked = hits.orderBy(F.col("score").desc(), "id")
    return ranked if limit is None else ranked.limit(limit)
