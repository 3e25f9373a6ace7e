"""A stored term index: Q6, J13, R7.

Postings lie in folders by the hash of their term; beside them is a row per term and block of documents with the most
occurrences and the fewest words of its postings, which bounds the score of any document of the block. A search reads
the folders of its own terms, and with a limit only the blocks whose bound reaches the best found so far. Batches of
new documents are added as further folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions.basic import let
from rostrum.operators import search
from rostrum.session import materialize
from rostrum.sinks import manifest
from rostrum.sinks.manifest import Published

POSTINGS, BLOCKS, FIGURES = "postings", "blocks", "figures"
BUCKETS = 64
BLOCK_DOCUMENTS = 4096
SLICE_DOCUMENTS = 32 * BLOCK_DOCUMENTS


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _counted(words: Column) -> Column:
    """The distinct words of a document with their numbers: sorted, a word's number is where the next one begins."""
    def runs(ordered: Column, starts: Column) -> Column:
        return F.transform(starts, lambda at, i: F.struct(
            F.element_at(ordered, at).alias("term"),
            (F.coalesce(F.get(starts, i + 1), F.size(ordered) + 1) - at).cast("long").alias("tf")))

    def begins(ordered: Column) -> Column:
        places = F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.size(ordered))).otherwise(F.array().cast("array<int>"))
        return F.filter(places, lambda at: (at == 1) | (F.element_at(ordered, at) != F.element_at(ordered, F.greatest(at - 1, F.lit(1)))))

    return let(F.sort_array(words), lambda ordered: let(begins(ordered), lambda starts: runs(ordered, starts)))


def store_index(speeches: DataFrame, root: str, version: int = 0, buckets: int = BUCKETS, block_documents: int = BLOCK_DOCUMENTS) -> None:
    """Publish the index of `speeches` (id, title, full_text); with `version` above 0 they are added to those before.

    A batch's documents are dealt by hash to blocks of about `block_documents`. A term that every document has is
    spread over the tasks by its blocks. Documents are counted whole; one without a word counts as a document.

    A document's words are counted within its row, so that postings are shuffled once, to their folder. A folder has a
    file per `SLICE_DOCUMENTS`, not one per block. Only rows that share an id are brought together: their occurrences are
    summed, and each row has a posting with its own number of words.
    """
    spark = speeches.sparkSession
    n = speeches.count()
    block = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // block_documents)))) + F.lit(version << 32)
    repeated = materialize(
        speeches.where(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id"), "index-repeated")
    single, several = speeches.where(F.col("id").isNotNull()), None
    if not repeated.isEmpty():
        several = speeches.join(repeated, "id", "left_semi")
        single = single.join(repeated, "id", "left_anti")
    tokens = search.tokens(search._document(F.col("title"), F.col("full_text")))
    # `inline` keeps the tokenizer from being evaluated once for each use.
    counted = single.select("id", F.inline(let(tokens, lambda w: F.array(F.struct(
        F.size(w).cast("long").alias("words"), _counted(w).alias("terms"))))))
    postings = counted.select("id", "words", F.inline("terms"))
    if several is not None:
        together = search.build_term_index(several).join(search.document_lengths(several), "id")
        postings = postings.unionByName(together.select("id", F.col("words").cast("long").alias("words"), "term", "tf"))
    postings = postings.select("term", block.alias("block"), "id", "tf", "words")
    old = manifest.tables_of(spark, root, version - 1) if version else {}
    slices = F.lit(max(1, -(-n // SLICE_DOCUMENTS)))

    def stored(df: DataFrame) -> Published:
        keyed = df.withColumn("_bucket", _bucket(F.col("term"), buckets))
        ordered = keyed.repartition("_bucket", F.pmod("block", slices)).sortWithinPartitions("_bucket", "term", "block")
        return Published(df.schema, manifest.write_parts(ordered, root, "_bucket"))

    new = {POSTINGS: stored(postings)}
    new[BLOCKS] = stored(new[POSTINGS].read(spark).groupBy("term", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("tf").alias("most"), F.min("words").alias("fewest")))
    # Documents without an id have words, but no postings; those that share one have the postings of all.
    apart = speeches.where(F.col("id").isNull())
    kept = new[POSTINGS].read(spark)
    if several is not None:
        kept, apart = kept.join(repeated, "id", "left_anti"), apart.unionByName(several.select(apart.columns))
    words = kept.select(F.col("tf").alias("words")).unionByName(
        search.document_lengths(apart).select(F.col("words").cast("long"))).agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    if old:
        new = {name: Published(table.schema, old[name].parts + table.parts) for name, table in new.items()}
    total = spark.createDataFrame([(n, words)], "n long, words long")
    new[FIGURES] = Published(total.schema, (*(old[FIGURES].parts if old else ()), manifest.write_part(total, root)))
    manifest.publish(spark, root, version, new)


def _read(spark: SparkSession, root: str, name: str, terms: list[str], buckets: int) -> DataFrame:
    table = manifest.tables_of(spark, root)[name]
    rows = spark.createDataFrame([(t,) for t in terms], "term string").select(_bucket(F.col("term"), buckets).cast("string").alias("b"))
    keys = {r["b"] for r in rows.collect()}  # a word of the query each
    return table.read(spark, sorted(keys)).where(F.col("term").isin(*terms))


def search_stored(spark: SparkSession, root: str, keyword: str, limit: int | None = None, buckets: int = BUCKETS, first: int = 4) -> DataFrame:
    """(id, score) of the documents with every word of the query, best first, as `search.search` has them.

    With a limit the `first` most promising blocks are scored, and then those others whose bound is not below the
    limit's last score: what is left out can't be among the best. The blocks of a query come to the driver as
    numbers with their bounds, one for some thousand documents.
    """
    terms = search.query_terms(keyword)
    if not terms:
        return spark.range(0).select("id", F.lit(0.0).alias("score"))
    n, words = manifest.tables_of(spark, root)[FIGURES].read(spark).agg(F.sum("n"), F.sum("words")).first()
    mean = words / max(n, 1)
    blocks = _read(spark, root, BLOCKS, terms, buckets)
    found_in = blocks.groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.broadcast(found_in.select("term", search._idf(F.col("df"), F.lit(n)).alias("idf")))  # a row per word of the query
    postings = _read(spark, root, POSTINGS, terms, buckets)

    def scored(chosen: list[int] | None) -> DataFrame:
        rows = postings if chosen is None else postings.where(F.col("block").isin(chosen))
        part = search._term_score(F.col("idf"), F.col("tf"), F.col("words"), F.lit(mean))
        whole = rows.join(idf, "term").groupBy("id").agg(F.sum(part).alias("score"), F.count(F.lit(1)).alias("terms"))
        return whole.where(F.col("terms") == len(terms)).select("id", "score")

    if limit is None:
        return search._ranked(scored(None), None)
    bound = search._term_score(F.col("idf"), F.col("most"), F.col("fewest"), F.lit(mean))
    bounds = blocks.join(idf, "term").groupBy("block").agg(F.sum(bound).alias("bound"), F.count(F.lit(1)).alias("terms")).where(
        F.col("terms") == len(terms)).select("block", "bound").collect()
    ranked = sorted(bounds, key=lambda r: (-r["bound"], r["block"]))
    chosen = [r["block"] for r in ranked[:first]]
    best = materialize(search._ranked(scored(chosen), limit), "index-best")
    last = best.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score")).first()
    # Fewer than asked for: nothing may be left out. A sum of parts may differ from a bound in its last digits.
    floor = last["score"] * (1 - 1e-9) if last["n"] >= limit else float("-inf")
    more = [r["block"] for r in ranked[first:] if r["bound"] >= floor]
    return search._ranked(best.unionByName(scored(more)) if more else best, limit)
