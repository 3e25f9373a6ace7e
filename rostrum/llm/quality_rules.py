"""Quality rules as a bitmask ledger (operator 9).

Every rule is evaluated once per document. The ledger keeps the measurements and one failure
bit per rule; a policy is a mask of the rules it enforces, so a new policy version, or the
question what a rule alone removes, is a bitwise operation on stored rows and never reads a
text again. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.basic import let
from rostrum.llm.common import NOT_SPACE, SPACE

SPACES = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurements; its bit is its place in RULES."""

    name: str
    fails: str


#: The order fixes the bits: append, never reorder. Ratios are in whole numbers, so that no
#: verdict depends on floating point.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("symbols", "100 * n_symbols > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 25 * n_words"),
    Rule("few_letters", "100 * n_letters < 50 * word_chars"),
    Rule("upper_case", "100 * n_upper > 60 * n_letters"),
)

#: Versioned policies: the rules that remove a document.
POLICIES = {
    "v1": ("few_words", "repeated_words"),
    "v2": ("few_words", "repeated_words", "duplicate_lines", "symbols", "short_words", "long_words", "few_letters",
           "upper_case"),
}
BASE = ("few_words", "repeated_words")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")


def mask_of(rules: tuple[str, ...], known: tuple[Rule, ...] = RULES) -> int:
    """The bits of named rules."""
    names = [r.name for r in known]
    return sum(1 << names.index(r) for r in rules)


def _repeat_words(hashes: Column, n: int) -> Column:
    """Words covered by windows of `n` words that occur at least twice.

    Windows are compared by a 64-bit hash. (hash, position) pairs are sorted, so that equal windows
    are neighbours; the positions with an equal neighbour, in order, cover n words each less
    their overlap with the next. Both sorted arrays are bound to a value (`let`): an expression
    inside a lambda is computed again for every element. Two sorts are the dearest steps.
    """
    def covered(places: Column) -> Column:
        gaps = F.zip_with(places, F.slice(places, 2, F.size(places)), lambda p, q: F.least(F.coalesce(q - p, F.lit(n)), F.lit(n)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)

    def twins(pairs: Column) -> Column:
        def same(p: Column, k: Column) -> Column:
            return F.coalesce(F.get(pairs, k)["h"] == p["h"], F.lit(False))

        marked = F.filter(pairs, lambda p, k: same(p, k - 1) | same(p, k + 1))
        return F.sort_array(F.transform(marked, lambda p: p["i"]))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(pairs, twins), covered)


def measure(docs: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """The input's columns and the measurements of each text (long).

    A null text counts as an empty one: all measurements are 0. A text of any length is
    measured whole, in its own row; nothing is shuffled. Columns of the input that have the name of a
    measurement are replaced.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in MEASURES]
    names = [c for c in docs.columns if c not in MEASURES]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    staged = docs.select(*keep, text.alias("_text"))
    staged = staged.select(
        "*",
        F.filter(F.split("_text", SPACE), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(NOT_SPACE)).alias("_lines"),
        F.translate("_text", SPACES, "").alias("_dense"),
        F.regexp_replace("_text", r"[^\p{L}]+", "").alias("_letters"),
    )
    staged = staged.select(
        *[F.col(f"`{c}`") for c in names], "_text", "_words", "_lines",
        F.length("_dense").cast("long").alias("word_chars"),
        F.length("_letters").cast("long").alias("n_letters"),
        F.length(F.regexp_replace("_letters", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.when(
            F.size("_words") >= window,
            F.transform(F.sequence(F.lit(1), F.size("_words") - (window - 1)),
                        lambda i: F.xxhash64(F.slice(F.col("_words"), i, F.lit(window)))),
        ).otherwise(F.array().cast("array<bigint>")).alias("_hashes"),
    )
    repeats = F.when(F.size(F.array_distinct("_hashes")) == F.size("_hashes"), F.lit(0).cast("long")).otherwise(
        _repeat_words(F.col("_hashes"), window))
    return staged.select(
        *[F.col(f"`{c}`") for c in names],
        F.size("_words").cast("long").alias("n_words"), "word_chars",
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"), "n_letters", "n_upper",
    )


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, measurements, `failures`): every rule evaluated once, bit i set where rule i fails.

    Rows are kept one to one, repeated rows and null ids included.
    """
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(rules)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    narrow = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_source_text"))
    measured = measure(narrow, "_source_text").drop("_source_text")
    return measured.withColumn("failures", total)


def apply_policy(book: DataFrame, policy: str = "v2", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows with `policy`, `enforced` (the failures that count) and `kept`."""
    enforced = F.col("failures").bitwiseAND(F.lit(mask_of(POLICIES[policy], rules)).cast("long"))
    return book.withColumn("policy", F.lit(policy)).withColumn("enforced", enforced).withColumn(
        "kept", F.col("enforced") == 0)


def ablations(book: DataFrame, policy: str = "v2", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents failing it, documents only it removes, documents left without it.

    One pass: the ledger is first counted by its enforced bits (at most one row per
    combination of rules), and the rules are compared with those few rows by bitwise and.
    An empty ledger gives zeros.
    """
    mask = mask_of(POLICIES[policy], rules)
    masks = book.groupBy(F.col("failures").bitwiseAND(F.lit(mask).cast("long")).alias("m")).agg(
        F.count(F.lit(1)).alias("n"))
    per_rule, names = [], [r.name for r in rules]
    for name in POLICIES[policy]:
        bit = 1 << names.index(name)
        per_rule.append(F.struct(
            F.lit(name).alias("rule"),
            F.coalesce(F.sum(F.when(F.col("m").bitwiseAND(F.lit(bit).cast("long")) != 0, F.col("n"))), F.lit(0)).alias("failing"),
            F.coalesce(F.sum(F.when(F.col("m") == bit, F.col("n"))), F.lit(0)).alias("only_this"),
            F.coalesce(F.sum(F.when((F.col("m") == 0) | (F.col("m") == bit), F.col("n"))), F.lit(0)).alias("kept_without"),
        ))
    return masks.agg(F.array(*per_rule).alias("r")).select(F.inline("r"))


def rule_verdicts(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger under a policy, with the base verdict: the query's form of the operator.

    `base_failed`: fewer than 10 words, or over a fifth of the words in repeated windows.
    """
    out = apply_policy(ledger(docs), policy)
    base = F.col("failures").bitwiseAND(F.lit(mask_of(BASE)).cast("long")) != 0
    return out.select(
        "doc_id", *MEASURES, "failures", "policy", "enforced", base.alias("base_failed"), (F.col("kept") & ~base).alias("kept"),
    )


#: DuckDB form of the registered query.
SQL = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        regexp_replace(text, '[^\p{L}]+', '', 'g') AS letters FROM t),
g AS (SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
h AS (SELECT r, i, list_slice(words, i, i + 4) AS gram FROM g),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM h),
p AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM c WHERE n > 1),
s AS (SELECT r, sum(least(coalesce(nxt - i, 5), 5)) AS n_repeat_words FROM p GROUP BY r),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(length(letters) AS BIGINT) AS n_letters,
        CAST(length(regexp_replace(letters, '[^\p{Lu}]+', '', 'g')) AS BIGINT) AS n_upper
      FROM w LEFT JOIN s USING (r)),
b AS (SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT
        + 4 * (100 * n_dup_lines > 30 * n_lines)::INT + 8 * (100 * n_symbols > 20 * n_words)::INT
        + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 25 * n_words)::INT
        + 64 * (100 * n_letters < 50 * word_chars)::INT + 128 * (100 * n_upper > 60 * n_letters)::INT AS BIGINT) AS failures FROM m)
SELECT *, 'v2' AS policy, failures AS enforced, (failures & 3) <> 0 AS base_failed, failures = 0 AS kept FROM b
"""
