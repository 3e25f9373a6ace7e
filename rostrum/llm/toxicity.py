"""Toxicity by Levenshtein automata over a lexicon trie (operator 3).

Every word of a text walks the lexicon's trie together with its Levenshtein automaton, whose state is
one row of edit distances: branches with no reachable distance are cut. The words around a hit
tell quotation from abuse. A small logistic model turns the counts into a score.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import fields, held_out, record_batch, table, text_slices
from rostrum.session import materialize

#: Plain insults that start the lexicon; labelled texts add to it.
SEEDS = ("idiot", "moron", "scum", "clown", "worthless", "pathetic", "stupid", "loser", "trash", "disgusting")
QUOTING = frozenset(("said", "says", "word", "term", "called", "quote", "quoted", "wrote", "insult", "means", "defined"))
ADDRESS = frozenset(("you", "your", "youre", "yours", "u", "ur"))
QUOTES = "\"'“”‘’«»„`"
TOKEN = re.compile(r"\S+")
NAMES = ("exact", "near", "quoted", "addressed", "close", "share")
FEATURES = fields("doc_id long, " + ", ".join(f"{n} double" for n in NAMES))


def build_trie(terms) -> dict:
    root: dict = {}
    for term in terms:
        node = root
        for c in term:
            node = node.setdefault(c, {})
        node[""] = term
    return root


def walk(trie: dict, word: str, limit: int) -> tuple[int, str] | None:
    """The nearest term within `limit` edits as (distance, term); ties go to the first by name."""
    best: tuple[int, str] | None = None
    stack = [(trie, list(range(len(word) + 1)))]
    while stack:
        node, row = stack.pop()
        term = node.get("")
        if term is not None and row[-1] <= limit and (best is None or (row[-1], term) < best):
            best = (row[-1], term)
        for c, child in node.items():
            if not c:
                continue
            after = [row[0] + 1]
            for j, w in enumerate(word, 1):
                after.append(min(row[j - 1] + (w != c), row[j] + 1, after[j - 1] + 1))
            if min(after) <= limit:
                stack.append((child, after))
    return best


class Matcher:
    """Words against a lexicon, one edit allowed from five letters on; remembers what it has seen."""

    def __init__(self, terms, remember: int = 200_000):
        self.terms, self.trie, self.remember = frozenset(terms), build_trie(terms), remember
        self.seen: dict[str, int] = {}
        # With one edit, the first or the second half of a term is intact: others need no walk.
        self.heads = {t[:len(t) // 2] for t in self.terms}
        self.tails = {t[len(t) // 2:] for t in self.terms}
        self.head_sizes, self.tail_sizes = sorted({len(h) for h in self.heads}), sorted({len(t) for t in self.tails})

    def distance(self, word: str) -> int:
        """0 or 1, or -1 for no term."""
        if word in self.terms:
            return 0
        if len(word) < 5 or not (
            any(word[:n] in self.heads for n in self.head_sizes) or any(word[-n:] in self.tails for n in self.tail_sizes)
        ):
            return -1
        if word not in self.seen:
            if len(self.seen) >= self.remember:
                self.seen.clear()
            hit = walk(self.trie, word, 1)
            self.seen[word] = hit[0] if hit and len(hit[1]) >= 5 else -1
        return self.seen[word]

    def features(self, text: str | None, window: int = 8) -> list[float]:
        raw = TOKEN.findall((text or "").lower())
        words = [t.strip(".,;:!?()[]{}<>*#$%&|_-" + QUOTES) for t in raw]
        hits = [(i, d) for i, w in enumerate(words) if (d := self.distance(w)) >= 0]
        exact = near = quoted = addressed = close = 0
        for n, (i, d) in enumerate(hits):
            around = words[max(0, i - window):i + window + 1]
            in_quotes = raw[i][0] in QUOTES or raw[i][-1] in QUOTES or any(w in QUOTING for w in around)
            quoted += in_quotes
            exact += d == 0 and not in_quotes
            near += d == 1 and not in_quotes
            addressed += any(w in ADDRESS for w in around)
            close += n > 0 and i - hits[n - 1][0] <= 4 * window
        return [np.log1p(v) for v in (exact, near, quoted, addressed, close)] + [len(hits) / max(1, len(words)) * 10]


def _features(terms):
    def run(batches):
        matcher = Matcher(terms)
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = [matcher.features(t) for t in part.column(1).to_pylist()]
                yield record_batch(FEATURES, {"doc_id": part.column(0), **{n: [r[i] for r in rows] for i, n in enumerate(NAMES)}})

    return run


def learn_lexicon(train: DataFrame, share: float = 0.04, lift: float = 8.0, limit: int = 500) -> list[str]:
    """Seeds and up to `limit` words (a report of the strongest) that mark toxic texts of `train` (text, toxic)."""
    word = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")
    totals = train.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    toxic, clean = totals["t"] or 0, totals["c"] or 0
    counts = train.select(word, "toxic").where(F.length("word").between(4, 24)).groupBy("word").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    strong = counts.where((F.col("t") >= max(3, share * toxic)) & (
        F.col("t") / max(toxic, 1) >= lift * (F.col("c") + 0.5) / max(clean, 1)))
    rows = strong.orderBy(F.desc("t"), "word").limit(limit).collect()
    return sorted({*SEEDS, *(r["word"] for r in rows)})


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Weights with the intercept last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        w -= np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), grad)
    return w


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """Per row (doc_id, held_out, score, predicted): whole texts against labels of rows not held out.

    The classifier is fitted on about `sample` labelled rows at most (the documented bound), chosen by
    a hash of the id; an id labelled twice is toxic if either says so, and one with several texts is learnt once, by its least features. Null and empty texts have no hits.
    Without labels of both kinds, any unquoted hit is toxic. Repeated rows are scored each.
    """
    out_of = held_out(F.col("doc_id"), 5, 0)
    usable = labels.where(~out_of & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = usable.count()
    chosen = materialize(usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1_000_000.0 * sample / max(total, 1)), "toxic-labels")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    terms = learn_lexicon(narrow.join(chosen, "doc_id").where(F.col("text").isNotNull()))
    found = materialize(narrow.mapInArrow(_features(terms), FEATURES), "toxic-features")
    rows = found.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(
        F.min(F.struct(*NAMES)).alias("f")).select("toxic", "f.*").collect()
    y = np.array([r["toxic"] for r in rows], dtype=float)
    if len(set(y.tolist())) == 2:
        w = fit_logistic(np.array([[r[n] for n in NAMES] for r in rows]), y)
    else:
        w = np.array([4.0, 4.0, 0.0, 0.0, 0.0, 0.0, -2.0])
    line = F.lit(float(w[-1]))
    for n, v in zip(NAMES, w, strict=False):
        line = line + F.col(n) * F.lit(float(v))
    score = 1.0 / (1.0 + F.exp(-line))
    return found.select("doc_id", out_of.alias("held_out"), score.alias("score"), *NAMES).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
