"""Kneser-Ney perplexity against a brute-force model, and its edge cases."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from rostrum.llm import perplexity

ORDER = 3
GOOD = ["the cat sat on the mat", "a cat and a dog sat", "the dog ran to the cat", "on a mat the dog sat and sat"]
OTHER = ["zq%% ##|| the", "the mat", "The   Mat"]


def model(texts, everything):
    """log p of each n-gram, straight from the definition with dictionaries."""
    def grams(text):
        line = " ".join(text.lower().split())
        line = perplexity.START * (ORDER - 1) + line + perplexity.END
        return [line[i:i + ORDER] for i in range(len(line) - ORDER + 1)]

    counts = {ORDER: Counter(g for t in texts for g in grams(t))}
    for n in range(ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    size = len({g[-1] for t in everything for g in grams(t)}) + 1
    cuts, total, left = {}, defaultdict(float), defaultdict(float)
    for n in counts:
        of = Counter(counts[n].values())
        cuts[n] = perplexity.discounts([of[k] for k in (1, 2, 3, 4)])
        for g, c in counts[n].items():
            total[n, g[:-1]] += c
            left[n, g[:-1]] += cuts[n][min(c, 3) - 1]

    def p(gram):
        if not gram:
            return 1 / size
        n = len(gram)
        if (n, gram[:-1]) not in total:
            return p(gram[1:])
        c = counts[n][gram]
        own = c - cuts[n][min(c, 3) - 1] if c else 0.0
        return (own + left[n, gram[:-1]] * p(gram[1:])) / total[n, gram[:-1]]

    return lambda text: math.exp(-sum(math.log(p(g)) for g in grams(text)) / len(grams(text)))


def frames(spark, rows, good):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality string, row string, code int")
    labels = spark.createDataFrame([(i, q) for i, q in good], "doc_id long, quality int")
    return docs, labels


@pytest.mark.parametrize("block", [10, 1_000_000])
def test_equals_brute_force_in_any_number_of_blocks(spark, block):
    import zlib

    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:len(GOOD)]
    rows = [(i, t, "en", "x", "y", 1) for i, t in zip(ids, GOOD, strict=True)]
    rows += [(1000 + k, t, "en", None, None, None) for k, t in enumerate(OTHER)]
    docs, labels = frames(spark, rows, [(i, 1) for i in ids])
    got = {r["doc_id"]: r["perplexity"] for r in perplexity.score_quality(docs, labels, order=ORDER, block_grams=block).collect()}
    want = model(GOOD, GOOD + OTHER)
    assert got == {r[0]: pytest.approx(want(r[1]), rel=1e-5) for r in rows}


def test_probabilities_of_a_context_sum_to_one(spark):
    import pandas as pd

    texts = GOOD + OTHER
    docs = spark.createDataFrame(pd.DataFrame({"text": texts, "trusted": [True] * len(GOOD) + [False] * len(OTHER)}))
    grams = perplexity.count_grams(docs, ORDER)
    rows = perplexity.log_probabilities(grams, ORDER).join(grams, "code").collect()
    sums = defaultdict(float)
    for r in rows:
        sums[r["gram"][:-1]] += math.exp(r["log_prob"])
    assert rows and max(sums.values()) <= 1 + 1e-9


def test_nulls_empty_repeated_and_unlabelled(spark):
    rows = [(1, None, "en", "a", "b", 1), (2, "", "en", "a", "b", 1), (3, " \n", None, "a", "b", 1), (None, "the cat", None, "a", "b", 1),
            (4, "the cat", "en", "a", "b", 1), (4, "the cat", "en", "a", "b", 1), (5, "the cat " * 3000, "en", "a", "b", 1)]
    docs, labels = frames(spark, rows, [(4, 1), (None, 1), (5, None)])
    got = perplexity.score_quality(docs, labels).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"] for r in got if r["perplexity"] is None} == {1, 2, 3}
    assert not any(r["kept"] for r in got if r["perplexity"] is None)
    assert len({r["perplexity"] for r in got if r["doc_id"] in (4, None)}) == 1
    none = perplexity.score_quality(docs, labels.limit(0)).collect()
    assert all(r["kept"] for r in none if r["n_chars"])
    assert perplexity.score_quality(docs.limit(0), labels).count() == 0


def test_junk_goes_and_held_out_good_text_stays(spark):
    from rostrum.llm.common import table

    small = "/root/testdata/sf0.001"
    scored = perplexity.op10_kneser_ney(spark, small)
    rows = scored.join(table(spark, small, "labels"), "doc_id").select("kept", "held_out", "quality").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.95 * len(good)
    assert sum(bad) <= 0.5 * len(bad)
