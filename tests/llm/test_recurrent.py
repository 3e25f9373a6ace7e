import random
import zlib
from collections import Counter

import numpy as np
import pytest

from rostrum.llm import recurrent
from rostrum.llm.recurrent import Model, Trainer, Words


def small(size=7, width=3, hidden=4, seed=1):
    rng = np.random.default_rng(seed)
    model = Model(size, width, hidden)
    model.flat[:] = rng.normal(0, 0.5, len(model.flat))
    model.wb.reshape(-1)[size:] = -80.0
    return model


def test_gradients_of_a_window():
    model, rng = small(), np.random.default_rng(2)
    source = rng.integers(0, 8, (5, 3))
    target = rng.integers(0, 8, (5, 3))
    h = rng.normal(0, 1, (3, 4)).astype(np.float32)
    _, _, grads = model.window(source, target, h)
    for name in ("x", "u", "c", "cb", "w", "wb"):
        values, got = getattr(model, name).reshape(-1), getattr(grads, name).reshape(-1)
        for at in rng.choice(len(values), min(12, len(values)), replace=False):
            old, eps = values[at], 1e-2
            values[at] = old + eps
            up = model.window(source, target, h)[0]
            values[at] = old - eps
            down = model.window(source, target, h)[0]
            values[at] = old
            assert got[at] == pytest.approx((up - down) / (2 * eps), abs=2e-3), (name, at)


def test_probabilities_of_all_words_sum_to_one():
    model = small()
    h = np.random.default_rng(3).normal(0, 1, (1, 4)).astype(np.float32)
    logs = [model.outputs(h, np.array([w]))[0][0] for w in range(8)]  # 7 words and the last class
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)


def test_start_is_the_unigram_model():
    words = Words([b"", b"a", b"b", b"c"], np.array([5, 9, 3, 1]), np.array([0, 1, 2, 3]), 3, 20, 6)
    model = Model.start(words, 2, 4)
    model.c[:] = 0
    logs = [model.outputs(np.ones((1, 4), np.float32), np.array([w]))[0][0] for w in range(4)]
    assert words.tail == 20 - 17 + 6 - 3 + 1
    assert np.exp(logs) == pytest.approx(np.array([6, 10, 4, words.tail]) / (20 + words.tail), rel=1e-4)


def test_whole_text_is_the_sum_of_its_steps():
    model, rng = small(), np.random.default_rng(4)
    texts = [np.array([*rng.integers(1, 8, n), 0]) for n in (0, 1, 40, 3, 40, 17)]
    want = []
    for t in texts:
        h, before, total = np.zeros((1, 4), np.float32), 0, 0.0
        for w in t:
            h = model.step(model.x[[before]], h)[0]
            total += model.outputs(h, np.array([w]))[0][0]
            before = w
        want.append(total)
    for block in (1, 5, 10_000):
        assert recurrent.log_likelihoods(model, texts, block) == pytest.approx(want, rel=1e-4)


def test_learns_an_order_that_counts_cannot_show():
    rng = np.random.default_rng(5)
    text = np.concatenate([np.append(np.tile([1, 2, 3], 5), 0) for _ in range(400)])
    words = Words([b"", b"a", b"b", b"c"], np.bincount(text), np.arange(4), 4, len(text), 4)
    model = Model.start(words, 2, 8)
    trainer = Trainer(model, 0.02)
    losses = [trainer.learn(text) for _ in range(12)]
    assert losses[-1] < 0.25 * losses[0]
    del rng


SCHEMA = "n_known string, doc_id long, base_score string, text string"


def corpus(n=420):
    rng, rows = random.Random(6), []
    for i in range(n):
        tongue = [f"{'pq'[i % 2]}{k}" for k in range(30)]
        out = [w for _ in range(rng.randint(1, 30)) for w in rng.choice([tongue[:3], tongue[3:6], [rng.choice(tongue)], [f"U{i}x{rng.random()}"]])]
        rows.append(("x", i, "y", " ".join(out)))
    return rows


def test_scores_against_counts(spark, frame, tmp_path):
    rows = [*corpus(), ("x", 1000, "y", None), ("x", 1001, None, " \n"), ("x", 2, "y", "one of two"), ("x", None, "y", "Q1 unseenword"),
            ("x", 1002, "y", " ".join(f"p{k % 30}" for k in range(40_000)))]
    frame(SCHEMA, *rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = recurrent.op13_recurrent_lm(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)

    def out_of(doc):
        return doc is None or zlib.crc32(str(doc).encode()) % 7 == 2

    def tokens(text):
        return [*(text or "").encode().lower().split(), b""]

    counts = Counter(w for _, doc, _, text in rows if not out_of(doc) for w in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    want = {}
    for _, doc, _, text in rows:
        base = sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens(text))
        want.setdefault(doc, []).append((out_of(doc), len(tokens(text)), sum(counts[w] > 0 for w in tokens(text)), total, base))
    for r in got:
        assert any((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4] and r["base_score"] == pytest.approx(w[4])
                   for w in want[r["doc_id"]])
        assert r["score"] < 0
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_are_scored_by_the_join(spark, frame):
    docs = frame("doc_id long, text string, held_out boolean", *[(i, f"a b a w{i % 5} u{i}", i % 4 == 3) for i in range(40)])
    whole = {r["doc_id"]: r for r in recurrent.score_texts(docs, known_words=100).collect()}
    joined = {r["doc_id"]: r for r in recurrent.score_texts(docs, known_words=4, model_words=4).collect()}
    for doc, r in whole.items():
        assert joined[doc]["n_known"] == r["n_known"]
        assert joined[doc]["base_score"] == pytest.approx(r["base_score"])
    # The model's own words are the same at both bounds, so the scores are.
    few = {r["doc_id"]: r["score"] for r in recurrent.score_texts(docs, known_words=100, model_words=4).collect()}
    assert {d: r["score"] for d, r in joined.items()} == pytest.approx(few, rel=1e-3)


def test_nothing_to_learn_from(spark, frame):
    docs = frame("doc_id long, text string, held_out boolean", (1, "a b", True), (2, None, True))
    got = {r["doc_id"]: r for r in recurrent.score_texts(docs).collect()}
    assert got[1]["n_tokens"] == 3 and got[1]["train_tokens"] == 0 and got[1]["base_score"] == 0 and got[1]["score"] <= 0
    assert recurrent.score_texts(docs.limit(0)).collect() == []
