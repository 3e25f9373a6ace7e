"""Runs and removal of repeated passages."""

from __future__ import annotations

import random

import pytest

from rostrum.llm import spans


def sentence(name: str, n: int) -> str:
    return " ".join(f"{name}{i}" for i in range(n)) + ". "


def test_empty_and_short_texts_have_no_run():
    assert spans.runs("", 2, 20) == [] and spans.runs(sentence("a", 19), 2, 20) == []
    assert [r[:2] for r in spans.runs(sentence("a", 20), 2, 20)] == [(0, 1)]


@pytest.mark.parametrize("sizes", [(60,), (18, 20, 16, 3), (3, 18, 5), (25, 2), (2, 25)])
def test_a_repeated_passage_goes_from_first_to_last_sentence(spark, sizes):
    passage = "".join(sentence(f"p{k}x", n) for k, n in enumerate(sizes))
    around = [sentence(f"{side}{doc}x", 9) for doc in (1, 2) for side in "ab"]
    rows = [(1, around[0] + passage + around[1]), (2, around[2] + passage + around[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in spans.remove_repeats(docs).collect()}
    assert got == {1: rows[0][1], 2: around[2] + around[3]}


def brute(rows):
    """The texts with every run cut that has an earlier place, by one pass over all documents."""
    first, cut = {}, {}
    places = {(doc, text) for doc, text in rows if text}
    for doc, text in places:
        for at, width, span in spans.runs(text, 2, 20):
            first.setdefault(span, []).append((doc, text, at, width))
    for found in first.values():
        ids = {(doc, text) for doc, text, _, _ in found}
        assert len({doc for doc, _ in ids}) == len(ids)  # so that the id alone gives the order
        least = min((doc, at) for doc, _, at, _ in found)
        for doc, text, at, width in found:
            if (doc, at) != least:
                cut.setdefault((doc, text), set()).update(range(at, at + width))
    return sorted((doc, text if (doc, text) not in cut else "".join(
        s for i, s in enumerate(spans.sentences(text)) if i not in cut[doc, text])) for doc, text in rows)


@pytest.mark.parametrize("hot", [False, True])
def test_query_equals_brute_force(spark, frame, tmp_path, monkeypatch, hot):
    rng = random.Random(11)
    pool = [sentence(f"p{i}x", rng.randint(1, 30)) for i in range(60)]
    common = sentence("allx", 25) + sentence("ally", 7)
    rows = []
    for doc in range(160):
        parts = [rng.choice(pool) if rng.random() < 0.5 else sentence(f"d{doc}s{i}x", rng.randint(1, 30)) for i in range(rng.randint(0, 12))]
        if doc % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), common)
        rows.append((doc, "".join(parts)))
    rows += rows[:9]
    if hot:
        found = {r[2] for _, text in rows for r in spans.runs(text, 2, 20) if "allx" in text}
        monkeypatch.setattr(spans, "frequent_runs", lambda *_: found)
    frame("doc_id long, text string", *rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"], r["text"]) for r in spans.op4_substring_dedup(spark, str(tmp_path)).collect())
    assert got == brute(rows)
    assert got != sorted(rows)


def test_frequent_runs_are_found(spark, frame):
    common = sentence("allx", 25)
    docs = frame("id long, text_key long, text string", *[(i, i, sentence(f"d{i}x", 22) + common) for i in range(3000)])
    found = spans.frequent_runs(docs, 2, 20, most=5, part=4, rows=100)
    assert {r[2] for r in spans.runs(common, 2, 20)} <= found and len(found) <= 5


def test_cases(spark, frame):
    long = "".join(sentence(f"l{i}x", 12) for i in range(4000))
    passage = sentence("p", 30)
    schema = "id string, doc_id long, text string, _gone string, text_key string"
    rows = [("a", 1, passage, "g", "k"), ("a", 2, None, "g", None), ("a", 3, "", None, "k"), ("b", 4, passage, "g", "k"), ("b", 4, passage, "g", "k"),
            ("b", None, passage, "g", "k"), ("c", 5, long, "g", "k"), ("c", 6, long + "Ende.", "g", "k"), ("c", 7, passage + passage, "g", "k")]
    docs = frame(schema, *rows)
    out = spans.remove_repeats(docs)
    assert out.columns == docs.columns
    # A null id comes first and keeps the passage.
    gone = {1: "", 4: "", 6: "Ende.", 7: ""}
    want = [(*r[:2], gone.get(r[1], r[2]), *r[3:]) for r in rows]
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, want))
    assert spans.remove_repeats(docs.limit(0)).collect() == []
