import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rostrum.llm import decontaminate as D


def stretches(item, text):
    """(edits, start, words) of every nearest stretch of `text`, by trying all."""
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
        return row[-1]

    found = [(edits(item, text[a:b]), a, b - a) for a in range(len(text) + 1) for b in range(a, len(text) + 1)]
    best = min(f[0] for f in found)
    return [f for f in found if f[0] == best]


@given(st.lists(st.integers(1, 3), min_size=1, max_size=8), st.lists(st.integers(0, 3), max_size=12))
@settings(max_examples=150, deadline=None)
def test_place_is_a_nearest_stretch(item, text):
    names = " ".join(f"w{c}" for c in item)
    items = D.block_of([(1, names)], 0.15, 2)
    codes = [items.number.get(f"w{c}", 0) for c in text]
    got = D.locate(items, 0, codes, 0, len(codes))
    assert got in stretches(items.codes[0].tolist(), codes)


@pytest.mark.parametrize("n", range(1, 80))
def test_allowed_edits_leave_the_sure_gram(n):
    k = D.limit(n, 0.15)
    q = D.sure_gram(n, k)
    # k cuts as even as can be leave the shortest longest stretch.
    places = [round((i + 1) * (n + 1) / (k + 1)) - 1 for i in range(k)]
    longest, run = 0, 0
    for i in range(n):
        run = 0 if i in places else run + 1
        longest = max(longest, run)
    assert 1 <= q <= max(longest, 1)


def edited(rng, words, k, vocab):
    words = list(words)
    for _ in range(k):
        at, kind = rng.randrange(len(words)), rng.choice("rid")
        if kind == "r":
            words[at] = rng.choice(vocab)
        elif kind == "i":
            words.insert(at, rng.choice(vocab))
        elif len(words) > 1:
            words.pop(at)
    return words


@pytest.mark.parametrize("share", [0, 0.5, 1])
def test_recall_up_to_the_edit_limit(share):
    """Planted items with as many edits as are allowed, all at once: at least nine in ten are found."""
    rng = random.Random(7)
    vocab = [f"v{i}" for i in range(400)]
    bench = [(i, " ".join(rng.choices(vocab, k=rng.randint(8, 60)))) for i in range(300)]
    items = D.block_of(bench, 0.15, 16)
    found = 0
    for i, text in bench:
        words = text.split()
        inside = edited(rng, words, int(share * D.limit(len(words), 0.15)), vocab)
        doc = rng.choices(vocab, k=rng.randint(0, 80)) + inside + rng.choices(vocab, k=rng.randint(0, 80))
        found += i in D.find_in(items, np.array([items.number.get(w, 0) for w in doc], dtype=np.int64))
    assert found >= (300 if share == 0 else 285)


def test_query_equals_brute_force(spark, frame, tmp_path):
    """All pairs by the plain edit distance; every found pair is right and no unedited item is missed."""
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(30)]
    bench = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 14)))) for i in range(12)]
    docs = []
    for i in range(40):
        words = rng.choices(vocab, k=rng.randint(0, 12))
        if rng.random() < 0.6:
            item = rng.choice(bench)[1].split()
            words += edited(rng, item, rng.randint(0, 2), vocab) + rng.choices(vocab, k=3)
        docs.append((i, " ".join(words)))
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", bench, "item_id")):
        frame(f"{key} long, text string", *rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = {(r["doc_id"], r["item_id"]): (r["distance"], r["start"], r["words"]) for r in D.op2_decontamination(spark, str(tmp_path)).collect()}
    want = {}
    for doc, text in docs:
        for item, named in bench:
            places = stretches(named.split(), text.split())
            if places[0][0] <= D.limit(len(named.split()), 0.15) and places[0][0] < len(named.split()):
                want[doc, item] = places
    assert set(got) <= set(want)
    assert len(got) >= 0.95 * len(want)
    assert {p for p, places in want.items() if places[0][0] == 0} <= set(got)
    for pair, place in got.items():
        assert place[0] >= want[pair][0][0] and (place[0] > want[pair][0][0] or place in want[pair])


def test_cases(spark, frame):
    item = "Wie viele Wörter hat diese Frage, und welche Antwort stimmt?"
    docs = frame(
        "item_id string, doc_id long, text string, words string",
        ("x", 1, "Vorher. " + item.upper() + " Nachher.", "y"), ("x", 2, None, "y"), ("x", 3, "", "y"), ("x", None, item, None),
        ("x", 1, "nichts davon", "y"), ("x", 4, item + " " + item, "y"), ("x", 5, "wort " * 30_000 + item, "y"))
    bench = frame("doc_id string, item_id long, text string", ("a", 7, item), ("a", 8, None), ("a", 9, "!?"), ("a", None, item), ("a", 7, item))
    got = D.find_items(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == {(d, i, 0) for d in (1, None, 4, 5) for i in (7, None)}
    assert len(got) == 4 * 3  # repeated items match each
    assert {(r["start"], r["words"]) for r in got if r["doc_id"] == 5} == {(30_000, 10)}
    assert D.find_items(docs.limit(0), bench).collect() == [] and D.find_items(docs, bench.limit(0)).collect() == []
    # Rows that share a contaminated id all go; a null id stays.
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in D.drop_contaminated(docs, bench).collect()))) == sorted(
        map(str, [(2, None), (3, ""), (None, item)]))
    assert D.drop_contaminated(docs, bench).columns == docs.columns
    # Blocks of the benchmark give the same rows.
    one_each = D.find_items(docs, bench, block_items=1).collect()
    assert sorted(map(str, one_each)) == sorted(map(str, got))
