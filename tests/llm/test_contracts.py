"""Registered queries of operators 1, 3, 5, 6 and 9 against plain passes over small tables, and their cases."""

import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest

from rostrum.llm import licences, packing, quality_rules, queries, sharding, toxicity

VOCAB = [f"wort{i}" for i in range(400)]


def documents(rng, n):
    rows = []
    for i in range(n):
        words = rng.choices(VOCAB, k=rng.choice([0, 1, 5, 40, 300]))
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[7][1]) for i in range(n // 3)]  # a third of all rows is one text
    return rows


# --- operator 1 -----------------------------------------------------------------------------


@pytest.mark.parametrize("slice_items", [8192, 150])
def test_shards_place_every_row_once_and_evenly(spark, frame, slice_items):
    rows = documents(random.Random(1), 900)
    docs = frame("doc_id long, text string", *rows)
    got = sharding.pack_shards(docs, 16, slice_items=slice_items, lots=16).collect()
    sizes = {(i, zlib.crc32(t.encode())): len(t.encode()) + 1 for i, t in rows}
    assert sorted((r["doc_id"], r["text_crc32"], r["size"]) for r in got) == sorted((*k, v) for k, v in sizes.items())
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r)
    assert set(by_shard) <= set(range(16))
    assert all(sorted(r["slot"] for r in rs) == list(range(len(rs))) for rs in by_shard.values())
    loads = [sum(r["size"] for r in rs) for rs in by_shard.values()]
    assert max(loads) <= 1.1 * sum(loads) / 16 and min(loads) >= 0.9 * sum(loads) / 16
    groups = defaultdict(set)
    for r in got:
        groups[r["text_key"], r["part"]].add(r["shard"])
    assert all(len(s) == 1 for s in groups.values())


def test_shards_of_odd_rows(spark, frame):
    schema = "shard string, doc_id long, text string, size string"
    rows = [("a", 1, None, "x"), ("a", 1, None, "x"), ("b", None, "", None), ("b", 2, "ä" * 200_000, "x"), ("b", 3, "ä", "x")]
    got = sharding.shard_documents(frame(schema, *rows)).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted([("1", 1), ("1", 1), ("None", 1), ("2", 400_001), ("3", 3)])
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    assert sharding.shard_documents(frame(schema)).collect() == []


# --- operator 3 -----------------------------------------------------------------------------


def toxic_corpus(rng, n):
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(VOCAB, k=60)
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                term = rng.choice(["schurke", "hallunke"])
                cut = rng.randrange(1, len(term))
                words.insert(rng.randrange(len(words)), "du " + (term if rng.random() < 0.5 else term[:cut] + term[cut + 1:]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1 if bad else 0))
    return docs, labels


def test_toxicity_on_held_out_rows(spark, frame):
    docs, labels = toxic_corpus(random.Random(3), 800)
    got = toxicity.score_documents(frame("doc_id long, text string", *docs), frame("doc_id long, toxic int", *labels)).collect()
    assert len(got) == len(docs)
    truth = dict(labels)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in got if r["held_out"]]
    bad, good = [r["score"] for r in held if truth[r["doc_id"]]], [r["score"] for r in held if not truth[r["doc_id"]]]
    auc = sum((a > b) + 0.5 * (a == b) for a in bad for b in good) / (len(bad) * len(good))
    assert auc >= 0.95
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.9 * len(held)


def test_toxicity_cases(spark, frame):
    docs, labels = toxic_corpus(random.Random(4), 200)
    schema = "score string, doc_id long, text string, toxic string"
    rows = [("x", *d, "y") for d in docs] + [("x", None, "du schurke", None), ("x", 900, None, None), ("x", 901, "", "y"), ("x", 0, "anders", "y"),
                                            ("x", 902, "wort " * 60_000, "y"), ("x", 902, "wort " * 60_000, "y")]
    marks = frame("doc_id long, toxic int", *labels, (None, 1), (1, None), (0, 0))
    got = toxicity.score_documents(frame(schema, *rows), marks).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (900, 901)}
    assert len(blank) == 1 and blank.pop() < 0.5
    assert toxicity.score_documents(frame(schema), marks).collect() == []
    unlabelled = toxicity.score_documents(frame(schema, *rows), marks.limit(0)).collect()
    assert len(unlabelled) == len(rows)


# --- operator 5 -----------------------------------------------------------------------------


def test_licences_are_inherited_from_the_nearest_folder(spark, frame):
    files = frame(
        "path string, text string, is_licence_file boolean, licence string",
        ("r/LICENSE", "Released under the MIT License", True, "clash"), ("r/a/x.py", "code", False, None), ("r/a/b/LICENSE", "Licensed under CC BY 4.0", True, None),
        ("r/a/b/c/y.py", "x\nSPDX-License-Identifier: Apache-2.0\ny", False, None), ("r/a/b/c/z.py", None, None, None), ("s/w.py", "", False, None),
        (None, "Licensed under CC BY 4.0", True, None), ("r/a/x.py", "code", False, None))
    got = {(r["path"], r["licence"], r["via"]) for r in licences.inherit(files.dropDuplicates(["path"]), licences.notices(files)).collect()}
    assert got == {
        ("r/LICENSE", "MIT", "own"), ("r/a/x.py", "MIT", "inherited"), ("r/a/b/LICENSE", "CC-BY-4.0", "own"),
        ("r/a/b/c/y.py", "Apache-2.0", "own"), ("r/a/b/c/z.py", "CC-BY-4.0", "inherited"), ("s/w.py", None, "none"), (None, None, "none")}


def test_licence_query_cases(spark, frame):
    schema = "licence string, doc_id long, text string, source string, path string"
    rows = [("x", 1, None, None, "p"), ("x", 2, "", "a", "p"), ("x", 3, "All rights reserved\n" + "zeile\n" * 50_000, "a", "p"),
            ("x", 1003, "nichts", "a", None), ("x", 3, "All rights reserved", "a", "p")]
    got = {(r["doc_id"], r["licence"], r["via"]) for r in licences.scan_documents(frame(schema, *rows)).collect()}
    assert got == {(1, None, "none"), (2, "Proprietary", "inherited"), (3, "Proprietary", "own"), (1003, "Proprietary", "inherited")}
    assert licences.scan_documents(frame(schema)).collect() == []


# --- operator 6 -----------------------------------------------------------------------------


def test_packing_is_an_exact_round_trip(spark, frame):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(VOCAB, k=rng.choice([0, 3, 60, 900])))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "so <|endoftext|> da"), (63, "täglich 漢字 " * 9000), (5, rows[5][1])]
    docs = frame("sequence_id string, doc_id long, text string, start string", *[("x", i, t, "y") for i, t in rows])
    got = packing.pack_sequences(docs, slice_items=40).collect()
    encode = packing.encoder()
    import numpy as np

    whole = {i: np.array([*encode(t or ""), 0], dtype="<u4") for i, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        ids = whole[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(ids.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(whole[r["doc_id"]])
    for doc, ids in whole.items():
        copies = 2 if doc == 5 else 1
        covered = Counter(at for r in by_doc[doc] for at in range(r["start"], r["start"] + r["length"]))
        assert covered == {at: copies for at in range(len(ids))}
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    total = sum(len(whole[i]) for i, _ in rows)
    assert len(by_sequence) <= total / 1024 + 4  # less than one padded sequence per slice
    assert packing.pack_sequences(docs.limit(0)).collect() == []


# --- operator 9 -----------------------------------------------------------------------------


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_rules_equal_a_plain_pass(spark, frame):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice(["a ", "b ", "c\t", "lang ", "\n", "x# ", "ü|ü ", "a b c d e "]) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(None, "eins zwei"), (200, None), (201, ""), (202, " \n\n\t"), (202, "a b c d e f g h i j k"), (203, "s" * 100_000)]
    docs = frame("kept string, doc_id long, text string, n_words string", *[("x", i, t, "y") for i, t in rows])
    got = quality_rules.rule_verdicts(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(map(str, ((r["doc_id"], *(r[n] for n in names)) for r in got))) == sorted(map(str, ((i, *measured(t)) for i, t in rows)))
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality_rules.rule_verdicts(docs.limit(0)).collect() == []
    book = quality_rules.ledger(docs)
    table = {r["rule"]: r for r in quality_rules.ablations(book).collect()}
    few = [r for r in book.collect() if r["failures"] & 1]
    assert table["few_words"]["failing"] == len(few) and table["few_words"]["only_this"] == sum(r["failures"] == 1 for r in few)


def test_quality_rules_grow_with_the_text(spark, frame):
    """Twenty times the words take about twenty times the time, not four hundred times."""
    def seconds(n):
        rng = random.Random(n)
        docs = frame("doc_id long, text string", (1, " ".join(rng.choices("abcdefgh", k=n))))
        start = time.perf_counter()
        quality_rules.rule_verdicts(docs).collect()
        return time.perf_counter() - start

    seconds(1_000)  # warm
    assert seconds(80_000) < 20 * max(seconds(4_000), 0.5)


# --- all ------------------------------------------------------------------------------------


def test_every_operator_is_registered_once():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(names)
