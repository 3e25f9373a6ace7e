import random
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from rostrum.llm import near_dedup as N


def brute(rows, k, percent):
    """{doc_id: (set size, component)} by comparing all pairs of sets that share a shingle."""
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        width = min(k, len(words))
        sets.setdefault(doc, []).append(frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) if words else frozenset())
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    kinds = defaultdict(list)
    for d, found in sets.items():
        for s in found:
            if s:
                kinds[s].append(d)
    distinct = list(kinds)
    for ids in kinds.values():
        for d in ids[1:]:
            parent[max(root(d), root(ids[0]))] = min(root(d), root(ids[0]))
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            common = len(a & b)
            if 100 * common >= percent * (len(a) + len(b) - common) and common:
                x, y = root(kinds[a][0]), root(kinds[b][0])
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in sets}


def near_copies(rng, base, n, changed):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, changed)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10_000)}"
        out.append(" ".join(words))
    return out


def corpus(seed, groups, singles):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    texts = []
    for n, length, changed in groups:
        texts += near_copies(rng, rng.choices(vocab, k=length), n, changed)
    texts += [" ".join(rng.choices(vocab, k=rng.randint(1, 60))) for _ in range(singles)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_query_equals_brute_force(spark, frame, tmp_path):
    rows = corpus(1, [(2, 40, 1), (2, 60, 2), (5, 80, 2), (40, 50, 1), (3, 20, 0), (30, 200, 6)], 120)
    frame("doc_id long, text string", *rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = N.op8_minhash(spark, str(tmp_path)).collect()
    want = brute(rows, 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert all(r["n_shingles"] == len(N.shingles(rows[r["doc_id"]][1], 4)) for r in got)


@pytest.mark.parametrize("changed", [2, 5, 7])
def test_hot_group_of_different_near_copies(spark, frame, changed):
    """Several hundred copies of one text, each with its own changes: most pairs are below the threshold,
    and sets hang together through a few others only."""
    rows = corpus(changed, [(500, 120, changed)], 60)
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(frame("doc_id long, text string", *rows)).collect()}
    want = brute(rows, 4, 80)
    wrong = sum(got[d] != want[d] for d in want)
    assert wrong <= 0.01 * len(want)


def test_larger_nodes_are_branched(spark, frame):
    rows = corpus(5, [(160, 90, 1), (90, 200, 1)], 50)
    docs = frame("doc_id long, text string", *rows)
    want = brute(rows, 4, 80)
    sets = docs.select("doc_id", "doc_id", "text").toDF("doc_id", "text_key", "text").mapInArrow(N._sets(4), N.SETS)
    reps = sets.selectExpr("doc_id AS rep", "n_shingles", "roots", "sig")
    pairs = N.candidates(reps, task_rows=60, leaf=10, pivots=12).collect()
    assert all(p["a"] < p["b"] for p in pairs) and len(pairs) == len({tuple(p)[:2] for p in pairs})
    shingles = {d: N.shingles(t, 4) for d, t in rows}
    parent = {d: d for d, _ in rows}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b, _ in pairs:
        common = len(np.intersect1d(shingles[a], shingles[b]))
        if 100 * common >= 80 * (len(shingles[a]) + len(shingles[b]) - common):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    found = {d: root(d) for d, _ in rows}
    assert sum(found[d] != want[d] for d in want) <= 0.01 * len(want)


def test_spanning_pairs_join_what_near_pairs_join():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1000, (6, N.HASHES))
    sigs = np.concatenate([np.where(rng.random((30, N.HASHES)) < 0.1, rng.integers(0, 1000, (30, N.HASHES)), b) for b in base]).astype("<u2")
    sizes = np.full(len(sigs), 50)
    pairs = N.spanning_pairs(sigs, sizes, 0.55)
    label = np.arange(len(sigs))
    for i, j in pairs:
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            assert (sigs[a] == sigs[b]).mean() >= 0.55
            label[label == label[a]] = label[b]
    assert len(np.unique(label)) == 6


def test_cases(spark, frame):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [("x", 3, "Eins zwei drei vier fünf", "y"), ("x", 1, "eins zwei drei  vier\tfünf", "y"), ("x", 2, None, None), (None, 4, "", "y"),
            ("x", 5, " \n ", "y"), ("x", 6, "eins", "y"), ("x", 7, "EINS", "y"), ("x", None, "eins", "y"), ("x", 3, "ganz anderer text hier", "y"),
            ("x", 9, "ganz anderer text hier", "y"), ("x", 10, long, "y"), ("x", 11, long + " ende", "y"), ("x", 11, long + " ende", "y")]
    docs = frame("component_id string, doc_id long, text string, rep string", *rows)
    got = N.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add((r["component_id"], r["kept"]))
    assert by_id == {1: {(1, True)}, 3: {(1, False)}, 9: {(1, False)}, 2: {(2, True)}, 4: {(4, True)}, 5: {(5, True)}, 6: {(6, True)},
                     7: {(6, False)}, None: {(None, True)}, 10: {(10, True)}, 11: {(10, False)}}
    assert sorted(r["n_shingles"] for r in got if r["doc_id"] in (2, 4, 5, 6)) == [0, 0, 0, 1]
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 4, 5, 6, None, 10]))
    assert N.near_duplicates(docs.limit(0)).collect() == []


def test_an_id_of_several_texts_joins_all_their_groups(spark, frame):
    texts = [" ".join(f"{name}{i}" for i in range(12)) for name in "pqrs"]
    rows = [(50, texts[0]), (50, texts[1]), (50, texts[2]), (7, texts[1]), (9, texts[2]), (3, texts[3]), (60, texts[0])]
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(frame("doc_id long, text string", *rows)).collect()}
    assert got == brute(rows, 4, 80) == {50: 7, 7: 7, 9: 7, 60: 7, 3: 3}


def lookalikes(rng, n, linked=(0, 30, 60, 99), unlinked=((5, 20), (40, 55), (70, 90))):
    """Two sets that are linked, each among `n` others that resemble it nearly as much and are linked with nothing."""
    base = [f"b{rng.random()}" for _ in range(100)]

    def changed(words, places):
        return [f"c{rng.random()}" if i in places else w for i, w in enumerate(words)]

    other = changed(base, linked)
    near = [changed(words, {rng.randint(*span) for span in unlinked}) for words in (base, other) for _ in range(n)]
    return [" ".join(words) for words in (base, other, *near)]


def test_a_link_among_many_that_only_look_alike_is_found(spark, frame):
    rng = random.Random(11)
    rows = list(enumerate(t for _ in range(6) for t in lookalikes(rng, 90)))
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(frame("doc_id long, text string", *rows)).collect()}
    assert got == brute(rows, 4, 80)


def test_the_pipeline_drops_a_near_copy_among_many_that_only_look_alike(spark, frame, tmp_path):
    rng = random.Random(12)
    rows = list(enumerate(t for _ in range(6) for t in lookalikes(rng, 90, (0, 1, 2, 50, 98, 99), ((0, 0), (5, 40), (60, 90)))))
    want = brute(rows, 5, 80)
    assert len(set(want.values())) == len(rows) - 6
    got = corpus_pipeline.near_duplicate_stage(spark, frame("doc_id long, text string", *rows), str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(want.values()))


@pytest.mark.parametrize("changed", [2, 5, 7])
def test_groups_of_different_near_copies_equal_brute_force(spark, frame, changed):
    rows = corpus(changed + 20, [(400, 120, changed)], 60)
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(frame("doc_id long, text string", *rows)).collect()}
    assert got == brute(rows, 4, 80)


@pytest.mark.parametrize("part_tokens", [1 << 19, 2_000])
@pytest.mark.parametrize("joined", [0, 200])
def test_sets_of_a_node_of_any_size_are_compared(spark, frame, part_tokens, joined):
    """One node of all sets; `joined` of the largest group are known to be one component."""
    rows = corpus(3, [(260, 60, 2), (60, 50, 5), (2, 40, 1)], 20)
    largest = max((g := list(brute(rows, 4, 80).values())), key=g.count)
    members = [d for d, c in brute(rows, 4, 80).items() if c == largest][:joined]
    label = {d: min(members) if d in members else d for d, _ in rows}
    links = N.unjoined(
        frame("path long, rep long", *[(1, d) for d, _ in rows]),
        frame("rep long, label long, n_shingles long", *[(d, label[d], len(N.shingles(t, 4))) for d, t in rows]),
        frame("rep long, text string", *rows), 4, 80, part_tokens).collect()
    parent = dict(label)

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {d: root(d) for d, _ in rows} == brute(rows, 4, 80)
    if part_tokens > 2_000:
        # As many links as labels that they join, and not as pairs.
        assert len(links) == len(set(label.values())) - len(set(brute(rows, 4, 80).values()))


def test_a_node_of_one_label_is_not_compared(spark, frame):
    links = N.unjoined(frame("path long, rep long", (1, 1), (1, 2)), frame("rep long, label long, n_shingles long", (1, 1, 3), (2, 1, 3)),
                       frame("rep long, text string", (1, "a b c d e f"), (2, "a b c d e f g")), 4, 50)
    assert links.collect() == []


def test_nodes_of_the_same_sets_are_compared_once_and_others_each(spark, frame):
    rows = [(1, "a b c d e f"), (2, "a b c d e f g"), (3, "a b c d e f g h")]
    inside = [(p, d) for p, sets in ((1, (1, 2)), (2, (1, 2)), (3, (2, 3))) for d in sets]
    links = N.unjoined(frame("path long, rep long", *inside), frame("rep long, label long, n_shingles long", (1, 1, 3), (2, 2, 4), (3, 3, 5)),
                       frame("rep long, text string", *rows), 4, 60).collect()
    assert {tuple(sorted(link)) for link in links} == {(1, 2), (2, 3)}


@pytest.mark.parametrize("caps", [{}, {"task_rows": 4, "leaf": 2, "pivots": 1, "least": 0.95}])
def test_the_pipeline_keeps_the_same_rows_whatever_the_candidates_are(spark, frame, monkeypatch, tmp_path, caps):
    """With no candidates at all, and with caps so tight that most are missing."""
    made, seen = N.candidates, []

    def few(reps, inside):
        seen.append(made(reps, inside=inside, **caps) if caps else made(reps, inside=inside).limit(0))
        return seen[-1]

    monkeypatch.setattr(N, "candidates", few)
    rows = corpus(31, [(90, 80, 4), (5, 60, 2), (2, 40, 1)], 30)
    got = corpus_pipeline.near_duplicate_stage(spark, frame("doc_id long, text string", *rows), str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(set(brute(rows, 5, 80).values())) and len(seen) == 1
