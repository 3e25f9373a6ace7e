import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from rostrum.llm import prefix_trie


def rebuilt(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in by_conv.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def total(node):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves, saved = int(not children[node]), own
        for child in children[node]:
            more = total(child)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = set()
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        out.add((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children[node]), *total(node),
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(rng, convs):
    rows = []
    for c in range(convs):
        if rng.random() < 0.1:
            continue
        hot = rng.random() < 0.4
        for t in range(rng.randint(1, 12)):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]) if not hot else "user",
                         "same first" if hot and t < 6 else rng.choice(["a", "b", "über", None, "long " * 9])))
    # one turn number once per conversation, so that the order is fixed
    seen, once = set(), []
    for r in rows:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            once.append(r)
    rng.shuffle(once)
    return once


@pytest.mark.parametrize(("seed", "shard_bytes", "skeleton_bytes"), [(1, 1 << 20, 1 << 20), (2, 900, 1 << 20), (3, 400, 2_000), (4, 2_000, 700)])
def test_nodes_equal_brute_force(spark, frame, seed, shard_bytes, skeleton_bytes):
    rows = rows_of(random.Random(seed), 150)
    turns = frame("conv_id long, turn long, role string, text string", *rows)
    got = prefix_trie.conversation_trie(turns, shard_bytes, skeleton_bytes).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == brute(rows)


def test_copies_of_one_path_are_cut_into_shards(spark, frame):
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(120) for t in range(3)]
    paths = prefix_trie.rebuilt_paths(frame("conv_id long, turn long, role string, text string", *rows))
    cuts = prefix_trie.choose_splitters(paths, 2_000, 1 << 20)
    assert len(cuts) > 3 and len({c[0] for c in cuts}) == 1
    turns = frame("conv_id long, turn long, role string, text string", *rows)
    assert set(map(tuple, prefix_trie.conversation_trie(turns, 2_000, 1 << 20).collect())) == brute(rows)


def test_pieces_of_ends_are_hashed_in_order():
    path = "0" * 32 + "00000001"
    walk = prefix_trie.Walk({(-1, ""): 0, (0, path): 1}, piece_bytes=16)
    for conv in range(7):
        walk.row(path, conv)
    walk.end()
    assert [r[10] for r in walk.out if r[0] == 2] == [b"0,1", b"2,3", b"4,5", b"6"]


def test_cases(spark, frame):
    schema = "parent_conv_id string, conv_id long, turn long, role string, text string"
    turns = frame(schema, ("x", None, 1, "user", "lost"), ("x", 1, None, None, None), ("y", 1, 2, "", ""), ("y", 7, 1, "user", ""))
    rows = [(r[1], r[2], r[3], r[4]) for r in turns.collect()]
    assert set(map(tuple, prefix_trie.conversation_trie(turns).collect())) == brute(rows)
    assert prefix_trie.conversation_trie(turns.limit(0)).collect() == []
    # Repeated rows are turns of their own.
    twice = frame(schema, *[("x", 0, 1, "user", "hi")] * 2)
    assert sorted(r["depth"] for r in prefix_trie.conversation_trie(twice).collect()) == [0, 1, 2]
    # A conversation that takes over nothing and whose own turns are all cut is a member of the root only.
    c = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    bare = prefix_trie.conversation_trie(frame(schema, ("x", c, 1, "user", "hi"))).collect()
    assert [tuple(r) for r in bare] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
