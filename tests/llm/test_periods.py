import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from rostrum.llm import periods


def brute(words):
    """Every run by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // periods.REPEATS + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            length = e - s + q
            if e > s and length >= max(periods.LEAST, periods.REPEATS * q):
                found.setdefault((s, length), q)
            s = max(e, s) + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    digest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *digest, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def composed(rng):
    """Periodic pieces with odd borders, inner repeats and changed words."""
    out = []
    while len(out) < rng.randint(10, 260):
        kind = rng.random()
        root = [rng.choice("abc") for _ in range(rng.randint(1, 30))]
        if kind < 0.3:
            root = [root[0]] * rng.randint(1, 20) + [rng.choice("ab")]
        if kind < 0.7:
            piece = (root * 12)[:rng.randint(1, max(24, 4 * len(root)))]
        else:
            piece = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 20))]
        if rng.random() < 0.2 and piece:
            piece[rng.randrange(len(piece))] = "z"
        out += piece
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        words = composed(rng)
        codes = np.array([ord(w) for w in words])
        assert [tuple(r) for r in periods.find_runs(codes).tolist()] == brute(words), words


def test_slice_of_documents_equals_brute_force():
    rng = random.Random(99)
    ids = list(range(300))
    texts = [" ".join(composed(rng)) for _ in ids]
    texts[1] = texts[2] = texts[3]
    got = periods.documents_runs(ids, texts, rewrite=True)
    for row, doc, text in zip(got, ids, texts, strict=True):
        assert (row[0], *row[2:9]) == expected(doc, text)


def test_one_word_many_times():
    runs = periods.find_runs(np.zeros(50_000, dtype=np.int64))
    assert runs.tolist() == [[0, 50_000, 1]]


def test_wavelet_successor():
    rng = np.random.default_rng(3)
    values = rng.permutation(100)
    tree = periods.WaveletTree(values)
    low, high, at = rng.integers(0, 50, 300), rng.integers(50, 101, 300), rng.integers(0, 101, 300)
    want = [min((v for v in values[a:b] if v >= x), default=100) for a, b, x in zip(low, high, at, strict=True)]
    assert tree.successor(low, high, at).tolist() == want


def test_query_cases(spark, frame, tmp_path):
    loop = " ".join(["und", "dann"] * 40)
    long = " ".join(f"w{i}" for i in range(30_000)) + " " + " ".join(f"v{i % 1000}" for i in range(3500))
    rows = [(1, "x", loop), (2, "x", None), (3, None, ""), (4, "y", "\t \n"), (5, "y", long), (1, "z", loop), (None, "z", loop),
            (6, "z", " a b" * 30), (16, "q", loop + " ende " + loop)]
    frame("doc_id long, n_runs string, text string", *rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = periods.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for doc, _, text in rows:
        if doc is not None and doc != 5:
            assert tuple(by_id[doc])[:8] == expected(doc, text)
    assert by_id[None]["n_runs"] == 1 and by_id[None]["period"] == 2
    assert by_id[5]["n_runs"] == 1 and by_id[5]["period"] == 1000 and by_id[5]["length"] == 3500
    empty = frame("doc_id long, text string")
    assert periods.periodic_runs(empty).collect() == []
