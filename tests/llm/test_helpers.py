"""The operators' inner steps against brute force; no session is needed."""

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from rostrum.llm import language, near_dedup, packing, spans, toxicity


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
    return row[-1]


@given(st.lists(st.integers(1, 1023), max_size=60))
def test_packing_places_every_token_once(lengths):
    sequences = packing.pack_lengths(np.array(lengths, dtype=np.int64), 1024, 1024.0)
    assert all(sum(n for _, _, n in s) <= 1024 for s in sequences)
    assert len(sequences) == -(-sum(lengths) // 1024)
    found = sorted((i, start, n) for s in sequences for i, start, n in s)
    for item, length in enumerate(lengths):
        at = 0
        for _, start, n in (p for p in found if p[0] == item):
            assert start == at and n > 0
            at += n
        assert at == length


@pytest.mark.parametrize("text, n", [(None, 0), ("", 0), (" \t\n", 0), ("one", 1), ("a b c", 1), ("a b c d e", 2), ("a a a a a a", 1)])
def test_shingle_sets(text, n):
    assert len(near_dedup.shingles(text, 4)) == n


def test_shingles_fold_ascii_only():
    assert (near_dedup.shingles("A B C D", 4) == near_dedup.shingles("a  b\tc d", 4)).all()
    assert (near_dedup.shingles("É b c d", 4) != near_dedup.shingles("é b c d", 4)).all()


@given(st.text("ab", max_size=7), st.lists(st.text("ab", min_size=1, max_size=6), min_size=1, max_size=5))
def test_walk_is_edit_distance(word, terms):
    best = min((edits(word, t), t) for t in terms)
    assert toxicity.walk(toxicity.build_trie(terms), word, 1) == (best if best[0] <= 1 else None)


@given(st.text("idotcl", min_size=5, max_size=7))
def test_halves_lose_no_term(word):
    terms = ("idiot", "clodt", "dotidol")
    near = min(edits(word, t) for t in terms)
    assert toxicity.Matcher(terms).distance(word) == (near if near <= 1 else -1)


@given(st.text("a. !\n", max_size=40))
def test_sentences_join_to_the_text(text):
    assert "".join(spans.sentences(text)) == text


def test_letters_decide_the_language_vector():
    assert language.ngram_counts(None) is None and language.ngram_counts("12 !") is None
    assert (language.ngram_counts("ab, cd") == language.ngram_counts("AB -- CD")).all()
