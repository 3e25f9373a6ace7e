"""Periodic run detection by internal pattern matching (operator 11).

A text is a sequence of word codes. Its aligned blocks of 8, 16, 32, ... words are patterns: a wavelet
tree over the suffix array answers "the next occurrence of this block at or behind a position" (range
successor), asked in the windows next to the block. Occurrences at most half a block apart form
arithmetic progressions; a progression's difference and the shifts between progressions are the candidate
periods, and each candidate is extended to the left and right by longest common extensions.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import fields, record_batch, table, text_slices

#: A run has at least this many words, and at least this many periods.
LEAST, REPEATS = 24, 3
#: The smallest block: a run of LEAST words holds one whole aligned block and its copy one period away.
BLOCK = 8
FOUND = fields(
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_kept long")


def equal_ranks(codes: np.ndarray) -> list[np.ndarray]:
    """ranks[k][i]: the order of the 2**k codes from i on, equal where they are equal.

    Prefix doubling, until all are different. The last level is that of all suffixes.
    """
    ranks = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
    while (top := int(ranks[-1].max(initial=0)) + 1) < len(codes):
        step = 1 << (len(ranks) - 1)
        behind = np.zeros(len(codes), dtype=np.int64)
        behind[:-step] = ranks[-1][step:] + 1
        key = ranks[-1] * (top + 1) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(len(codes), dtype=np.int64)
        new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        ranks.append(new)
    return ranks


class WaveletTree:
    """Range successor over a permutation, for many queries at once (levels as bit vectors with counts)."""

    def __init__(self, values: np.ndarray):
        self.n, self.bits = len(values), max(1, int(len(values)).bit_length())
        self.zeros, self.before = [], []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1
            self.before.append(np.concatenate([[0], np.cumsum(one == 0)]))
            self.zeros.append(int(self.before[-1][-1]))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of [low, high) are smaller than `bound`."""
        count = np.zeros(len(low), dtype=np.int64)
        over = bound >= 1 << self.bits
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            z_low, z_high = self.before[level][low], self.before[level][high]
            one = ((bound >> b) & 1).astype(bool)
            count += np.where(one, z_high - z_low, 0)
            zeros = self.zeros[level]
            low, high = np.where(one, zeros + low - z_low, z_low), np.where(one, zeros + high - z_high, z_high)
        return np.where(over, -1, count)

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) value of [low, high); k must be there."""
        out = np.zeros(len(low), dtype=np.int64)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            z_low, z_high = self.before[level][low], self.before[level][high]
            one = k >= z_high - z_low
            out += one.astype(np.int64) << b
            k = np.where(one, k - (z_high - z_low), k)
            zeros = self.zeros[level]
            low, high = np.where(one, zeros + low - z_low, z_low), np.where(one, zeros + high - z_high, z_high)
        return out

    def successor(self, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The smallest value of [low, high) that is at least `at`; n where there is none."""
        k = self.below(low, high, np.clip(at, 0, self.n))
        there = k < high - low
        out = np.full(len(low), self.n, dtype=np.int64)
        out[there] = self.smallest(low[there], high[there], k[there])
        return out


def extension(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, forward: bool = True) -> np.ndarray:
    """How many codes from a and b on (or up to a and b, both included) are equal, a != b."""
    n, got = len(ranks[0]), np.zeros(len(a), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        step = 1 << k
        while True:
            x, y = (a + got, b + got) if forward else (a - got - step + 1, b - got - step + 1)
            inside = np.flatnonzero((np.minimum(x, y) >= 0) & (np.maximum(x, y) + step <= n))
            same = inside[ranks[k][x[inside]] == ranks[k][y[inside]]]
            if not len(same):
                break
            got[same] += step
            if k < len(ranks) - 1:
                break  # a second equal piece of this size would have been one piece of the next
    return got


def find_runs(codes: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence, by start and then period.

    A run with smallest period q holds an aligned block of `size` words, size <= q < 2 size (for
    q < 16 a block of 8), whose copy one period before or behind lies in the run as well. In the four
    blocks on either side of it all progressions that meet the run are complete at the end that
    matters, so that q is the difference of one or a shift between the starts or the ends of two.
    """
    n = len(codes)
    none = np.zeros((0, 3), dtype=np.int64)
    if n < LEAST:
        return none
    ranks = equal_ranks(codes)
    order = np.argsort(ranks[-1], kind="stable")
    tree, shifts, places = None, [], []
    for k in range(BLOCK.bit_length() - 1, len(ranks)):
        size = 1 << k
        if REPEATS * size > n:
            break
        counts = np.bincount(ranks[k])
        block = np.arange(0, n - size + 1, size)
        block = block[counts[ranks[k][block]] > 1]  # a block that occurs once has no copy
        if not len(block):
            continue
        if tree is None:
            tree = WaveletTree(order)
        ends = np.cumsum(counts)
        low, high = ends[ranks[k][block]] - counts[ranks[k][block]], ends[ranks[k][block]]
        stop = np.minimum(block + 4 * size, n - size)
        at, who = np.maximum(block - 4 * size, 0), np.arange(len(block))
        seen: list[tuple[np.ndarray, ...]] = []
        while len(who):
            first = tree.successor(low[who], high[who], at)
            there = first <= stop[who]
            who, first = who[there], first[there]
            if not len(who):
                break
            second = tree.successor(low[who], high[who], first + 1)
            step = np.where((second <= stop[who]) & (second - first <= size // 2), second - first, 0)
            last = first.copy()
            more = np.flatnonzero(step)
            reach = step[more] + extension(ranks, first[more], second[more])
            last[more] = first[more] + (reach - size) // step[more] * step[more]
            seen.append((who, first, last, step))
            at = last + 1
        who, first, last, step = (np.concatenate(x) for x in zip(*seen, strict=True))
        # The progression that holds the block itself, and its shifts to the others.
        own = (first <= block[who]) & (block[who] <= last) & np.where(step > 0, (block[who] - first) % np.maximum(step, 1) == 0, True)
        own_first, own_last = np.zeros(len(block), dtype=np.int64), np.zeros(len(block), dtype=np.int64)
        own_first[who[own]], own_last[who[own]] = first[own], last[own]
        for shift in (step, np.abs(first - own_first[who]), np.abs(last - own_last[who])):
            some = shift > 0
            shifts.append(shift[some])
            places.append(np.where(step[some] > 0, first[some], block[who[some]]) if shift is step else block[who[some]])
    if not shifts:
        return none
    at, period = np.unique(np.stack([np.concatenate(places), np.concatenate(shifts)]), axis=1)
    # A candidate may be a period towards either side of its block: both are extended.
    at, period = np.concatenate([at, at - period]), np.concatenate([period, period])
    inside = (at >= 0) & (at + period < n)
    at, period = at[inside], period[inside]
    right = extension(ranks, at, at + period)
    left = extension(ranks, at - 1, at + period - 1, forward=False)
    length = left + right + period
    good = (length >= np.maximum(LEAST, REPEATS * period)) & (left + right > 0)
    rows = np.unique(np.stack([at - left, length, period], axis=1)[good], axis=0)
    # A multiple of a run's period gives the same run: sorted, the smallest period comes first.
    keep = np.ones(len(rows), dtype=bool)
    keep[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[keep]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Where each word of a document comes from when its tail is made periodic; None where it isn't.

    The contract's fixed rule by the crc32 of the id; a null id changes nothing.
    """
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def _digest(words: list[bytes], runs: np.ndarray) -> tuple:
    """The row of one document behind its id."""
    kept = words
    if len(runs):
        gone = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
        np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
        kept = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs.tolist())
    best = (None, None, None, None)
    for s, length, p in runs.tolist():  # by start, then period: only a greater exponent replaces
        if best[0] is None or length * best[2] > best[1] * p:
            best = (s, length, p, 1000 * length // p)
    return (len(words), len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest(), len(kept))


def documents_runs(ids: list, texts: list[str | None], rewrite: bool) -> list[tuple]:
    """The rows of a slice of documents, searched as one sequence with a different code between any two."""
    books, sizes, pieces, seen = [], [], [], {}
    for doc, text in zip(ids, texts, strict=True):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        source = planted(doc, len(words)) if rewrite else None
        if source is not None:
            words = [words[i] for i in source.tolist()]
        books.append(words)
        sizes.append(len(words))
        pieces.append(np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64))
    joined = []
    for k, piece in enumerate(pieces):
        joined += [piece, [len(seen) + k]]
    runs = find_runs(np.concatenate(joined)) if joined else np.zeros((0, 3), dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64) + 1)])
    whose = np.searchsorted(starts, runs[:, 0], side="right") - 1
    cut = np.searchsorted(whose, np.arange(len(books) + 1))
    return [(doc, *_digest(words, runs[cut[k]:cut[k + 1]] - np.array([starts[k], 0, 0])))
            for k, (doc, words) in enumerate(zip(ids, books, strict=True))]


def _search(rewrite: bool, slice_bytes: int):
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text", slice_bytes):
                rows = documents_runs(part.column(0).to_pylist(), part.column(1).to_pylist(), rewrite)
                yield record_batch(FOUND, {n: [r[i] for r in rows] for i, n in enumerate(FOUND.names)})

    return run


def periodic_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rewrite: bool = False,
                  slice_bytes: int = 1 << 20) -> DataFrame:
    """One row per row of `docs`: its runs, the one with the greatest exponent, and the text without repeats.

    Nothing is shuffled: a text is searched whole in its own task, together with its neighbours in slices of
    about `slice_bytes`; a longer text is a slice of its own, and a task holds some 200 bytes per word of a slice.
    Words are the contract's. Null, empty and wordless texts have no run and collapse to the
    empty text; repeated rows give a row each; an empty table gives none; ties of the exponent go to the smallest
    start and then period; a null id stays null and its text is not rewritten. Columns other than the two
    named are not returned, so none can clash. `rewrite` plants the contract's periodic tails first.
    """
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return narrow.mapInArrow(_search(rewrite, slice_bytes), FOUND)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents, with the contract's planted tails."""
    return periodic_runs(table(spark, sf_dir, "documents"), rewrite=True).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "n_kept")
