"""Benchmark decontamination by CGK embedding and bit sampling (operator 2).

The CGK random walk copies a word sequence symbol by symbol and stays or steps by a random bit
of (step, symbol); near sequences in edit distance are near in Hamming distance then. Sampled positions
of the embedding are the keys of a locality-sensitive hash over windows as long as the item, repeated with
new walks until the target recall; candidates are confirmed by edit distance in words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import fields, mix, record_batch, table, text_slices

WORD = re.compile(r"\w+")
MATCHES = fields("doc_id long, item_id long, start long, words long, distance long")
#: Steps of the walk per word of the item, and positions of the embedding that make a key.
STRETCH, SAMPLED = 3, 2
#: The longest stretch of unedited words that is looked for before a window is embedded.
GRAM = 4


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def limit(n: int, edits: float) -> int:
    """The edits allowed for an item of n words."""
    return int(edits * n)


def sure_gram(n: int, k: int) -> int:
    """Words in the longest stretch that k edits must leave whole in an item of n words, GRAM at most.

    The n - k words that stay are in k + 1 stretches. Without such a stretch a window can't match, so
    it needn't be embedded.
    """
    return min(GRAM, max(1, -(-(n - k) // (k + 1))))


@dataclass
class Items:
    """One block of the benchmark: `codes` are its words, numbered from 1 over the block (0 is any other word)."""

    ids: list[int]
    codes: list[np.ndarray]
    number: dict[str, int]
    edits: float
    reps: int

    def __post_init__(self):
        self.sizes = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.limits = np.array([limit(n, self.edits) for n in self.sizes], dtype=np.int64)
        grams: dict[int, list[tuple[int, int, int]]] = {}
        for n, codes in enumerate(self.codes):
            q = sure_gram(len(codes), int(self.limits[n]))
            grams.setdefault(q, []).extend((int(h), n, at) for at, h in enumerate(gram_hashes(codes, q)))
        #: Per gram size: sorted hashes with the item and the place of each.
        self.grams = {q: tuple(np.array(x) for x in zip(*sorted(rows), strict=True)) for q, rows in grams.items()}
        self.keys: dict[tuple[int, int, int], list[int]] = {}
        for n, codes in enumerate(self.codes):
            for rep, key in enumerate(embed_keys(codes, np.zeros(1, np.int64), self.sizes[n:n + 1], self.reps)[:, 0].tolist()):
                self.keys.setdefault((rep, len(codes), key), []).append(n)
        self.masks: list[dict[int, int]] = []
        for codes in self.codes:
            mask: dict[int, int] = {}
            for i, c in enumerate(codes.tolist()):
                mask[c] = mask.get(c, 0) | 1 << i
            self.masks.append(mask)


def block_of(rows: list[tuple[int, str]], edits: float, reps: int) -> Items:
    """A block from (item_id, text); items without a word match nothing and are left out."""
    number: dict[str, int] = {}
    ids, codes = [], []
    for item, text in rows:
        found = [number.setdefault(w, len(number) + 1) for w in words(text)]
        if found:
            ids.append(item)
            codes.append(np.array(found, dtype=np.int64))
    return Items(ids, codes, number, edits, reps)


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Hashes (63 bits) of the q-word stretches."""
    n = max(0, len(codes) - q + 1)
    out = np.full(n, q, dtype=np.uint64)
    for i in range(q):
        out = mix(out + codes[i:i + n].astype(np.uint64))
    return (out >> np.uint64(1)).astype(np.int64)


def embed_keys(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, reps: int) -> np.ndarray:
    """Keys (reps x windows) of the windows [start, start + size): sampled symbols of embeddings of STRETCH * size steps.

    Behind the window's end the walk stands on the symbol 0. Walks and samples depend on size and
    repetition alone, so windows and items of one size can be compared.
    """
    n, many = len(starts), 1000
    if n > many:
        return np.concatenate([embed_keys(codes, starts[i:i + many], sizes[i:i + many], reps) for i in range(0, n, many)], axis=1)
    if not n:
        return np.zeros((reps, 0), np.int64)
    longest = int(sizes.max())
    place = starts[:, None] + np.arange(longest + 1)
    inside = (np.arange(longest + 1) < sizes[:, None]) & (place < len(codes))
    symbols = np.where(inside, np.append(codes, 0)[np.minimum(place, len(codes))], 0).astype(np.uint64)
    rep, row = np.arange(reps)[:, None], np.arange(n)[None, :]
    taken = np.zeros((STRETCH * longest, reps, n), dtype=np.uint64)
    at = np.zeros((reps, n), dtype=np.int64)
    for step in range(STRETCH * longest):
        taken[step] = symbols[row, at]
        if step % 64 == 0:  # 64 random bits a symbol
            salts = mix((np.arange(reps, dtype=np.uint64) << np.uint64(20)) + np.uint64(step + 1))
            bits = mix(symbols[None] ^ salts[:, None, None])
        at = np.minimum(at + ((bits[rep, row, at] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64), longest)
    key = np.zeros((reps, n), dtype=np.uint64)
    for i in range(SAMPLED):
        # The sampled step: a hash of size, repetition and i.
        drawn = mix((sizes.astype(np.uint64) << np.uint64(32)) + (rep.astype(np.uint64) << np.uint64(8)) + np.uint64(i + 1))
        step = (drawn % (STRETCH * sizes).astype(np.uint64)).astype(np.int64)
        key = mix(key + taken[step, rep, row] + np.uint64(i + 1))
    return (key >> np.uint64(1)).astype(np.int64)


def nearest_stretch(mask: dict[int, int], n: int, text: list[int], free: bool = True) -> tuple[int, int]:
    """(edits, end) of the stretch of `text` nearest to the item (masks of its n words), the first of the best.

    Bit-parallel rows of the edit distance (Myers). With `free` a stretch may start anywhere,
    else at the first word.
    """
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best = (n, 0)
    for at, c in enumerate(text, 1):
        eq = mask.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(xh | plus)), plus & xh
        score += 1 if up & top else -1 if down & top else 0
        up, down = (up << 1) | (not free), down << 1
        plus, minus = (down | ~(xv | up)) & full, up & xv & full
        if score < best[0]:
            best = (score, at)
    return best


def locate(items: Items, n: int, codes: list[int], low: int, high: int) -> tuple[int, int, int]:
    """(edits, start, words) of the first nearest stretch to item n in codes[low:high]."""
    size = int(items.sizes[n])
    edits, end = nearest_stretch(items.masks[n], size, codes[low:high])
    backward = {c: int(f"{m:0{size}b}"[::-1], 2) for c, m in items.masks[n].items()}
    _, long = nearest_stretch(backward, size, codes[low:low + end][::-1], free=False)
    return edits, low + end - long, long


def windows(items: Items, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (start, size) of a text that may hold an item: all starts within the edit limit around each
    place where text and item share the stretch that no allowed edit can break."""
    starts, sizes = [], []
    for q, (hashes, whose, place) in items.grams.items():
        inside = codes > 0
        for i in range(1, q):
            inside = inside[:-1] & (codes[i:] > 0)
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        got = np.zeros(len(at), dtype=np.uint64) + np.uint64(q)
        for i in range(q):
            got = mix(got + codes[at + i].astype(np.uint64))
        got = (got >> np.uint64(1)).astype(np.int64)
        low, high = np.searchsorted(hashes, got), np.searchsorted(hashes, got, side="right")
        n = high - low
        if not n.any():
            continue
        hit = np.repeat(np.arange(len(at)), n)
        row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        base, k = at[hit] - place[row], items.limits[whose[row]]
        reach = 2 * k + 1
        shift = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach) - np.repeat(k, reach)
        starts.append(np.repeat(base, reach) + shift)
        sizes.append(np.repeat(items.sizes[whose[row]], reach))
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.stack([np.concatenate(starts), np.concatenate(sizes)]), axis=1)
    both = both[:, (both[0] >= 0) & (both[0] < len(codes))]
    return both[0], both[1]


def find_in(items: Items, codes: np.ndarray) -> dict[int, tuple[int, int, int]]:
    """Per item within its limit: (edits, start, words) of its best place in a sequence of codes."""
    starts, sizes = windows(items, codes)
    places: dict[int, list[int]] = {}
    for rep, keys in enumerate(embed_keys(codes, starts, sizes, items.reps).tolist()):
        for start, size, key in zip(starts.tolist(), sizes.tolist(), keys, strict=True):
            for n in items.keys.get((rep, size, key), ()):
                places.setdefault(n, []).append(start)
    best: dict[int, tuple[int, int, int]] = {}
    listed = codes.tolist() if places else []
    for n, found in places.items():
        size, k = int(items.sizes[n]), int(items.limits[n])
        found = sorted(set(found))
        first = last = found[0]
        for start in [*found[1:], None]:
            if start is not None and start - last <= 2 * k + 1:
                last = start
                continue
            # One comparison for neighbouring windows, over all that a match at any of them can reach.
            got = locate(items, n, listed, max(0, first - k), last + size + 2 * k)
            if got[0] <= k and got < best.get(n, (k + 1, 0, 0)):
                best[n] = got
            first = last = start
    return best


def _search(shared):
    def run(batches):
        items: Items = shared.value
        get = items.number.get
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    codes = np.array([get(w, 0) for w in words(text)], dtype=np.int64)
                    rows += [(doc, items.ids[n], start, long, edits) for n, (edits, start, long) in find_in(items, codes).items()]
                yield record_batch(MATCHES, {n: [r[i] for r in rows] for i, n in enumerate(MATCHES.names)})

    return run


def find_items(docs: DataFrame, benchmark: DataFrame, reps: int = 16, edits: float = 0.15, block_items: int = 20_000) -> DataFrame:
    """(doc_id, item_id, start, words, distance): items found in documents within `edits` of their words.

    `start` and `words` are the place, in words, of the first nearest stretch. Whole texts are searched. The
    benchmark is the stated query set: it is broadcast in blocks of about `block_items` items, so a larger one takes
    more passes over the texts, not more memory. `reps` walks of two sampled symbols each set the recall of
    edited passages; unchanged ones are always found.

    Items and texts that are null or have no word match nothing; a null item_id stays null in its
    matches, as does a null doc_id; repeated rows of either side match each; other columns are not read.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        F.col("text").isNotNull())
    blocks = max(1, -(-known.count() // block_items))
    out = None
    for block in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        items = docs.sparkSession.sparkContext.broadcast(block_of([(r["item_id"], r["text"]) for r in rows], edits, reps))
        found = narrow.mapInArrow(_search(items), MATCHES)
        out = found if out is None else out.unionByName(found)
    return out


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of `docs` whose id has no benchmark passage; all columns and repeated rows stay.

    A null id can't be told from another, so its rows stay. Item ids play no part: an item with a null id counts.
    """
    return docs.join(find_items(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])
