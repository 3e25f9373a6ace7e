"""Character grams of whole batches of texts, as numbers: what plain columns do letter by letter, numpy does at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Rows that are looked at together, so that a worker's memory does not follow the batch size setting.
ROWS = 512
PROBES = 3
_MUL = np.uint64(0x9E3779B97F4A7C15)


def slices(batch: pa.RecordBatch, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all texts one after another; of each its row, and how many its text has from there on."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return points, np.repeat(np.arange(len(texts)), lengths), np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))


def hashes(texts: list[str], salts: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, row, 64-bit hash) of every gram of each size; a row's salt is part of its hashes."""
    points, row, left = letters(texts)
    h = salts.astype(np.int64).view(np.uint64)[row]
    for n in range(1, max(sizes, default=0) + 1):
        h = (h[:len(points) - n + 1] * _MUL + points[n - 1:].astype(np.uint64)) if n <= len(points) else h[:0]
        if n in sizes:
            whole = left[:len(h)] >= n
            yield n, row[:len(h)][whole], _mixed(h[whole])


def _mixed(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slots(found: np.ndarray, bits: int) -> np.ndarray:
    """The places of hashes in a bitmap of 2 ** bits, some for each."""
    out = []
    for _ in range(PROBES):
        out.append(found >> np.uint64(64 - bits))
        found = _mixed(found * _MUL)
    return np.concatenate(out).astype(np.int64)


def known(found: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    """Indexes of the hashes that the bitmap may hold: all that it holds, and few others."""
    index = np.arange(len(found))
    for _ in range(PROBES):
        at = found >> np.uint64(64 - bits)
        there = (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        index, found = index[there], _mixed(found[there] * _MUL)
    return index


def triples(texts: list[str], groups: np.ndarray) -> Iterator[tuple[int, list[str]]]:
    """(group, its distinct grams of three letters) for texts that belong to numbered groups."""
    points, row, left = letters(texts)
    wide = points.astype(np.uint64)
    n = max(0, len(wide) - 2)
    code = wide[:n] << np.uint64(42) | wide[1:n + 1] << np.uint64(21) | wide[2:n + 2]
    whole = left[:n] >= 3
    code, group = code[whole], groups[row[:n][whole]]
    for one in np.unique(group):
        each = np.unique(code[group == one])
        part = np.uint64((1 << 21) - 1)
        spelt = np.stack([each >> np.uint64(42), each >> np.uint64(21) & part, each & part], axis=1).astype("<u4")
        text = spelt.tobytes().decode("utf-32-le", "surrogatepass")
        yield int(one), [text[i:i + 3] for i in range(0, len(text), 3)]
