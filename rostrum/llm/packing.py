"""Cost-balanced packing of token sequences (operator 6).

The cost of a piece of n tokens is estimated as n + n * n / `balance`: a linear part and the
quadratic part of attention. Descending pieces go to the lowest-cost sequence that still has room.
"""

from __future__ import annotations

import base64
import os
import zlib
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import fields, record_batch, text_slices
from rostrum.session import materialize

SPECIAL = "<|endoftext|>"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@cache
def encoder(name: str = "byte_bpe_50k"):
    """text -> ids of the public vocabulary, loaded once per worker.

    The rank form of the same vocabulary is about five times as fast; a text that spells the
    special token is left to the other library, which alone gives it its own id.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    full = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if SPECIAL in text:
            return full.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def _tokenize(capacity: int, end_id: int, name: str):
    """Full sequences with their checksum; the rest of each document with its ids."""
    def run(batches):
        schema = REST
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.array([*encoder(name)(text or ""), end_id], dtype="<u4")
                    for at in range(0, len(ids), capacity):
                        piece = ids[at:at + capacity].tobytes()
                        whole = len(piece) == 4 * capacity
                        rows.append((doc, at, len(piece) // 4, zlib.crc32(piece), len(ids), None if whole else piece))
                columns = dict(zip(schema.names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in schema.names}
                yield record_batch(schema, {k: list(v) for k, v in columns.items()})

    return run


REST = fields(f"{PIECES}, ids binary")


def pack_lengths(lengths: np.ndarray, capacity: int, balance: float) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, start in the item, length), for items shorter than `capacity`.

    As many sequences as the sum of tokens needs are open from the start. An item that has room in
    none of them is cut along the sequences with the most room, so that less than
    one sequence of padding is left over.
    """
    if not len(lengths):
        return []
    count = -(-int(lengths.sum()) // capacity)
    room, cost = np.full(count, capacity), np.zeros(count)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]

    def put(item: int, start: int, n: int, at: int) -> None:
        out[at].append((item, start, n))
        room[at] -= n
        cost[at] += n + n * n / balance

    for item in np.argsort(-lengths, kind="stable"):
        n = int(lengths[item])
        at = int(np.argmin(np.where(room >= n, cost, np.inf)))
        if room[at] >= n:
            put(int(item), 0, n, at)
            continue
        start = 0
        while start < n:
            at = int(np.argmax(room))
            step = min(n - start, int(room[at]))
            put(int(item), start, step, at)
            start += step
    return out


def _pack(capacity: int, balance: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "start", "ids_crc32"], na_position="first").reset_index(drop=True)
        rows, base = [], int(frame["slice"].iloc[0]) << 20
        for k, sequence in enumerate(pack_lengths(frame["length"].to_numpy(), capacity, balance)):
            offset = 0
            for item, start, n in sequence:
                r = frame.iloc[item]
                rows.append((r["doc_id"], r["start"] + start, n, zlib.crc32(r["ids"][4 * start:4 * (start + n)]),
                             r["doc_tokens"], 2 * (base + k), offset))
                offset += n
        out = pd.DataFrame(rows, columns=[*REST.names[:-1], "sequence_id", "offset"])
        return out.astype({"doc_id": "Int64"})

    return run


def pack_sequences(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", capacity: int = 1024, end_id: int = 0,
    tokenizer: str = "byte_bpe_50k", slice_items: int = 4096, balance: float = 1024.0,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), every id in one.

    A null or empty text is its end id alone. Stretches of `capacity` ids are sequences of their
    own, packed where they are. What remains of each document is dealt by hash to slices of
    about `slice_items` pieces; each slice is packed in one task, whatever the size of the table,
    and pads less than one sequence. Ties go to the lower id, start and checksum. Repeated rows
    are packed each for itself; ids may be null; an empty table gives no rows. Other columns are ignored.
    """
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    pieces = materialize(narrow.mapInArrow(_tokenize(capacity, end_id, tokenizer), REST), "pack-pieces")
    whole = pieces.where(F.col("ids").isNull()).select(
        *REST.names[:-1], (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("ids").isNotNull())
    slices = -(-max(1, rest.count()) // slice_items)
    packed = rest.withColumn("slice", F.pmod(F.xxhash64("doc_id", "ids_crc32", "length"), F.lit(slices)).cast("long")).groupBy(
        "slice").applyInPandas(_pack(capacity, balance), f"{PIECES}, sequence_id long, offset long")
    return whole.unionByName(packed)
