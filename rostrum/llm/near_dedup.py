"""Near duplicates by a chosen-path set similarity join (operator 8).

Documents are sets of word shingles. Independent trees branch them by selected minwise tokens. The nodes' signatures
give a few pairs per set, which join most groups once the full sets confirm them; then all sets of a node that are
not joined yet are compared on their full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import components, fields, mix, record_batch, table, text_slices
from rostrum.session import materialize

#: `roots`: the set's node in each tree, 4 bytes each; `sig`: two bytes of every minwise token.
SETS = fields("doc_id long, text_key long, n_shingles long, set_key binary, roots binary, sig binary")
TEXTS = fields("rep long, text string")
PAIRS = fields("a long, b long")
NEAR = fields("a long, b long, near int")
TOKENS = fields("rep long, tokens binary")
#: Two sets that share 0.8 of their shingles are in different nodes of all trees with (1 - 0.8 ** 3) ** 20, six in ten million.
TREES, DEPTH = 20, 3
HASHES = TREES * DEPTH
_RNG = np.random.default_rng(8)
_MUL = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a whole text.

    Bytes are lower-cased and split as ASCII, which is A-Z and the six ASCII spaces.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    width = min(k, len(codes))
    count = len(codes) - width + 1
    out = np.full(count, width, dtype=np.uint64)
    for i in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[i:i + count]
    return np.unique(mix(out))


def minwise(tokens: np.ndarray, block: int = 2048) -> np.ndarray:
    """The minwise value of each hash function, cut to 32 bits."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(tokens), block):
        np.minimum(best, (tokens[at:at + block, None] * _MUL + _ADD).min(axis=0), out=best)
    return (mix(best) >> np.uint64(32)).astype("<u4")


def tree_nodes(best: np.ndarray) -> np.ndarray:
    """The node of each tree: its tokens, hashed to 32 bits."""
    node = np.zeros(TREES, dtype=np.uint64)
    for token in best.reshape(TREES, DEPTH).T:
        node = mix(node * np.uint64(0x9E3779B97F4A7C15) + token)
    return (node >> np.uint64(32)).astype("<u4")


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                rows = []
                for text in part.column(2).to_pylist():
                    tokens = shingles(text, k)
                    if not len(tokens):
                        rows.append((0, None, None, None))
                        continue
                    best = minwise(tokens)
                    rows.append((len(tokens), xxhash.xxh3_128_digest(tokens.astype("<u8").tobytes()),
                                 tree_nodes(best).tobytes(), best.astype("<u2").tobytes()))
                yield record_batch(SETS, {
                    "doc_id": part.column(0), "text_key": part.column(1),
                    **{n: [r[i] for r in rows] for i, n in enumerate(SETS.names[2:])}})

    return run


def spanning_pairs(
    sigs: np.ndarray, sizes: np.ndarray, least: float, nearest: int = 32, sure: float = 0.93,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs (rows) of one larger node, after an exhaustive comparison of its signatures.

    Rows come in the order of their numbers. A set as near as `sure` to others is paired with the first of them, which
    in every node is the same one if it is there; any other set with its `nearest`, since signatures err in the
    order of the nearest. Boruvka rounds then pair each set with its nearest one of another cluster, until no cluster
    has a near one outside: a chain of links between two sets is followed by links that are at least as near.
    Pairs are thus as many as sets, and not as their squares.
    """
    n, width = sigs.shape
    near = np.zeros((n, n), dtype=np.uint8)
    for at in range(0, n, 64):
        block = (sigs[at:at + 64, None, :] == sigs[None, :, :]).sum(axis=2, dtype=np.uint8)
        small = np.minimum(sizes[at:at + 64, None], sizes[None, :])
        large = np.maximum(sizes[at:at + 64, None], sizes[None, :])
        near[at:at + 64] = np.where((100 * small >= 80 * large) & (block >= least * width), block, 0)
    np.fill_diagonal(near, 0)
    first = (near >= sure * width).argmax(axis=1)
    certain = np.flatnonzero(near[np.arange(n), first] >= sure * width)
    found = [(certain, first[certain])]
    others = np.flatnonzero(near.max(axis=1, initial=0) < sure * width)
    if len(others):
        few = min(nearest, n)
        top = np.argpartition(near[others], n - few, axis=1)[:, n - few:]
        rows, columns = np.repeat(others, few), top.ravel()
        some = near[rows, columns] > 0
        found.append((rows[some], columns[some]))
    cluster = np.arange(n)
    rows, best = found[0]
    while True:
        # Clusters merge along the last edges, by the smallest label.
        while len(rows):
            low = cluster.copy()
            np.minimum.at(low, cluster[rows], cluster[best])
            np.minimum.at(low, cluster[best], cluster[rows])
            low = low[low[cluster]]
            if (low == cluster).all():
                break
            cluster = low
        order = np.argsort(cluster, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            near[np.ix_(members, members)] = 0
        best = near.argmax(axis=1)
        rows = np.flatnonzero(near[np.arange(n), best])
        if not len(rows):
            return found
        best = best[rows]
        found.append((rows, best))


def _node_pairs(leaf: int, least: float):
    """Candidates of whole nodes: rows come sorted by path, and a node is complete when the next one begins.

    A set of a node of up to `leaf` sets is paired with its nearest one, of equals the first, and with the node's first;
    a larger node gives its spanning pairs. A pair that an earlier tree has in one node as well, and not in one that
    had to be cut up, is left to that tree. All of this only saves work: what is not paired here is compared by `unjoined`.
    """
    def pairs(ids, paths, sizes, sigs, roots, trees, whole):
        starts = np.flatnonzero(np.concatenate([[True], paths[1:] != paths[:-1]]))
        counts = np.diff(np.append(starts, len(paths)))
        count, head = np.repeat(counts, counts), np.repeat(starts, counts)
        # Per row: its node in each earlier tree, if that is whole; else a number no other row has there.
        usable = (whole[:, None] >> np.arange(TREES) & 1).astype(bool) & (np.arange(TREES) < trees[:, None])
        places = np.where(usable, roots.astype(np.int64), -1 - np.arange(len(ids))[:, None])
        found, close = [], []

        def equal(i, j):
            """The pairs that sizes and signatures don't rule out, with their equal tokens."""
            small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
            ok = (ids[i] != ids[j]) & (100 * small >= 80 * large)
            i, j = i[ok], j[ok]
            near = (sigs[i] == sigs[j]).sum(axis=1)
            ok = near >= least * HASHES
            return i[ok], j[ok], near[ok]

        def add(i, j, near):
            ok = ~(places[i] == places[j]).any(axis=1)
            found.append(np.stack([np.minimum(ids[i], ids[j])[ok], np.maximum(ids[i], ids[j])[ok], near[ok]]))

        small = np.flatnonzero(count <= leaf)
        for gap in range(1, int(counts[counts <= leaf].max(initial=1))):
            i = small[small + gap < len(paths)]
            i = i[paths[i] == paths[i + gap]]
            if not len(i):
                break
            close.append(equal(i, i + gap))
        if close:
            i, j, near = (np.concatenate(c) for c in zip(*close, strict=True))
            row, other = np.concatenate([i, j]), np.concatenate([j, i])
            order = np.lexsort((other, -np.tile(near, 2), row))
            best = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
            add(row[best], other[best], np.tile(near, 2)[best])
            first = head[i] == i
            add(i[first], j[first], near[first])
        for start, n in zip(starts[counts > leaf].tolist(), counts[counts > leaf].tolist(), strict=True):
            for i, j in spanning_pairs(sigs[start:start + n], sizes[start:start + n], least, nearest=1):
                add(*equal(start + i, start + j))
        got = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((3, 0), np.int64)
        return record_batch(NEAR, {"a": got[0], "b": got[1], "near": got[2]})

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.concat_batches([held, batch])
            paths = np.asarray(held.column(0))
            whole = int(np.flatnonzero(paths != paths[-1])[-1]) + 1 if paths[0] != paths[-1] else 0
            if whole:
                yield pairs(*unpack(held.slice(0, whole)))
                held = held.slice(whole)
        if held is not None:
            yield pairs(*unpack(held))

    def unpack(batch):
        paths, ids, sizes = (np.asarray(batch.column(i)) for i in range(3))
        sigs = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<u2").reshape(len(ids), HASHES)
        roots = np.frombuffer(b"".join(batch.column(4).to_pylist()), "<u4").reshape(len(ids), TREES)
        return ids, paths, sizes, sigs, roots, np.asarray(batch.column(5)), np.asarray(batch.column(6))

    return run


def company(reps: DataFrame) -> DataFrame:
    """Rows (path, rep, tree, roots, _n) of the nodes of two and more sets: each set in its node of every tree."""
    node = reps.select("rep", "roots", F.explode(F.array(*[F.lit(t) for t in range(TREES)])).alias("tree")).select(
        "rep", "tree", F.xxhash64("tree", F.expr("substring(roots, 4 * tree + 1, 4)")).alias("path"))
    sizes = materialize(node.groupBy("path").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "near-nodes")
    # Only numbers travel until it is known which sets are in company; signatures and texts follow those. A shuffle at
    # every size, so that the plan of a small table tells what a large one takes.
    return materialize(node.join(sizes.hint("merge"), "path"), "near-inside")


def candidates(reps: DataFrame, task_rows: int = 2_000, leaf: int = 48, least: float = 0.62, pivots: int = 64,
               inside: DataFrame | None = None) -> DataFrame:
    """Distinct candidate pairs (a < b, near: equal tokens of their signatures) of `reps` (rep, n_shingles, roots, sig).

    A few pairs per set and node, which join most groups. A node above `task_rows` sets is dealt to parts of that size,
    each compared together with some `pivots` sets of the whole node. No result depends on which pairs these are:
    sets of a node that they don't join are compared by `unjoined`. `inside` is the `company` of `reps`.
    """
    columns = ["path", "rep", "n_shingles", "sig", "roots", "tree", "whole"]
    inside = company(reps) if inside is None else inside
    # The trees in which a set's node is not cut up, as bits.
    bit = F.expr("shiftleft(1, tree)")
    bits = inside.groupBy("rep").agg(F.sum(F.when(F.col("_n") <= task_rows, bit).otherwise(0)).cast("int").alias("whole"))
    signed = reps.select("rep", "n_shingles", "sig", "roots").join(bits.hint("merge"), "rep")
    parts = F.when(F.col("_n") <= task_rows, 1).otherwise(F.ceil(F.col("_n") / max(1, task_rows - pivots))).cast("int")
    part = F.array(F.pmod(F.xxhash64("rep", "path"), parts).cast("int"))
    # The least numbers, which are hashes: nodes that share their sets share their pivots.
    everywhere = (parts > 1) & (F.col("rep") / 2.0 ** 64 + 0.5 < pivots / F.col("_n"))
    dealt = inside.select("*", F.explode(F.when(everywhere, F.sequence(F.lit(0), parts - 1)).otherwise(part)).alias("_part"))
    nodes = dealt.withColumn("path", F.xxhash64("path", "_part")).join(signed.hint("merge"), "rep").select(columns)
    # Most nodes are pairs: a task streams all nodes of its partition.
    return nodes.repartition("path").sortWithinPartitions("path", "rep").mapInArrow(_node_pairs(leaf, least), NEAR).distinct()


def _tokens(k: int):
    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield record_batch(TOKENS, {
                    "rep": part.column(0), "tokens": [shingles(text, k).astype("<u8").tobytes() for text in part.column(1).to_pylist()]})

    return run


def links_between(tokens: list[np.ndarray], labels: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (label, label) that join all labels that any near pair of the sets joins; as many as labels, less one.

    With two sides, sets of the first (0) meet those of the second, else all meet. The full sets of every such pair
    are compared, unless they are joined already.
    """
    names, own = np.unique(labels, return_inverse=True)
    # The sets of the most frequent label come last: they have no one to meet behind them.
    order = np.lexsort((own == np.bincount(own).argmax(), side))
    own, side, sizes = own[order], side[order], np.array([len(tokens[i]) for i in order])
    flat = np.unique(np.concatenate([tokens[i] for i in order]), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    second = int(np.searchsorted(side, 1))
    two = 0 < second < len(order)
    held, found = np.zeros(int(flat.max()) + 1, dtype=np.int32), []
    for x in range(second if two else len(order) - 1):
        at = second if two else x + 1
        small, large = np.minimum(sizes[x], sizes[at:]), np.maximum(sizes[x], sizes[at:])
        open_ = (own[at:] != own[x]) & (100 * small >= percent * large)
        if not open_.any():
            continue
        mine = flat[starts[x]:ends[x]]
        held[mine] = 1
        common = np.add.reduceat(held[flat[starts[at]:]], starts[at:] - starts[at])
        held[mine] = 0
        near = open_ & (100 * common >= percent * (sizes[x] + sizes[at:] - common))
        if near.any():
            met = np.unique(own[at:][near])
            found += [(int(names[own[x]]), int(names[y])) for y in met]
            own[np.isin(own, met)] = own[x]
    return found


def _meetings(percent: int):
    """The links of whole meetings: rows (meeting, side, label, tokens) come sorted by meeting."""
    def links(batch):
        meetings = np.asarray(batch.column(0))
        starts = np.flatnonzero(np.concatenate([[True], meetings[1:] != meetings[:-1]]))
        side, labels = np.asarray(batch.column(1)), np.asarray(batch.column(2))
        found = []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(meetings)], strict=True):
            tokens = [np.frombuffer(t.as_buffer(), "<u8") for t in batch.column(3).slice(start, end - start)]
            found += links_between(tokens, labels[start:end], side[start:end], percent)
        return record_batch(PAIRS, {"a": [a for a, _ in found], "b": [b for _, b in found]})

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.concat_batches([held, batch])
            meetings = np.asarray(held.column(0))
            whole = int(np.flatnonzero(meetings != meetings[-1])[-1]) + 1 if meetings[0] != meetings[-1] else 0
            if whole:
                yield links(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None:
            yield links(held)

    return run


def unjoined(inside: DataFrame, labels: DataFrame, texts: DataFrame, k: int, percent: int, part_tokens: int = 1 << 19) -> DataFrame:
    """Links (a, b) of labels: what joins the sets of any node of `inside` (path, rep) that `labels` (rep, label,
    n_shingles) don't join, by comparing all of their full sets.

    Nodes of one label have nothing to compare. Of any other node, however large, the sets of its largest label meet the
    rest, and those of the rest each other: both are dealt to parts of about `part_tokens` shingles, and every two
    parts meet in a group of their own. So a large group with some sets that only resemble it takes work in
    proportion, and only a node of many labels takes all pairs, in as many bounded groups. `texts` (rep, text) has
    at least the sets of `inside`.
    """
    rows = materialize(inside.select("path", "rep").join(labels, "rep"), "near-labelled")
    # Nodes of several trees often have the same sets; one of them is compared, told by two hashes of all sets.
    own = [F.bit_xor(F.xxhash64("rep", F.lit(i))).alias(f"_x{i}") for i in range(2)]
    each = rows.groupBy("path", "label").agg(F.sum("n_shingles").alias("_w"), F.count(F.lit(1)).alias("_n"), *own)
    mixed = each.groupBy("path").agg(
        F.count(F.lit(1)).alias("_labels"), F.max(F.struct("_w", "label")).alias("_m"), F.sum("_w").alias("_all"),
        F.sum("_n").alias("_n"), F.bit_xor("_x0").alias("_x0"), F.bit_xor("_x1").alias("_x1")).where("_labels > 1")
    mixed = mixed.groupBy("_n", "_x0", "_x1").agg(F.min(F.struct("path", "_m", "_all")).alias("_s")).select("_s.*")
    fits = F.col("_all") <= part_tokens
    rest = F.when(fits, 1).otherwise(F.ceil((F.col("_all") - F.col("_m._w")) / part_tokens)).cast("int")
    most = F.when(fits, 0).otherwise(F.ceil(F.col("_m._w") / part_tokens)).cast("int")
    mixed = materialize(mixed.select("path", F.col("_m.label").alias("_main"), rest.alias("_rest"), most.alias("_most")), "near-mixed")
    main = (F.col("label") == F.col("_main")) & (F.col("_most") > 0)
    dealt = rows.join(mixed, "path").select(
        "path", "rep", "label", "_rest", "_most", main.alias("_is_main"),
        F.when(main, F.col("_rest") + F.pmod(F.xxhash64("rep"), F.greatest("_most", F.lit(1)))).otherwise(
            F.pmod(F.xxhash64("rep"), F.col("_rest"))).cast("int").alias("_part"))
    others = F.sequence(F.lit(0), F.when(F.col("_is_main"), F.col("_rest")).otherwise(F.col("_rest") + F.col("_most")) - 1)
    met = dealt.select("*", F.explode(others).alias("_other")).select(
        F.xxhash64("path", F.least("_part", "_other"), F.greatest("_part", "_other")).alias("meeting"),
        (F.col("_part") > F.col("_other")).cast("int").alias("side"), "label", "rep")
    wanted = texts.join(dealt.select("rep").distinct(), "rep", "left_semi").select("rep", "text")
    tokens = materialize(wanted.mapInArrow(_tokens(k), TOKENS), "near-tokens")
    met = met.join(tokens.hint("merge"), "rep").select("meeting", "side", "label", "tokens")
    return met.repartition("meeting").sortWithinPartitions("meeting").mapInArrow(_meetings(percent), PAIRS).distinct()


def _texts(batches):
    for batch in batches:
        yield from text_slices(batch, "text")


def _confirm(k: int, percent: int):
    """The pairs (a, b, text of a, text of b) whose full sets are near; neighbours share the set of a."""
    def run(batches):
        last, x = None, None
        for batch in batches:
            for part in text_slices(batch, "y"):
                keep = []
                for a, left, right in zip(part.column(0).to_pylist(), part.column(2), part.column(3), strict=True):
                    if a != last:
                        last, x = a, shingles(left.as_py(), k)
                    y = shingles(right.as_py(), k)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                chosen = part.filter(pa.array(keep, pa.bool_()))
                yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], names=["a", "b"])

    return run


def _with_text(pairs: DataFrame, texts: DataFrame, side: str, name: str, most: int = 1_000) -> DataFrame:
    """`pairs` with the text of one side; a set with more than `most` pairs meets them in several places, with a
    copy of its text in each, so that a hub of any number of pairs is no single task's."""
    parts = F.ceil(F.count(F.lit(1)) / most).cast("int")
    counts = pairs.groupBy(F.col(side).alias("rep")).agg(parts.alias("_parts"))
    spread = texts.join(counts, "rep").select(
        F.col("rep").alias(side), F.col("text").alias(name), F.col("_parts"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    other = "b" if side == "a" else "a"
    placed = pairs.join(counts.where("_parts > 1").withColumnRenamed("rep", side), side, "left").withColumn(
        "_part", F.pmod(F.xxhash64(other), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    return placed.join(spread.drop("_parts"), [side, "_part"]).drop("_part")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The `pairs` (a, b) with 100 * intersection >= percent * union of the shingle sets of `texts` (rep, text)."""
    both = _with_text(_with_text(pairs, texts, "b", "y"), texts, "a", "x").select("a", "b", "x", "y")
    return both.sortWithinPartitions("a").mapInArrow(_confirm(k, percent), PAIRS)


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """Per row (doc_id, n_shingles, component_id, kept) of `docs` (doc_id, text).

    Links are confirmed on full sets: 100 * intersection >= percent * union. Equal sets are one
    representative, so exact copies in any number never meet in a node. Links are found in two steps: first a few
    candidates per set, which join most groups; then all pairs of a node's sets that are not joined yet, as no other
    can change a component. Only texts of sets in company are read again.

    Null texts and texts without a word have size 0 and are alone. Rows that share an id are each returned and
    share its component; a null id is alone. `kept` is true for every row of the smallest id. Other columns are
    ignored. A pair at the threshold has no node in common with (1 - 0.8 ** 3) ** 20, six in ten million; any
    other one is joined or compared, in nodes of any size.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    sets = materialize(narrow.mapInArrow(_sets(k), SETS), "near-sets")
    some = sets.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    # One number per distinct set, kept apart from ids, which need not be unique.
    keyed = F.xxhash64("set_key")
    reps = some.groupBy(keyed.alias("rep")).agg(
        F.min(F.struct("doc_id", "text_key")).alias("d"), F.min(F.struct("n_shingles", "roots", "sig")).alias("s")).select(
        "rep", "d.doc_id", "d.text_key", "s.*")
    reps = materialize(reps, "near-reps")
    inside = company(reps)
    pairs = materialize(candidates(reps.select("rep", "n_shingles", "roots", "sig"), inside=inside), "near-candidates")
    one_each = reps.select("rep", "doc_id", "text_key").join(inside.select("rep").distinct(), "rep", "left_semi")
    # A shuffle at every size, so that the plan of a small table tells what a large one takes.
    texts = narrow.join(materialize(one_each, "near-wanted").hint("merge"), ["doc_id", "text_key"]).select("rep", "text")
    texts = materialize(texts.dropDuplicates(["rep"]), "near-texts")
    links = confirmed(pairs.select("a", "b"), texts, k, percent)
    # Components are of ids: a linked pair of sets is one of their smallest ids, and the sets of one id are linked too.
    names = reps.select("rep", "n_shingles", F.col("doc_id").alias("least"))

    def named(side: str, name: str) -> DataFrame:
        return names.select(F.col("rep").alias(side), F.col("least").alias(name))

    linked = links.join(named("a", "x"), "a").join(named("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    member = some.select("doc_id", keyed.alias("rep")).distinct().join(names, "rep").select("doc_id", "least")
    member = materialize(member.distinct(), "near-members")
    lowest = member.groupBy("doc_id").agg(F.min("least").alias("a"), F.count(F.lit(1)).alias("_n"))
    several = member.join(lowest.where("_n > 1"), "doc_id").where("least <> a").select("a", F.col("least").alias("b"))
    joined = materialize(components(linked.unionByName(several), "near-first"), "near-joined")
    labels = names.join(joined.withColumnRenamed("id", "least"), "least", "left").select(
        "rep", "n_shingles", F.coalesce("component", "least").alias("label"))
    bridges = unjoined(inside, labels, texts, k, percent)
    # Between the components found so far: few, whatever their size.
    merged = components(bridges, "near-second").withColumnsRenamed({"id": "label", "component": "_last"})
    whose = lowest.select("doc_id", F.col("a").alias("least")).join(joined.withColumnRenamed("id", "least"), "least", "left").select(
        "doc_id", F.coalesce("component", "least").alias("label")).join(merged, "label", "left").select(
            "doc_id", F.least("doc_id", F.coalesce("_last", "label")).alias("component_id"))
    out = sets.select("doc_id", "n_shingles").join(whose, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op8_minhash(spark, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents, on four-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame, k: int = 5) -> DataFrame:
    """Rows of `docs` that are kept; rows that share a kept id all stay, and so do null ids."""
    gone = near_duplicates(docs, k).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
