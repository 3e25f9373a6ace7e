"""Conversation prefix trie by a splitter skeleton (operator 12).

A conversation is a path of fixed-size turn tokens, so that the members of a trie node are neighbours in the
order of paths. Paths are cut into ranges by sampled splitters; the trie of the splitters' own paths, the
skeleton, is broadcast. A node outside the skeleton has all its members in one range: the sorted shard finishes it in
one walk. Skeleton nodes get a partial aggregate from each shard, and the partials are reduced.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import fields, record_batch, table
from rostrum.session import materialize

#: A turn's token: 32 hex digits of role and text, 8 of the text's bytes.
TOKEN = 40
#: Turns of a sampled path that there is room for in any case.
DEEP = 16
#: The most turns that a conversation takes over from another.
SHARED = 8
NO_ENDS = hashlib.sha256(b"").hexdigest()
KEYED = fields("shard int, path string, conv_id long")
#: kind 0: a finished node, `skeleton` its parent there or -1; 1: a skeleton node's partial; 2: a piece of its ends.
WALKED = fields(
    "kind int, conv_id long, depth long, parent_conv_id long, skeleton int, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, piece binary")
ENDS = fields("skeleton int, ends_sha256 string")
NODES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turn_token(role: Column, text: Column) -> Column:
    """The token of a turn; null role or text counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    # The role's length keeps ("a", "bc") and ("ab", "c") apart.
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path) of the rebuilt conversations, by the contract's rule; one shuffle of tokens, not of texts."""
    conv = F.col("conv_id").cast("long")
    rows = turns.select(conv.alias("conv_id"), "turn", turn_token(F.col("role"), F.col("text")).alias("token")).where(
        F.col("conv_id").isNotNull()).withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    listed = rows.repartition("base").groupBy("base", "conv_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("turn", "token"))), lambda t: t["token"]), "").alias("own"))
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.substring("own", 1, SHARED * TOKEN))).over(Window.partitionBy("base"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED + 1) * TOKEN).cast("int")
    return listed.withColumns({"_head": F.coalesce(head, F.lit("")), "_taken": taken}).select(
        "conv_id",
        F.when(F.col("conv_id") == F.col("base"), F.col("own")).otherwise(F.concat(
            F.substring("_head", F.lit(1), F.col("_taken")), F.substring("own", F.col("_taken") + 1, F.length("own")))).alias("path"))


def choose_splitters(paths: DataFrame, shard_bytes: int, skeleton_bytes: int, per_shard: int = 8) -> list[tuple[str, int]]:
    """Sorted (path, conv_id) that cut `paths` into ranges of about `shard_bytes`, larger where the ranges would be
    more than `skeleton_bytes` has room for.

    A hash sample of `per_shard` rows a shard comes to the driver, its paths cut so that all of it stays
    below `skeleton_bytes` (a cut path still parts the order rightly). Each row weighs its own length.
    """
    n, total = paths.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("path") + TOKEN), F.lit(0))).first()
    shards = max(1, -(-total // shard_bytes))
    if shards == 1:
        return []
    wanted = max(1, min(n, per_shard * shards, skeleton_bytes // (DEEP * TOKEN)))
    longest = max(1, skeleton_bytes // wanted // TOKEN) * TOKEN
    share = 2.0 * wanted / n  # as the order below takes `wanted` of them
    drawn = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < share * (1 << 30)).select(
        F.xxhash64("conv_id").alias("h"), F.substring("path", 1, longest).alias("path"), "conv_id", (F.length("path") + TOKEN).alias("size"))
    sample = sorted((r["path"], r["conv_id"], r["size"]) for r in drawn.orderBy("h", "conv_id").limit(wanted).collect())
    shards = min(shards, max(1, len(sample) // min(per_shard, 4)))
    whole, seen, cuts = sum(r[2] for r in sample), 0, []
    for path, conv, size in sample:
        if seen * shards >= (len(cuts) + 1) * whole:
            cuts.append((path, conv))
        seen += size
    return cuts


def skeleton_of(splitters: list[tuple[str, int]]) -> list[tuple[int, str]]:
    """The trie of the splitters' paths as (parent, token) rows, the root first, parents before children."""
    rows, known = [(-1, "")], {}
    for path, _ in splitters:
        node = 0
        for at in range(0, len(path), TOKEN):
            key = (node, path[at:at + TOKEN])
            if key not in known:
                known[key] = len(rows)
                rows.append(key)
            node = known[key]
    return rows


def _deal(splitters):
    def run(batches):
        cuts = splitters.value
        for batch in batches:
            convs, paths = (c.to_pylist() for c in batch.columns)
            yield record_batch(KEYED, {"shard": [bisect_right(cuts, key) for key in zip(paths, convs, strict=True)],
                                       "path": paths, "conv_id": convs})

    return run


class _Node:
    """An open node of the walk."""

    __slots__ = ("token", "skeleton", "least", "convs", "children", "leaves", "saved", "ends", "pending")

    def __init__(self, token: str, skeleton: int):
        self.token, self.skeleton, self.least = token, skeleton, None
        self.convs = self.children = self.leaves = self.saved = 0
        self.ends, self.pending = None, []


class Walk:
    """One pass over sorted (path, conv_id): finished nodes, partials and pieces of ends in `out`."""

    def __init__(self, skeleton: dict[tuple[int, str], int], piece_bytes: int = 1 << 16):
        self.skeleton, self.piece_bytes = skeleton, piece_bytes
        self.stack: list[_Node] = []
        self.out: list[tuple] = []

    def _piece(self, node: _Node) -> None:
        first, listed = node.ends
        self.out.append((2, first, None, None, node.skeleton, None, None, None, None, None, ",".join(listed).encode()))

    def _close(self) -> None:
        node, depth = self.stack.pop(), len(self.stack)
        parent = self.stack[-1] if self.stack else None
        inner = node.skeleton < 0
        if node.pending:
            known = node.least if inner else None
            self.out.extend((0, conv, depth + 1, known, node.skeleton, *rest, None) for conv, *rest in node.pending)
        if inner:
            node.leaves = node.leaves or 1
            node.saved += (node.convs - 1) * int(node.token[32:], 16)
            parent.children += 1
            parent.leaves += node.leaves
            parent.saved += node.saved
            parent.pending.append((node.least, node.convs, node.children, node.leaves, node.saved,
                                   node.ends.hexdigest() if node.ends else NO_ENDS))
        else:
            if node.ends:
                self._piece(node)
            self.out.append((1, node.least, depth, None, node.skeleton, node.convs, node.children, node.leaves, node.saved, None, None))
        if parent:
            parent.convs += node.convs
            parent.least = node.least if parent.least is None else min(parent.least, node.least)

    def row(self, path: str, conv: int) -> None:
        stack = self.stack
        if not stack:
            stack.append(_Node("", 0))
        tokens = [path[at:at + TOKEN] for at in range(0, len(path), TOKEN)]
        same = 0
        while same < len(tokens) and same + 1 < len(stack) and stack[same + 1].token == tokens[same]:
            same += 1
        while len(stack) > same + 1:
            self._close()
        for token in tokens[same:]:
            above = stack[-1].skeleton
            stack.append(_Node(token, self.skeleton.get((above, token), -1) if above >= 0 else -1))
        node = stack[-1]
        node.convs += 1
        node.least = conv if node.least is None else min(node.least, conv)
        if node.skeleton < 0:
            if node.ends is None:
                node.ends = hashlib.sha256(str(conv).encode())
            else:
                node.ends.update(f",{conv}".encode())
            return
        if node.ends is None:
            node.ends = (conv, [])
        node.ends[1].append(str(conv))
        if len(node.ends[1]) * 8 >= self.piece_bytes:
            self._piece(node)
            node.ends = None

    def end(self) -> None:
        while self.stack:
            self._close()


def _walk(skeleton):
    def run(batches):
        known = {row: i for i, row in enumerate(skeleton.value)}
        walk, shard = Walk(known), None

        def written():
            rows, walk.out = walk.out, []
            return record_batch(WALKED, {n: [r[i] for r in rows] for i, n in enumerate(WALKED.names)})

        for batch in batches:
            for now, path, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != shard:
                    walk.end()
                    shard = now
                walk.row(path, conv)
                if len(walk.out) >= 20_000:
                    yield written()
        walk.end()
        yield written()

    return run


def _hash_ends(batches):
    """The hash of each skeleton node's ids from its pieces in order; only the hash state is held."""
    node, state = None, None
    for batch in batches:
        out = []
        for now, _, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now == node:
                state.update(b"," + piece)
                continue
            if node is not None:
                out.append((node, state.hexdigest()))
            node, state = now, hashlib.sha256(piece)
        yield record_batch(ENDS, {n: [r[i] for r in out] for i, n in enumerate(ENDS.names)})
    if node is not None:
        yield record_batch(ENDS, {"skeleton": [node], "ends_sha256": [state.hexdigest()]})


def _reduce_up(skeleton: list[tuple[int, str]], partials: dict[int, list[int]]) -> list[tuple]:
    """Rows (skeleton, conv_id, depth, parent_conv_id, n_convs, ...) from the partials (one row a skeleton node)."""
    for node in range(len(skeleton) - 1, -1, -1):
        parent, token = skeleton[node]
        own = partials[node]  # least, convs, children, leaves, saved, depth
        own[3] = own[3] or 1
        if node:
            own[4] += (own[1] - 1) * int(token[32:], 16)
            above = partials[parent]
            above[2] += 1
            above[3] += own[3]
            above[4] += own[4]
    return [(node, own[0], own[5], partials[skeleton[node][0]][0] if node else None, *own[1:5]) for node, own in sorted(partials.items())]


def prefix_trie(paths: DataFrame, shard_bytes: int = 1 << 20, skeleton_bytes: int = 32 << 20) -> DataFrame:
    """One row per node of the trie of `paths` (conv_id, path), columns NODES.

    A shard is a range of about `shard_bytes` of paths; its key ends with the conv_id, so that a path that holds
    a third of all conversations is cut into several shards as well. A task streams its sorted rows and holds the
    open nodes and the finished children of each, bounded by the shard. The skeleton has at most
    skeleton_bytes / 40 nodes: that bounds what is broadcast, the partials that come to the driver after
    the reduction, and the final join. The ids that end at a skeleton node travel as joined pieces
    of some 64 KB and are hashed in order by one streaming task, as the hash is sequential.

    One conversation is one value of 40 bytes a turn and must fit into a task; its texts do not travel.
    No rows give no nodes, not even a root.
    """
    spark = paths.sparkSession
    splitters = choose_splitters(paths, shard_bytes, skeleton_bytes)
    skeleton = skeleton_of(splitters)
    context = spark.sparkContext
    cuts, shared = context.broadcast(splitters), context.broadcast(skeleton)
    dealt = paths.select("conv_id", "path").mapInArrow(_deal(cuts), KEYED)
    ordered = dealt.repartitionById(len(splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    walked = materialize(ordered.mapInArrow(_walk(shared), WALKED), "trie-walk")
    reduced = walked.where("kind = 1").groupBy("skeleton").agg(
        F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"), F.min("depth")).collect()
    partials = {r[0]: list(r[1:]) for r in reduced}
    rows = _reduce_up(skeleton, partials) if partials else []
    top = spark.createDataFrame(rows, fields(
        "skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"))
    pieces = walked.where("kind = 2").select("skeleton", "conv_id", "piece")
    ends = pieces.repartition("skeleton").sortWithinPartitions("skeleton", "conv_id").mapInArrow(_hash_ends, ENDS)
    upper = top.join(ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    parents = F.broadcast(top.select("skeleton", F.col("conv_id").alias("_parent")))
    lower = walked.where("kind = 0").join(parents, "skeleton", "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
    return lower.select(*NODES).unionByName(upper.select(*NODES))


def conversation_trie(turns: DataFrame, shard_bytes: int = 1 << 20, skeleton_bytes: int = 32 << 20) -> DataFrame:
    """The trie of rebuilt conversations of `turns` (conv_id, turn, role, text).

    Turns go by `turn`, null first; rows that share a conversation's turn number follow the order of their
    tokens (a hash of role and text), and repeated rows are turns of their own. Null roles and
    texts are empty. Rows without a conv_id belong to no conversation and are left out. The remainder by 5 of a
    negative id has its sign, as in SQL. Other columns are not read.
    """
    return prefix_trie(materialize(rebuilt_paths(turns), "trie-paths"), shard_bytes, skeleton_bytes)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


#: DuckDB form of the registered query. crc32 is computed bit by bit, as the engine has no function for it.
SQL = r"""
WITH t AS (SELECT conv_id AS c, strlen(coalesce(text, '')) AS bytes,
        md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS token, turn FROM conversations
      WHERE conv_id IS NOT NULL),
o AS (SELECT c, bytes, token, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, token) AS p FROM t),
k AS (SELECT c, c - c % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(CAST(c AS VARCHAR), ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END), 4294967295::BIGINT) % 9 AS h
      FROM (SELECT DISTINCT c FROM o)),
r AS (SELECT k.c, 0 AS part, p, token, bytes FROM k JOIN o ON o.c = k.base AND p <= h
      UNION ALL SELECT k.c, 1, p, token, bytes FROM k JOIN o ON o.c = k.c AND p > h),
s AS (SELECT k.c, coalesce(list(token ORDER BY part, p) FILTER (token IS NOT NULL), []) AS tokens,
        coalesce(list(bytes ORDER BY part, p) FILTER (token IS NOT NULL), []) AS sizes FROM k LEFT JOIN r USING (c) GROUP BY k.c),
m AS (SELECT c, d, array_to_string(tokens[1:d], '') AS node, coalesce(sizes[d], 0) AS size, len(tokens) = d AS ends
      FROM s, unnest(range(len(tokens) + 1)) AS u(d)),
n AS (SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY node, d),
f AS (SELECT node, left(node, greatest(length(node) - 32, 0)) AS up, d FROM n),
q AS (SELECT up AS node, count(*) AS n_children FROM f WHERE d > 0 GROUP BY up),
a AS (SELECT left(n.node, 32 * u.e) AS node, n.saved, q.node IS NULL AS leaf FROM n LEFT JOIN q USING (node), unnest(range(n.d + 1)) AS u(e)),
g AS (SELECT node, sum(saved) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM a GROUP BY node)
SELECT n.conv_id, n.d AS depth, CASE WHEN n.d > 0 THEN up.conv_id END AS parent_conv_id, n.n_convs,
  coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN f USING (node) JOIN g USING (node) LEFT JOIN q USING (node) LEFT JOIN n AS up ON up.node = f.up
"""
