"""Prefix tries over conversations, built as burst tries.

A path is a string of 16 bytes per turn, each the digest of the turn and all
turns before it. Paths share beginnings exactly where conversations do, and the
last 16 bytes of a beginning are its node's key. A container holds the paths below one node. It starts at the root;
a container with too many paths bursts by the next turn, so its node becomes a
trie head and its paths move to the containers below. A round bursts several
levels at once, twice as many as the round before, so a long shared beginning
takes few rounds. What is left is small: each container is sorted and swept
into nodes by one task, and the heads get their sums from the containers' tops.

Equal paths are one row with a count, so thousands of copies fill no container.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poseval.llm.common import SPACES
from poseval.schema import require_columns
from poseval.session import stage

#: Bytes of a turn's digest.
TURN = 16
#: Turns that another conversation may give at most.
MAX_HEAD = 3
#: A container with more paths, or more bytes of paths, bursts.
MAX_PATHS, MAX_BYTES = 2048, 1 << 22
#: Levels that the first round bursts.
LEVELS = 4
#: Heads up to which a round sends their digests to every task, 16 bytes each.
MAX_BROADCAST_HEADS = 500_000
#: Ids of conversations that end alike are first joined in groups of so many numbers.
ID_GROUP_BITS = 10


def _words(text: str) -> Column:
    return F.regexp_count(F.col(text), F.lit(rf"[^{SPACES[1:]}+")).cast("int")


def conversation_paths(turns: DataFrame, base: Column | None = None, n_head: Column | None = None) -> DataFrame:
    """``conv_id, path, words`` of every conversation: digests and word counts of its turns in order.

    Turns are ordered by ``turn``, null first, then by their digest; a null role
    or text is empty; rows without ``conv_id`` are left out; repeated rows are
    turns of their own; other columns are ignored. One conversation has to fit a
    task's memory, at 20 bytes a turn.

    ``base`` and ``n_head``, expressions of ``conv_id``, replace the first
    ``n_head`` turns of a conversation (3 at most) by those of conversation
    ``base``: all of them if it has fewer, none if it is absent.
    """
    require_columns(turns, ["conv_id", "turn", "role", "text"])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn", digest.alias("digest"), _words("text").alias("words"))
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    own = own.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))
    if base is not None:
        own = stage(own, "trie-turns")  # both sides of the join are then plain reads, which Spark can divide
        first = own.select(F.col("conv_id").alias("base_id"), F.slice("turns", 1, MAX_HEAD).alias("first"))
        known = own.withColumns({"base_id": base, "n_head": n_head.cast("int")}).join(first, "base_id", "left")
        head = F.slice(F.coalesce("first", F.slice("turns", 1, 0)), F.lit(1), F.col("n_head"))
        tail = F.slice("turns", F.col("n_head") + 1, F.greatest(F.size("turns") - F.col("n_head"), F.lit(0)))
        own = known.select("conv_id", F.concat(head, tail).alias("turns"))
    digests = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = own.select("conv_id", digests.alias("digests"), F.transform("turns", lambda t: t["words"]).alias("words"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = [_chain(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(paths, pa.binary()), b.column(2)], names=["conv_id", "path", "words"])

    return rows.mapInArrow(chain, "conv_id long, path binary, words array<int>")


def _chain(digests: bytes) -> bytes:
    """Digest of each turn with all turns before it."""
    out, last = [], b""
    for i in range(0, len(digests), TURN):
        last = hashlib.md5(last + digests[i : i + TURN]).digest()
        out.append(last)
    return b"".join(out)


_SEQUENCE = "path binary, words array<int>, n_here long, conv_id long, ends_sha256 string"


def distinct_paths(paths: DataFrame) -> DataFrame:
    """Each path once: ``n_here`` conversations, the smallest id, and the SHA-256 of all their ids.

    The ids, decimal and joined by commas in numerical order, are hashed as a
    stream over groups of at most 1,024 numbers, so no list of copies is ever
    in one row, and a task holds one group.
    """
    group = F.shiftright("conv_id", ID_GROUP_BITS)
    parts = paths.groupBy(_own().alias("key"), group.alias("part")).agg(
        F.first("path").alias("path"),
        F.first("words").alias("words"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("conv_id"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"),
    )
    ordered = parts.repartition("key").sortWithinPartitions("key", "part").select("key", "path", "words", "n", "conv_id", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, row, sha = None, None, None

        def done() -> pa.RecordBatch:
            return _batch([(*row, sha.hexdigest())], _SEQUENCE_TYPES)

        for b in batches:
            out = []
            for k, path, words, n, conv, ids in zip(*(c.to_pylist() for c in b.columns)):
                if k == key:
                    row[2] += n
                    sha.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((*row, sha.hexdigest()))
                key, row, sha = k, [path, words, n, conv], hashlib.sha256(ids.encode())
            if out:
                yield _batch(out, _SEQUENCE_TYPES)
        if key is not None:
            yield done()

    return ordered.mapInArrow(run, _SEQUENCE)


_SEQUENCE_TYPES = {
    "path": pa.binary(),
    "words": pa.list_(pa.int32()),
    "n_here": pa.int64(),
    "conv_id": pa.int64(),
    "ends_sha256": pa.string(),
}


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], names=list(types))


def _prefix(depth: Column) -> Column:
    return F.substring(F.col("path"), F.lit(1), (depth * TURN).cast("int"))


def _key(depth: Column) -> Column:
    """Key of the node at ``depth``; empty at the root."""
    return F.when(depth > 0, F.substring(F.col("path"), ((depth - 1) * TURN + 1).cast("int"), F.lit(TURN))).otherwise(F.lit(b""))


def _own() -> Column:
    return F.substring("path", -TURN, TURN)


def _length() -> Column:
    return F.floor(F.octet_length("path") / TURN).cast("int")


def burst(sequences: DataFrame, max_paths: int = MAX_PATHS, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, DataFrame]:
    """Containers and heads of the trie over ``sequences``, a stored table of distinct paths.

    Returns ``sequences`` with ``top``, the depth of its container's top node,
    and the heads ``key, depth, path, words`` (of the last turn; path and key of
    the node). A path that ends at a head has a ``top`` below its own end.
    """
    spark = sequences.sparkSession
    size = sequences.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0)).alias("bytes")).first()
    if size["n"] <= 1 or (size["n"] <= max_paths and size["bytes"] <= max_bytes):
        none = sequences.where("false").select(F.lit(b"").alias("key"), F.lit(0).alias("depth"), "path", F.lit(0).alias("words"))
        return sequences.withColumn("top", F.lit(0)), none
    empty = F.lit(b"")
    heads = [spark.range(1).select(empty.alias("key"), F.lit(0).alias("depth"), empty.alias("path"), F.lit(0).alias("words"))]
    settled, at, levels = [], 0, LEVELS
    waiting = sequences
    while True:
        # Every prefix that this round looks at, one row each; their sizes are summed where the rows are, first.
        reach = F.sequence(F.lit(at + 1), F.least(_length(), F.lit(at + levels)))
        probes = waiting.where(_length() > at).select("path", "words", F.explode(reach).alias("depth"))
        probes = probes.select(_key(F.col("depth")).alias("key"), "depth", "path", F.get("words", F.col("depth") - 1).alias("last"))
        sums = probes.groupBy("key", "depth").agg(
            F.first(_prefix(F.col("depth"))).alias("path"),
            F.first("last").alias("words"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.octet_length("path")).alias("bytes"),
        )
        large = sums.where((F.col("n") > 1) & ((F.col("n") > max_paths) | (F.col("bytes") > max_bytes)))
        large = stage(large.select("key", "depth", "path", "words"), "trie-heads")
        found = large.count()
        if found == 0:
            settled.append(waiting.withColumn("top", F.lit(at + 1)))
            break
        heads.append(large)
        keys = large.select("key")
        hits = probes.select(_own().alias("own"), "key", "depth")
        hits = hits.join(F.broadcast(keys) if found <= MAX_BROADCAST_HEADS else keys, "key", "left_semi")
        deepest = hits.groupBy("own").agg(F.max("depth").alias("deepest"))
        moved = waiting.withColumn("own", _own()).join(deepest, "own", "left").drop("own")
        moved = stage(moved.withColumn("top", F.coalesce("deepest", F.lit(at)) + 1), "trie-round")
        # A head at the last level of the round may go on below it.
        open_end = F.coalesce(F.col("deepest") == at + levels, F.lit(False))
        settled.append(moved.where(~open_end).drop("deepest"))
        waiting = moved.where(open_end).drop("deepest", "top")
        at, levels = at + levels, levels * 2
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    table = heads[0]
    for part in heads[1:]:
        table = table.unionByName(part)
    return out, stage(table, "trie-all-heads")


_NODE_TYPES = {
    "key": pa.binary(),
    "parent_key": pa.binary(),
    "path": pa.binary(),
    "conv_id": pa.int64(),
    "depth": pa.int64(),
    "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(),
    "ends_sha256": pa.string(),
}
_NODES = (
    "key binary, parent_key binary, path binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


class _Node:
    """An open node of the sweep, with the sums over what is finished below it."""

    __slots__ = ("depth", "words", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends")

    def __init__(self, depth: int, words: int):
        self.depth, self.words, self.conv_id, self.ends = depth, words, None, NO_ENDS
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0


def _sweep(top: int, rows: list[tuple]) -> list[list]:
    """Nodes of one container from its sorted paths; the first one is its top.

    The open nodes are those of the current path. A node is finished when a path
    that does not go through it comes, and then counts for its parent.
    """
    out: list[list] = []
    open_nodes: list[tuple[_Node, list]] = []

    def close(depth: int) -> None:
        while open_nodes and open_nodes[-1][0].depth >= depth:
            node, row = open_nodes.pop()
            if not node.n_children:
                node.n_leaves = 1
            node.saved += (node.n_convs - 1) * node.words
            row[:] = [node.conv_id, node.depth, None, node.n_convs, node.n_children, node.n_leaves, node.saved, node.ends]
            if open_nodes:
                up, up_row = open_nodes[-1]
                up.n_convs += node.n_convs
                up.n_children += 1
                up.n_leaves += node.n_leaves
                up.saved += node.saved
                up.conv_id = node.conv_id if up.conv_id is None else min(up.conv_id, node.conv_id)
                row.append(up_row)
            else:
                row.append(None)

    before = None
    for path, words, n_here, conv_id, ends in rows:
        depth = len(path) // TURN
        common = top
        if before is not None:
            limit = min(len(before), len(path)) // TURN
            while common < limit and path[common * TURN : (common + 1) * TURN] == before[common * TURN : (common + 1) * TURN]:
                common += 1
            close(common + 1)
        for d in range(top if before is None else common + 1, depth + 1):
            row: list = []
            out.append(row)
            open_nodes.append((_Node(d, words[d - 1] if d else 0), row))
        node = open_nodes[-1][0]
        node.n_convs += n_here
        node.conv_id = conv_id if node.conv_id is None else min(node.conv_id, conv_id)
        node.ends = ends
        before = path
    close(top)
    for row in out:
        parent = row.pop()
        row[2] = parent[0] if parent is not None else None
    return out


def _swept(containers: DataFrame) -> DataFrame:
    """All nodes of all containers. A task holds one container at a time."""
    ordered = containers.select(_key(F.col("top")).alias("key"), "top", "path", "words", "n_here", "conv_id", "ends_sha256")
    ordered = ordered.repartition("key").sortWithinPartitions("key", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, top, rows = None, 0, []

        def done() -> pa.RecordBatch:
            path = rows[0][0][: top * TURN]
            above = path[-2 * TURN : -TURN] if top else None
            nodes = _sweep(top, rows)
            return _batch([(key, above, path, *n) if i == 0 else (None, None, None, *n) for i, n in enumerate(nodes)], _NODE_TYPES)

        for b in batches:
            for k, t, *row in zip(*(c.to_pylist() for c in b.columns)):
                if k != key and rows:
                    yield done()
                    rows = []
                key, top = k, t
                rows.append(row)
        if rows:
            yield done()

    return ordered.mapInArrow(run, _NODES)


_SHOWN = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(paths: DataFrame, max_paths: int = MAX_PATHS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per node of the trie over ``conversation_paths``.

    ``conv_id`` is the smallest member, ``parent_conv_id`` its parent's (null at
    the root), ``n_convs`` the members, ``n_children`` and ``n_leaves`` the
    nodes below, ``saved_tokens`` the words that sharing saves in its subtree,
    ``ends_sha256`` the digest of the ids of conversations that end there.
    Conversations without turns are members of the root; no conversation, no
    node.
    """
    sequences = stage(distinct_paths(paths), "trie-paths")
    containers, heads = burst(sequences, max_paths, max_bytes)
    at_head = F.col("top") > _length()
    swept = stage(_swept(containers.where(~at_head)), "trie-nodes")
    # What heads get: the tops of containers right and further below them, and paths that end at one.
    tops = swept.where("key IS NOT NULL AND depth > 0").select(
        "path", (F.col("depth") - 1).cast("int").alias("last"), "conv_id", "n_convs", "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"), F.lit(1).alias("child")
    )
    ends = containers.where(at_head).select(
        "path", _length().alias("last"), "conv_id", F.col("n_here").alias("n_convs"), F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.col("ends_sha256").alias("ends"), F.lit(0).alias("child")
    )
    above = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("at")
    given = tops.unionByName(ends).select("*", above)
    direct = F.col("at") == F.col("last")
    sums = given.groupBy(_key(F.col("at")).alias("key")).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("below"),
        F.sum(F.when(direct, F.col("child")).otherwise(0)).alias("children"),
        F.max(F.when(direct, F.col("ends"))).alias("ends"),
    )
    known = stage(heads.join(sums, "key").withColumn("own", (F.col("n_convs") - 1) * F.col("words")), "trie-sums")
    down = known.select("own", F.explode(F.transform(F.sequence(F.lit(0), "depth"), _key)).alias("key"))
    shared = down.groupBy("key").agg(F.sum("own").alias("shared"))
    parent = F.when(F.col("depth") > 0, _key(F.col("depth") - 1))
    placed = known.withColumn("parent_key", parent)
    inner = placed.where("depth > 0").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("inner"))
    up = stage(known.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up")), "trie-ids")
    table = placed.join(shared, "key").join(inner, "key", "left").join(up, "parent_key", "left").select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.col("up").alias("parent_conv_id"),
        "n_convs",
        (F.col("children") + F.coalesce("inner", F.lit(0))).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("below") + F.col("shared")).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    outer = swept.where("parent_key IS NOT NULL").join(up, "parent_key", "left").withColumn("parent_conv_id", F.col("up"))
    rest = swept.where("parent_key IS NULL")
    return table.unionByName(outer.select(_SHOWN)).unionByName(rest.select(_SHOWN))
