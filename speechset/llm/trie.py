"""The prefix trie of conversations, from vertical bitmaps.

A node is a distinct sequence of first turns; its members are the conversations that start with it. Conversations are
dealt into shards of ``SHARD`` in id order. A shard indexes each (position, turn) as a bitset of its conversations, and
goes depth first: a node's bitset without those that end there is split by meeting it with the posting of the turn that
its lowest member has next, until it is empty. The meeting is the child's bitset; its ones are the child's members, its
lowest one the smallest id, and its meeting with the bitset of ends the child's end list. So a shard costs a step per node of
its own, however many turns the index holds.

Nodes of all shards meet by (depth, digest of the turns so far). What a node sums over its subtree does not need a round per
depth: each node belongs to the smallest of its members, whose own nodes are the last part of its path, so a sum over the
distinct nodes below a node is a sum over its members of what each owns from there on. A second walk of the shards adds these
up. Turns are compared by 128 bits: MD5 of role and text, and two 64-bit hashes of that with the position, whose exclusive or over
a path is the path's digest.

No group grows with the data. A shard holds ``SHARD`` conversations, and at most ``SEGMENT`` turns of each: a longer
conversation is cut, and the next segment starts from the digest so far. A node with very many members is a row per shard. Its end
list stays a row per shard too, in id order.

Cases: a null turn number comes first; turns with the same number follow each other by MD5 of role and text. Null roles and texts are
empty. Repeated rows are turns of their own. Rows without a conversation id belong to no conversation and are left out. A conversation
without turns, which only ``members`` can name, is a member of the root and ends there. Other columns are not looked at. No
conversation: no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speechset.llm.frames import quoted
from speechset.operators.positions import dense_positions
from speechset.session import materialize

SHARD = 1024
SEGMENT = 256


@dataclass(frozen=True)
class Trie:
    """``nodes``: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, and the digest ``path_a,
    path_b``. ``ends``: depth, path_a, path_b, part and conv_ids, in which the parts of a node in order are the ascending ids of
    the conversations that end there."""

    nodes: DataFrame
    ends: DataFrame


def turn_keys(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, pos, key, n_bytes`` of every turn: its place from 0, what it is compared by, and the UTF-8 bytes of its text."""
    role, text = (F.coalesce(quoted(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.select(
        quoted(conv_col).cast("bigint").alias("conv_id"),
        quoted(turn_col).cast("bigint").alias("turn"),
        F.md5(F.concat(F.md5(role), text)).alias("key"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    ).where("conv_id IS NOT NULL")
    # A number of its own for each row lets equal rows lie in several pieces; stored, so that it stays the same.
    stored = materialize(turns.withColumn("row", F.monotonically_increasing_id()), "turns")
    placed = dense_positions(stored, ["turn", "key", "row"], ["conv_id"], "pos")
    return materialize(placed.select("conv_id", "pos", "key", "n_bytes"), "turn-keys")


def _segments(turns: DataFrame, members: DataFrame) -> DataFrame:
    """Pieces of conversations: their turns' hashes and bytes in order, the digest before them, the bytes after them, and
    whether the conversation ends with them."""
    hashed = turns.select(
        "conv_id", "pos", "n_bytes", F.expr(f"pos div {SEGMENT}").alias("seg"),
        F.xxhash64("key", "pos").alias("a"), F.xxhash64("pos", "key").alias("b"),
    )
    pieces = hashed.groupBy("conv_id", "seg").agg(
        F.array_sort(F.collect_list(F.struct("pos", "a", "b", "n_bytes"))).alias("turns"),  # at most SEGMENT
        F.bit_xor("a").alias("sum_a"), F.bit_xor("b").alias("sum_b"), F.sum("n_bytes").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy("seg")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    # Only sums of pieces go through the window, so even a conversation with most of the turns is a short one here.
    scanned = pieces.select(
        "conv_id", "seg",
        F.coalesce(F.bit_xor("sum_a").over(before), F.lit(0)).cast("bigint").alias("start_a"),
        F.coalesce(F.bit_xor("sum_b").over(before), F.lit(0)).cast("bigint").alias("start_b"),
        F.coalesce(F.sum("bytes").over(after), F.lit(0)).cast("bigint").alias("after"),
        F.lead("seg").over(order).isNull().alias("last"),
    )
    whole = pieces.select("conv_id", "seg", "turns").join(scanned, ["conv_id", "seg"])
    ranked = dense_positions(members.select("conv_id").distinct(), "conv_id", out="rank")
    joined = ranked.join(whole, "conv_id", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "conv_id",
        F.expr(f"rank div {SHARD}").alias("shard"),
        F.coalesce("seg", zero).alias("seg"),
        *[F.coalesce(F.col(f"turns.{f}"), F.array().cast("array<bigint>")).alias(f) for f in ("a", "b", "n_bytes")],
        *[F.coalesce(c, zero).alias(c) for c in ("start_a", "start_b", "after")],
        F.coalesce("last", F.lit(True)).alias("last"),
    )


def _walk(table: pa.Table) -> Iterator[tuple[int, tuple[int, int], tuple[int, int] | None, int, int, int]]:
    """All nodes of a shard's segment, depth first: depth, digest, parent's digest, bytes of the last text, bitset of
    members, bitset of those that end there. Bit i is the i-th row in id order."""
    a, b, sizes = (table.column(c).to_pylist() for c in ("a", "b", "n_bytes"))
    base = table.column("seg")[0].as_py() * SEGMENT
    starts: dict[tuple[int, int], int] = {}
    postings: dict[tuple[int, int, int], int] = {}
    ends: dict[int, int] = {}
    last = table.column("last").to_pylist()
    for i, start in enumerate(zip(table.column("start_a").to_pylist(), table.column("start_b").to_pylist())):
        bit = 1 << i
        starts[start] = starts.get(start, 0) | bit
        for pos, turn in enumerate(zip(a[i], b[i])):
            key = (pos, *turn)
            postings[key] = postings.get(key, 0) | bit
        if last[i]:
            ends[len(a[i])] = ends.get(len(a[i]), 0) | bit
    for start, members in starts.items():
        if base == 0:
            yield 0, start, None, 0, members, members & ends.get(0, 0)
        open_nodes = [(0, start, members)]
        while open_nodes:
            depth, digest, members = open_nodes.pop()
            left = members & ~ends.get(depth, 0)
            while left:
                first = (left & -left).bit_length() - 1
                if depth == len(a[first]):  # goes on in the next segment
                    left ^= 1 << first
                    continue
                turn = (a[first][depth], b[first][depth])
                child = left & postings[(depth, *turn)]
                left ^= child
                path = (digest[0] ^ turn[0], digest[1] ^ turn[1])
                yield base + depth + 1, path, digest, sizes[first][depth], child, child & ends.get(depth + 1, 0)
                open_nodes.append((depth + 1, path, child))


def _bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
_NODE = "depth bigint, path_a bigint, path_b bigint"
_LOCAL = f"{_NODE}, parent_a bigint, parent_b bigint, part bigint, conv_id bigint, n_convs bigint, n_bytes bigint, conv_ids array<bigint>"
_SUMS = f"{_NODE}, n_leaves bigint, saved_tokens bigint"


def _local_nodes(table: pa.Table) -> pa.Table:
    table = table.sort_by("conv_id")
    ids = table.column("conv_id").to_pylist()
    shard = table.column("shard")[0].as_py()
    rows = []
    for depth, path, parent, size, members, ended in _walk(table):
        rows.append(
            (depth, *path, *(parent or (None, None)), shard, ids[(members & -members).bit_length() - 1], members.bit_count(), size,
             [ids[i] for i in _bits(ended)] if ended else None)
        )
    return _table(rows, _LOCAL)


def _local_sums(table: pa.Table) -> pa.Table:
    """What a node's members own of its subtree: leaves, and bytes that are repeated in it."""
    table = table.sort_by("conv_id")
    sizes, after = table.column("n_bytes").to_pylist(), table.column("after").to_pylist()
    since, owned, leaf = (table.column(c).to_pylist() for c in ("own_from", "own_bytes", "own_leaf"))
    base = table.column("seg")[0].as_py() * SEGMENT
    repeated = []  # of each member, by depth in the segment: the bytes from there on that it does not own
    for own, rest, start, mine in zip(sizes, after, since, owned):
        suffix = np.cumsum(np.array([rest, *own[::-1]], np.int64))[::-1]  # from each turn on
        suffix = np.concatenate([suffix[:1], suffix])  # a node's own turn counts: depth d starts at turn d - 1
        depth = base + np.arange(len(own) + 1)
        # Above its first own node a member owns all its own bytes, from there on all that is left.
        repeated.append((suffix[: len(own) + 1] - np.where(depth <= start, mine, suffix[: len(own) + 1])).tolist())
    rows = []
    for depth, path, _, _, members, _ in _walk(table):
        leaves = saved = 0
        for i in _bits(members):
            leaves += leaf[i]
            saved += repeated[i][depth - base]
        rows.append((depth, *path, leaves, saved))
    return _table(rows, _SUMS)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = pa.schema([(name, _ARROW[kind]) for name, kind in (field.split(" ") for field in schema.split(", "))])
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)


_KEY = ["depth", "path_a", "path_b"]
# Past any depth: of a conversation that owns no node.
_NEVER = (1 << 62)


def prefix_trie(turns: DataFrame, members: DataFrame | None = None) -> Trie:
    """The trie of ``turns`` as ``turn_keys`` gives them. ``members`` names all conversations by ``conv_id``, also those
    without turns; those of ``turns`` if None."""
    members = turns.select("conv_id") if members is None else members
    pieces = materialize(_segments(turns, members), "segments")
    local = materialize(pieces.groupBy("shard", "seg").applyInArrow(_local_nodes, _LOCAL), "local-nodes")
    merged = materialize(
        local.groupBy(*_KEY).agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
            F.max("parent_a").alias("parent_a"), F.max("parent_b").alias("parent_b"),
        ),
        "nodes",
    )
    children = (
        merged.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("path_a"), F.col("parent_b").alias("path_b"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    counted = materialize(merged.join(children, _KEY, "left").fillna(0, ["n_children"]), "counted")
    # A conversation's own nodes are the end of its path; only the last of them can be a leaf.
    own = counted.groupBy("conv_id").agg(
        F.min("depth").alias("own_from"), F.sum("n_bytes").alias("own_bytes"), F.count_if(F.col("n_children") == 0).alias("own_leaf")
    )
    owned = pieces.join(own, "conv_id", "left").fillna({"own_from": _NEVER, "own_bytes": 0, "own_leaf": 0})
    sums = owned.groupBy("shard", "seg").applyInArrow(_local_sums, _SUMS).groupBy(*_KEY)
    sums = sums.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    above = counted.select(
        (F.col("depth") + 1).alias("depth"), F.col("path_a").alias("parent_a"), F.col("path_b").alias("parent_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    nodes = counted.join(sums, _KEY).join(above, ["depth", "parent_a", "parent_b"], "left")
    ends = local.where("conv_ids IS NOT NULL").select(*_KEY, "part", "conv_ids")
    wanted = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "path_a", "path_b"]
    return Trie(nodes.select(*wanted), ends)


def _digest_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids; the rows of a node follow each other, and none is held longer than its batch."""
    key, state = None, None
    for batch in batches:
        done = []
        for *own, _, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "part", "conv_ids"))):
            text = ",".join(map(str, ids)).encode()
            if own == key:
                state.update(b"," + text)
                continue
            if key is not None:
                done.append((*key, state.hexdigest()))
            key, state = own, hashlib.sha256(text)
        if done:
            yield _table(done, f"{_NODE}, ends_sha256 string").to_batches()[0]
    if key is not None:
        yield _table([(*key, state.hexdigest())], f"{_NODE}, ends_sha256 string").to_batches()[0]


def end_digests(trie: Trie) -> DataFrame:
    """``depth, path_a, path_b, ends_sha256`` of the nodes where conversations end: SHA-256 of the ascending decimal ids, joined by
    commas. A node's ids pass as one stream in order, a part at a time."""
    in_order = trie.ends.repartition(*[F.col(c) for c in _KEY]).sortWithinPartitions(*_KEY, "part")
    return in_order.mapInArrow(_digest_rows, f"{_NODE}, ends_sha256 string")


def with_end_digests(trie: Trie) -> DataFrame:
    none = hashlib.sha256(b"").hexdigest()
    joined = trie.nodes.join(end_digests(trie), _KEY, "left")
    return joined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
