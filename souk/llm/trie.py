"""Prefix trie of conversations by vertical bitmaps.

Conversations are numbered by id and cut into shards of ``SHARD``, and long
ones into blocks of ``BLOCK`` turns.  Within one (block, shard) the index
holds a bitset of conversations for every (position, turn).  A depth-first
walk starts from the bitset of each distinct prefix at the block's start and
intersects the parent's bitset with the posting of a member's next turn:
that is a child, its members leave the rest, and so on until no member is
left.  Popcounts, smallest members and the lists of conversations that end
at a node come from the bitsets.

A node's name is the combination of a 128-bit hash of every (position, turn)
on its path, so shards name equal prefixes alike and are merged by one
aggregate, and a block's start needs no walk of the blocks before it.  Sums
over subtrees are taken by pointer doubling: in round k every node sends its
sum to its ancestor 2^k levels above, so the rounds grow with the logarithm
of the depth, and no task holds a path or a subtree.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from souk.llm.order import numbered, stored

#: Conversations of a shard: the bits of its bitsets.
SHARD = 4096
#: Positions of a block.
BLOCK = 64

ROOT = "0" * 32

NODE = "node string, parent string, depth long, smallest long, members long, words long, ends array<long>, shard long"
ARROW_NODE = pa.schema([
    ("node", pa.string()), ("parent", pa.string()), ("depth", pa.int64()), ("smallest", pa.int64()),
    ("members", pa.int64()), ("words", pa.int64()), ("ends", pa.list_(pa.int64())), ("shard", pa.int64()),
])


def _name(lanes: tuple[int, int]) -> str:
    return f"{lanes[0]:016x}{lanes[1]:016x}"


def bits_of(bits: int) -> list[int]:
    """Places of the set bits, ascending."""
    raw = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist()


def walk(block: int, turns: dict[str, list], visit: Callable[..., None]) -> None:
    """Nodes of one shard's positions block+1 to block+BLOCK, depth first.

    turns: equally long lists; ``conv`` (ascending numbers from 0), ``at``,
    ``one`` and ``two`` (the hash lanes of the position and turn), ``left``
    and ``right`` (the prefix at the block's start), ``length`` (turns of
    the conversation), ``words``.  visit(lanes, parent's lanes, depth,
    bitset, bitset of those that end there, words).
    """
    postings: dict[tuple[int, int, int], int] = {}
    words: dict[tuple[int, int, int], int] = {}
    turn_of: dict[tuple[int, int], tuple[int, int]] = {}
    ended: dict[int, int] = {}  # by depth
    roots: dict[tuple[int, int], int] = {}
    for conv, at, one, two, left, right, length, n in zip(*(turns[k] for k in ("conv", "at", "one", "two", "left", "right", "length", "words"))):
        bit, key = 1 << conv, (at, one, two)
        postings[key] = postings.get(key, 0) | bit
        words[key] = n
        turn_of[conv, at] = (one, two)
        if at == block + 1:
            roots[left, right] = roots.get((left, right), 0) | bit
        if at == length:
            ended[at] = ended.get(at, 0) | bit
    stack = [(lanes, block, members) for lanes, members in roots.items()]
    while stack:
        lanes, depth, rest = stack.pop()
        if depth > block:
            rest &= ~ended.get(depth, 0)
        if depth == block + BLOCK:
            continue
        parent, depth = lanes, depth + 1
        while rest:
            one, two = turn_of[(rest & -rest).bit_length() - 1, depth]
            child = rest & postings[depth, one, two]
            rest ^= child
            lanes = (parent[0] ^ one, parent[1] ^ two)
            visit(lanes, parent, depth, child, child & ended.get(depth, 0), words[depth, one, two])
            stack.append((lanes, depth, child))


def _shard(key: tuple, table: pa.Table) -> pa.Table:
    block, shard = key[0].as_py(), key[1].as_py()
    unsigned = lambda name: table.column(name).to_numpy().astype(np.int64).view(np.uint64).tolist()
    ids, conv = np.unique(table.column("conv_id").to_numpy(), return_inverse=True)
    turns = {"conv": conv.tolist(), "at": table.column("at").to_pylist(), "length": table.column("length").to_pylist(), "words": table.column("words").to_pylist()}
    turns |= {n: unsigned(n) for n in ("one", "two", "left", "right")}
    ids = ids.tolist()
    out: list[list] = [[] for _ in ARROW_NODE]

    def visit(lanes, parent, depth, members, ends, words) -> None:
        row = (_name(lanes), _name(parent), depth, ids[(members & -members).bit_length() - 1], members.bit_count(), words, [ids[k] for k in bits_of(ends)] if ends else [], shard)
        for column, value in zip(out, row):
            column.append(value)

    walk(block * BLOCK, turns, visit)
    return pa.table([pa.array(c, f.type) for c, f in zip(out, ARROW_NODE)], schema=ARROW_NODE)


def shard_nodes(turns: DataFrame, ids: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """Every shard's nodes with their popcounts and end lists (``NODE``), the root among them.

    turns: ``conv_id``, ``at`` (from 1, gapless), ``role``, ``text`` (neither
    null).  ids: the distinct ``conv_id``, those without turns too.
    """
    shards = numbered(ids.select("conv_id"), [], [F.col("conv_id")]).select("conv_id", F.floor((F.col("at") - 1) / shard_size).alias("shard"))
    lengths = turns.groupBy("conv_id").agg(F.max("at").alias("length"))
    convs = stored(shards.join(lengths, "conv_id", "left"))
    hashed = turns.select(
        "conv_id", "at", F.floor((F.col("at") - 1) / BLOCK).alias("block"),
        F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    ).withColumns({"one": F.xxhash64("at", "a", "b"), "two": F.xxhash64("b", F.lit(2), "a", "at")}).drop("a", "b")
    hashed = stored(hashed)
    # a conversation's prefix at the start of a block; one row for BLOCK turns goes through the window
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = hashed.groupBy("conv_id", "block").agg(F.bit_xor("one").alias("x"), F.bit_xor("two").alias("y")).select(
        "conv_id", "block", F.coalesce(F.bit_xor("x").over(before), F.lit(0)).alias("left"), F.coalesce(F.bit_xor("y").over(before), F.lit(0)).alias("right")
    )
    rows = hashed.join(starts, ["conv_id", "block"]).join(convs, "conv_id")
    nodes = rows.groupBy("block", "shard").applyInArrow(_shard, NODE)
    nothing = F.col("length").isNull()
    roots = convs.groupBy("shard").agg(
        F.min("conv_id").alias("smallest"), F.count("*").alias("members"), F.array_sort(F.collect_list(F.when(nothing, F.col("conv_id")))).alias("ends")
    ).select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "smallest", "members",
        F.lit(0).cast("long").alias("words"), "ends", "shard",
    )
    return nodes.unionByName(roots)


def _subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``nodes`` (node, parent, values) with each value summed over the node's subtree."""
    now = stored(nodes.select("node", F.col("parent").alias("up"), *values))
    while not now.filter("up IS NOT NULL").isEmpty():
        sent = now.filter("up IS NOT NULL").groupBy(F.col("up").alias("__to")).agg(*(F.sum(v).alias(f"__{v}") for v in values))
        above = now.select(F.col("node").alias("__from"), F.col("up").alias("__up"))
        got = now.join(sent, F.col("node") == F.col("__to"), "left").join(above, F.col("up") == F.col("__from"), "left")
        now = stored(got.select("node", F.col("__up").alias("up"), *((F.col(v) + F.coalesce(f"__{v}", F.lit(0))).alias(v) for v in values)))
    return now.drop("up")


def trie(turns: DataFrame, ids: DataFrame, shard_size: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """The nodes of all conversations' trie, and the conversations that end at them.

    nodes: ``node``, ``parent`` (null for the root), ``depth``, ``conv_id``
    (smallest member), ``n_convs``, ``words`` (of the last text), and
    ``n_children``, ``n_leaves`` and ``saved_tokens`` (of the subtree, which
    includes its top).  ends: ``node``, ``shard``, ``ends`` (ascending
    conv_ids); shards ascend with the ids, so no row holds more than
    ``shard_size`` of them.  Takes what ``shard_nodes`` takes; without any
    conversation both are empty.
    """
    parts = stored(shard_nodes(turns, ids, shard_size))
    merged = parts.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("smallest").alias("conv_id"), F.sum("members").alias("n_convs"), F.max("words").alias("words")
    )
    children = parts.filter("parent IS NOT NULL").select("node", "parent").distinct().groupBy(F.col("parent").alias("__p")).agg(F.count("*").alias("n_children"))
    nodes = stored(merged.join(children, F.col("node") == F.col("__p"), "left").drop("__p").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    own = nodes.select("node", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    ends = parts.filter(F.size("ends") > 0).select("node", "shard", "ends")
    return nodes.join(_subtree_sums(own, ["n_leaves", "saved_tokens"]), "node"), ends


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``at`` (place from 1), ``role``, ``text``: turns by number (null first), then role and text.

    A null role or text becomes empty; rows without ``conv_id`` belong to no
    conversation and take no part.  Repeated rows stay.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return numbered(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]).select("conv_id", "at", "role", "text")
