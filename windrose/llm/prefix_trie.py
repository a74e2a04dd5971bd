"""The trie of conversations' turns, by fixed-length block hashing.

1. A turn becomes a digest of its role and text, and a number of words: texts go no further. Turns are numbered within
   their conversation, by ranges, so that no conversation has to lie in one task.
2. BLOCK consecutive turns make a block. A block's digest is the exclusive or of its turns' digests, each mixed with its
   place; what comes before a block is the running exclusive or of the blocks before it. Conversations are grouped by
   (what comes before, the block itself): one aggregation over blocks, with partial results in each task, finds all
   groups of all levels at once, and of each only its number of conversations and its smallest one remain.
3. Turn boundaries are looked at only then, once for each different block. Where all conversations of a block's parent go
   on with the same block, its turns are nodes as they are. Where siblings diverge, the turns of the sibling blocks
   are grouped by (depth, prefix).
4. Sums over subtrees need no walk along the depth. Each node belongs to its smallest conversation, and those of one
   conversation are the end of its path. So a subtree's sum is the sum, over its member conversations, of all that they own, less
   what the node's own conversation owns above it: two further aggregations by block and by prefix, and a running sum.

Digests are 128 bits, as two numbers. A trie row is a node: the root has depth 0.

Defined results: null roles and texts are empty ones. Turns are in the order of turn (null first), and those with one turn
number by their digest. Rows that are equal are turns of their own. Rows with a null conversation belong to none and
are left out. Without any conversation there is no node, not even a root. Only the named columns are read, so further columns
cannot clash.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranked import numbered, running
from ..operators.shared import cut
from .common import prepare

#: turns in a block
BLOCK = 4
#: members whose numbers are written together before they are hashed
MEMBERS = 8192


def digested(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, digest, words) of each turn; pos counts from 0."""
    prepare(conversations.sparkSession)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    md5 = lambda c: F.md5(c.cast("binary"))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), md5(F.concat(md5(text(role_col)), md5(text(text_col)))).alias("digest"),
        F.regexp_count(text(text_col), F.lit("[^ \\t-\\r]+")).cast("long").alias("words"),
    )
    return numbered(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest")], "pos").drop("turn")


def with_shared_heads(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, all conversations): each conversation's first h turns are replaced by as many as the conversation c - c % group
    has of them, h being crc32(c) % most."""
    turns = cut(turns)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = cut(convs.join(base, "base", "left").select("conv_id", "h", "base", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken")))
    heads = turns.where(F.col("pos") < most - 1).withColumnRenamed("conv_id", "base")
    head = convs.where("taken > 0").select("conv_id", "base", "taken").join(heads, "base").where("pos < taken").select("conv_id", "pos", "digest", "words")
    rest = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos >= h")
    return head.unionByName(rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words")), convs.select("conv_id")


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """Nodes of the trie of all conversations; see trie()."""
    turns = cut(digested(conversations, **columns))
    return trie(turns, turns.select("conv_id").distinct())


def _xor(items: Column, field: str, start: Column) -> Column:
    return F.aggregate(items, start, lambda acc, t: acc.bitwiseXOR(t[field]))


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, k, h1, h2, turns): each conversation's blocks, with the digest of all that comes before."""
    placed = turns.select(
        "conv_id", "pos", F.xxhash64("digest", "pos").alias("x1"), F.xxhash64("pos", F.lit("second"), "digest").alias("x2"), "words",
    )
    blocks = placed.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).alias("k")).agg(
        F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.array_sort(F.collect_list(F.struct("pos", "x1", "x2", "words"))).alias("turns")
    )
    return cut(running(blocks, ["conv_id"], ["k"], {"h1": ("xor", F.col("b1")), "h2": ("xor", F.col("b2"))}))


def _turn_rows(groups: DataFrame, carried: list[str]) -> DataFrame:
    """A row for each turn of each different block: its depth and prefix (p1, p2), its parent's prefix (q1, q2)."""
    at = groups.select("h1", "h2", "turns", *carried, F.posexplode("turns").alias("j", "t"))
    before = F.slice("turns", F.lit(1), F.col("j"))
    q1, q2 = _xor(before, "x1", F.col("h1")), _xor(before, "x2", F.col("h2"))
    return at.select((F.col("t.pos") + 1).alias("depth"), q1.bitwiseXOR(F.col("t.x1")).alias("p1"), q2.bitwiseXOR(F.col("t.x2")).alias("p2"), q1.alias("q1"), q2.alias("q2"), F.col("t.words").alias("words"), *carried)


NODE = ["depth", "p1", "p2"]


def _nodes(blocks: DataFrame) -> DataFrame:
    """(depth, p1, p2, q1, q2, words, n_convs, conv_id) of each node below the root."""
    groups = cut(blocks.groupBy("k", "h1", "h2", "turns").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")))
    siblings = groups.groupBy("k", "h1", "h2").agg(F.count("*").alias("siblings"))
    groups = groups.join(siblings, ["k", "h1", "h2"])
    rows = _turn_rows(groups, ["n_convs", "conv_id", "siblings"])
    alone = rows.where("siblings = 1").drop("siblings")
    apart = rows.where("siblings > 1").groupBy(*NODE).agg(*(F.first(c).alias(c) for c in ("q1", "q2", "words")), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    return alone.unionByName(apart)


def _weighed(blocks: DataFrame, owned: DataFrame) -> DataFrame:
    """(depth, p1, p2, leaves, saved): sums over the member conversations of each node of what they own."""
    sums = lambda: (F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    groups = blocks.join(owned, "conv_id").groupBy("k", "h1", "h2", "turns").agg(*sums())
    return _turn_rows(groups, ["leaves", "saved"]).groupBy(*NODE).agg(*sums())


def _hash_members(batches):
    """Pieces of member lists in order -> the digest of each node's list."""
    now, state, rows = None, None, []
    for batch in batches:
        for depth, p1, p2, piece in zip(*(batch.column(c).to_pylist() for c in (*NODE, "piece")), strict=True):
            if now != (depth, p1, p2):
                if state:
                    rows.append((*now, state.hexdigest()))
                now, state = (depth, p1, p2), hashlib.sha256()
                state.update(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.string()], strict=True)], names=[*NODE, "ends_sha256"])
            rows = []
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*now, state.hexdigest()), [pa.int64()] * 3 + [pa.string()], strict=True)], names=[*NODE, "ends_sha256"])


def _ends(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256): the conversations that end at a node, ascending, joined by commas, hashed.

    A node's members are numbered by ranges and written MEMBERS at a time, so that a node where very many end is hashed from
    few long pieces, one after the other.
    """
    x1, x2 = F.xxhash64("digest", "pos"), F.xxhash64("pos", F.lit("second"), "digest")
    ends = turns.groupBy("conv_id").agg(F.count("*").alias("depth"), F.bit_xor(x1).alias("p1"), F.bit_xor(x2).alias("p2"))
    ends = convs.join(ends, "conv_id", "left").fillna(0, NODE)
    pieces = numbered(ends, NODE, ["conv_id"], "nth").groupBy(*NODE, F.floor(F.col("nth") / MEMBERS).alias("m")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("piece")
    )
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "m").select(*NODE, "piece").mapInArrow(_hash_members, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node.

    turns: (conv_id, pos, digest, words). convs: (conv_id) of all conversations, those without turns as well.
    """
    turns, convs = cut(turns), cut(convs)
    blocks = _blocks(turns)
    whole = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = whole.select(*(zero.alias(c) for c in NODE), *(F.lit(None).cast("long").alias(c) for c in ("q1", "q2")), zero.alias("words"), "n_convs", "conv_id")
    nodes = _nodes(blocks)
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    saved = (F.col("n_convs") - 1) * F.col("words")
    nodes = cut(nodes.unionByName(root).join(children, NODE, "left").fillna(0, ["n_children"]).withColumn("own", saved))
    # what each conversation owns: the nodes of which it is the smallest member
    owned = nodes.groupBy("conv_id").agg(F.count_if(F.col("n_children") == 0).alias("leaves"), F.sum("own").alias("saved")).where("leaves > 0 or saved > 0")
    owned = cut(owned)
    total = owned.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")).select(*(zero.alias(c) for c in NODE), "leaves", "saved")
    below = _weighed(blocks, owned).unionByName(total)
    above = running(nodes, ["conv_id"], ["depth"], {"above": ("sum", F.col("own"))})
    found = above.join(below, NODE, "left").join(_ends(turns, convs), NODE, "left")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    return found.join(parents, ["depth", "q1", "q2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("leaves", zero).alias("n_leaves"),
        (F.coalesce("saved", zero) - F.col("above")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
