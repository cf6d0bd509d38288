"""The prefix trie of conversations, with subtree totals rolled up in bands of depths.

A node is named by its smallest member and its depth: every conversation has one node at
each depth, so ``path`` (conversation, depth, node) is the whole trie. Prefixes are told
apart by two 64-bit sums (exclusive or) of hashes of place and turn.

Subtree totals: a node adds itself to its ancestors within its own band of ``height``
depths. Band roots then carry complete totals of what is below them; they are a trie of
their own, ``height`` times less deep, so the same is done with them, and complete totals
go to the nodes of the band above. No node explodes to more than ``height`` rows at a time,
and a depth of D takes log(D) / log(height) rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.shared import stage
from tallybook.workspace import stage_with_index

HEIGHT = 8
#: Turns of a conversation that are summed in one window.
BLOCK = 1024
#: Turns at the start of a rebuilt conversation that can come from another are fewer than this.
BORROWED = 9
FAMILY = 5
#: Characters of role and text that order equal turns, before a digest does.
TIE_CHARS = 256

MEMBERS_SCHEMA = "conv_id long, depth long, ends_sha256 string"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _ordered_turns(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, row_index (its place in the whole table), digest and n_bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.left(role, F.lit(TIE_CHARS)).alias("role"),
        F.left(text, F.lit(TIE_CHARS)).alias("beginning"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("beginning"), F.asc("digest")]
    return stage_with_index(rows, order, "turns").select("conv_id", "row_index", "digest", "n_bytes")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c anew: the first h turns of conversation c - c % 5 (all if it has
    fewer, none if it is absent), then c's own turns after its first h; h = crc32(c) % 9.

    Gives staged (conv_id, length) and (conv_id, depth, digest, n_bytes, length), depths from 1.
    Turns are in order of ``turn``, null first; equal ones by role and text (256 characters
    of each, then a digest). Null roles and texts are empty. Rows without a conv_id belong to
    no conversation. ``%`` takes the sign of c, as in SQL. Other columns are not looked at.
    """
    turns = _ordered_turns(conversations)
    starts = turns.groupBy("conv_id").agg(F.min("row_index").alias("first"), F.count(F.lit(1)).alias("n"))
    own = F.col("conv_id")
    starts = stage(
        starts.withColumns(
            {
                "h": F.crc32(own.cast("string").cast("binary")) % BORROWED,
                "base": own - own % FAMILY,
            }
        ),
        "starts",
    )
    sizes = starts.select(own.alias("base"), F.col("n").alias("n_base"))
    known = stage(
        starts.join(sizes, "base", "left")
        .withColumn("borrowed", F.least("h", F.coalesce("n_base", F.lit(0))))
        .withColumn("length", F.col("borrowed") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select("conv_id", "first", "h", "base", "borrowed", "length"),
        "conversations",
    )
    placed = turns.join(known.drop("base"), "conv_id").withColumn("place", F.col("row_index") - F.col("first") + 1)
    placed = stage(placed.select("conv_id", "place", "digest", "n_bytes", "h", "borrowed", "length"), "placed")
    later = placed.filter(F.col("place") > F.col("h")).withColumn("depth", F.col("place") - F.col("h") + F.col("borrowed"))
    # At most 9 conversations share a base, and at most 8 of its turns are taken.
    heads = placed.filter(F.col("place") < BORROWED).select(
        F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "n_bytes"
    )
    taken = known.filter("borrowed > 0").join(heads, "base").filter(F.col("depth") <= F.col("borrowed"))
    columns = ["conv_id", "depth", "digest", "n_bytes", "length"]
    return known.select("conv_id", "length"), later.select(columns).unionByName(taken.select(columns))


def _through(column: str, window) -> Column:
    return F.bit_xor(column).over(window).alias(column)


def running_sums(rows: DataFrame, deepest: int, block: int = BLOCK) -> DataFrame:
    """``rows`` with ``a`` and ``b`` summed (exclusive or) over each conversation's depths 1 to this one.

    Windows hold one block of depths; blocks' totals are summed the same way, so that a
    conversation of any length is spread over many windows.
    """
    number = F.floor((F.col("depth") - 1) / F.lit(block)).cast("long")
    rows = rows.withColumn("_block", number)
    window = Window.partitionBy("conv_id", "_block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    others = [c for c in rows.columns if c not in ("a", "b")]
    within = rows.select(*others, _through("a", window), _through("b", window))
    if deepest <= block:
        return within.drop("_block")
    within = stage(within, "blocks")
    totals = within.groupBy("conv_id", "_block").agg(F.max_by("a", "depth").alias("a"), F.max_by("b", "depth").alias("b"))
    totals = totals.select("conv_id", (F.col("_block") + 1).alias("depth"), "a", "b")
    before = running_sums(totals, -(-deepest // block), block).select(
        "conv_id", F.col("depth").alias("_block"), F.col("a").alias("_a"), F.col("b").alias("_b")
    )
    zero = F.lit(0).cast("long")
    joined = within.join(before, ["conv_id", "_block"], "left")
    sums = {c: F.col(c).bitwiseXOR(F.coalesce(F.col("_" + c), zero)) for c in ("a", "b")}
    return joined.withColumns(sums).drop("_block", "_a", "_b")


def _lines(path: DataFrame, stride: int, height: int) -> DataFrame:
    """Per conversation and band: its nodes at multiples of ``stride``, at most ``height`` of them."""
    steps = path.filter(F.col("depth") % stride == 0)
    band = F.floor(F.col("depth") / F.lit(stride * height)).cast("long")
    line = F.collect_list(F.struct("depth", F.col("node")))
    return steps.groupBy("conv_id", band.alias("band")).agg(line.alias("line"))


def _added(contributions: DataFrame, sums: list[str]) -> DataFrame:
    at = [F.col("at.node").alias("conv_id"), F.col("at.depth").alias("depth")]
    return contributions.select(*at, *sums).groupBy("conv_id", "depth").agg(*[F.sum(c).alias(c) for c in sums])


def subtree_sums(values: DataFrame, path: DataFrame, sums: list[str], deepest: int, height: int = HEIGHT, stride: int = 1) -> DataFrame:
    """Staged totals over the subtree of each node (conv_id, depth) of ``values``.

    ``values`` has one row per node at a multiple of ``stride``; ``path`` is staged.
    """
    band = F.floor(F.col("depth") / F.lit(stride * height)).cast("long")
    lines = stage(_lines(path, stride, height), "lines")
    placed = values.withColumn("band", band).join(lines, ["conv_id", "band"])
    own_depth = F.col("depth")
    above = F.filter("line", lambda x: x["depth"] <= own_depth)
    inner = stage(_added(placed.select(*sums, F.explode(above).alias("at")), sums), "inner")
    if deepest < stride * height:
        return inner
    roots = inner.filter(F.col("depth") % (stride * height) == 0)
    complete = subtree_sums(roots, path, sums, deepest, height, stride * height)
    risen = complete.filter("depth > 0").withColumn("band", band - 1).join(lines, ["conv_id", "band"])
    lifted = _added(risen.select(*sums, F.explode("line").alias("at")), sums)
    both = inner.unionByName(lifted)
    return stage(both.groupBy("conv_id", "depth").agg(*[F.sum(c).alias(c) for c in sums]), "totals")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members in order, as comma-joined text, one piece per node and batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node, depth, member = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "depth", "member"))
        new = np.ones(len(node), bool)
        new[1:] = (node[1:] != node[:-1]) | (depth[1:] != depth[:-1])
        begin = np.flatnonzero(new)
        text = list(map(str, member.tolist()))
        pieces = [",".join(text[i:j]) for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(text)], strict=True)]
        yield pa.RecordBatch.from_pydict(
            {"node": node[begin], "depth": depth[begin], "first": member[begin], "piece": pa.array(pieces, pa.string())}
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of pieces in order; a node's pieces may lie in several batches."""
    names = ["conv_id", "depth", "ends_sha256"]
    current, state = None, None
    for batch in batches:
        done: list[list] = [[], [], []]
        for node, depth, piece in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "piece")), strict=True):
            if (node, depth) == current:
                state.update(b",")
            else:
                if current:
                    for column, value in zip(done, (*current, state.hexdigest()), strict=True):
                        column.append(value)
                current, state = (node, depth), hashlib.sha256()
            state.update(piece.encode())
        types = (pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(done, types, strict=True)], names=names)
    if current:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*current, state.hexdigest()), strict=True))])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, depth, member) -> SHA-256 of each node's members, ascending and comma-joined.

    Members are sorted and put into words over ranges, so those of a hot node are spread over
    tasks. Their text then streams through one digest in order, as SHA-256 demands; a task
    holds one batch of pieces, never a node's members.
    """
    # The number of partitions is given, so that runs of equal keys are not merged into one task.
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["node", "depth", "member"]
    pieces = ends.select(*keys).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    pieces = stage(pieces.mapInArrow(_pieces, "node long, depth long, first long, piece string"), "pieces")
    ordered = pieces.repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return ordered.select("node", "depth", "piece").mapInArrow(_digests, MEMBERS_SCHEMA)


def trie(members: DataFrame, turns: DataFrame, height: int = HEIGHT, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth, digest, n_bytes, length) of ``members``
    (conv_id, length; staged).

    Per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. The root has depth 0 and no parent; without
    members there are no nodes.
    """
    whole = members.agg(F.min("conv_id"), F.max("length"), F.count(F.lit(1))).first()  # three numbers
    smallest, deepest, count = whole[0], whole[1] or 0, whole[2]
    marked = turns.select(
        "conv_id",
        "depth",
        "n_bytes",
        "length",
        F.xxhash64(F.lit(1), "depth", "digest").alias("a"),
        F.xxhash64(F.lit(2), "depth", "digest").alias("b"),
    )
    rows = stage(running_sums(marked, deepest, block), "prefixes")
    prefix = ["depth", "a", "b"]
    named = stage(
        rows.groupBy(*prefix).agg(
            F.min("conv_id").alias("node"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("length").alias("reach"),
        ),
        "nodes",
    )
    # Both sides are written tables, so a hot prefix is split or its nodes are broadcast by known size.
    found = rows.join(named, prefix).select("conv_id", "depth", "node", "length", "n_convs", "n_bytes", "reach")
    long = lambda x: F.lit(x).cast("long")
    roots = members.select(
        "conv_id",
        long(0).alias("depth"),
        long(smallest).alias("node"),
        "length",
        long(count).alias("n_convs"),
        long(0).alias("n_bytes"),
        long(deepest).alias("reach"),
    )
    path = stage(found.unionByName(roots), "path")
    parents = path.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent_conv_id"))
    nodes = path.filter("node = conv_id").select(
        "conv_id",
        "depth",
        "n_convs",
        (F.col("reach") == F.col("depth")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    nodes = stage(nodes.join(parents, ["conv_id", "depth"], "left"), "nodes")
    sums = ["n_leaves", "saved_tokens"]
    totals = subtree_sums(nodes.select("conv_id", "depth", *sums), path, sums, deepest, height)
    children = (
        nodes.filter("depth > 0")
        .groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    ends = end_digests(path.filter("depth = length").select("node", "depth", F.col("conv_id").alias("member")))
    key = ["conv_id", "depth"]
    return (
        nodes.drop(*sums)
        .join(totals, key)
        .join(children, key, "left")
        .join(ends, key, "left")
        .select(
            *key,
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", long(0)).alias("n_children"),
            *sums,
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


def rebuilt_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The trie of ``conversations`` as ``rebuilt`` gives them."""
    return trie(*rebuilt(conversations), height)
