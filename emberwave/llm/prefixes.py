"""Prefix trie of conversations, and what sharing its prefixes saves.

A node is a distinct sequence of first turns. Its digest comes from sums over the turns (place and turn hashed
together, four sums of 32 bits), so that a node's parent is the same sums without its last turn, and prefixes of one
conversation are running sums: a long conversation is summed in blocks, and no task holds one whole.

What a subtree holds is added up by pointer jumping. Every node points to its parent by digest and has its own leaves
and savings. In a round each node's sums are added to those of the node it points to, and its pointer becomes that
node's pointer, so that pointers double their reach: a trie of depth d takes log2(d) rounds. Nodes that have no ancestor
that far leave the rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberwave.llm.common import Scratch

#: Conversations of which the first one gives the others their first turns, and one more than the most turns given.
GROUP, HEADS = 100, 6
#: Turns of a conversation that are summed in one window.
BLOCK = 4096
#: A key with more than this share of the rows of a join is hot; there are fewer such keys than its inverse.
HOT_SHARE = 1e-3

_SUMS = ("s1", "s2", "s3", "s4")
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _node(depth: Column, sums: list[Column]) -> Column:
    return F.md5(F.concat_ws(":", depth.cast("long"), *sums))


def root_digest() -> Column:
    return _node(F.lit(0), [F.lit(0).cast("long")] * len(_SUMS))


def _turn_digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat_ws(":", F.length(role), role, text))


def positions(scratch: Scratch, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in order, and how many each conversation has by partition.

    Turns (conv_id, part, at, digest, chars) are sorted by range, so a conversation of any length is dealt to many
    tasks; a turn's number is its place in its part and the turns of the parts before (conv_id, part, skip).
    """
    conv_id = conversations["conv_id"].cast("long")
    text = lambda name: F.coalesce(conversations[name].cast("string"), F.lit("")).alias(name)
    turns = conversations.where(conv_id.isNotNull()).select(conv_id.alias("conv_id"), conversations["turn"].alias("turn"), text("role"), text("text"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    place = F.monotonically_increasing_id()
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = scratch.saved(ordered.select("conv_id", F.shiftright(place, 33).alias("part"), place.alias("at"), _turn_digest(F.col("role"), F.col("text")).alias("digest"), F.length("text").cast("long").alias("chars")), "turns")
    spans = ordered.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return ordered, spans.select("conv_id", "part", "n", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("skip"))


def rebuilt(scratch: Scratch, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: turns (conv_id, depth, digest, chars, last), and (conv_id, turns) of each.

    The first turns of conversation c - c % 100, as many as crc32 of the decimal c says, and c's own after as many.
    """
    ordered, spans = positions(scratch, conversations)
    spans = scratch.saved(spans, "spans")
    own = spans.groupBy("conv_id").agg(F.sum("n").alias("own"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("long")
    given = F.least("heads", F.coalesce("base_turns", F.lit(0)))
    held = own.select("conv_id", "own", base.alias("base"), heads.alias("heads")).join(own.where(base == F.col("conv_id")).select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns")), "base", "left")
    held = scratch.saved(held.select("conv_id", "base", "heads", given.alias("given"), (given + F.greatest(F.col("own") - F.col("heads"), F.lit(0))).alias("turns")), "conversations")
    known = spans.join(held, "conv_id").select("conv_id", "part", "skip", "heads", "given", "turns")
    numbered = ordered.join(known, ["conv_id", "part"]).withColumn("number", F.col("at") + F.col("skip"))
    rest = numbered.where("number > heads").select("conv_id", (F.col("given") + F.col("number") - F.col("heads")).alias("depth"), "digest", "chars", "turns")
    first = numbered.where((base == F.col("conv_id")) & (F.col("number") < HEADS)).select(F.col("conv_id").alias("base"), F.col("number").alias("depth"), "digest", "chars")
    given_turns = held.where("given > 0").join(first, "base").where("depth <= given").select("conv_id", "depth", "digest", "chars", "turns")
    turns = rest.unionByName(given_turns).select("conv_id", "depth", "digest", "chars", (F.col("depth") == F.col("turns")).alias("last"))
    return turns, held.select("conv_id", "turns")


def paths(scratch: Scratch, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, chars, last, node, parent): every prefix of every conversation by its digest and its parent's."""
    hashes = [F.xxhash64(F.lit(seed), "depth", "digest") for seed in (1, 2)]
    parts = [x for h in hashes for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(0xFFFFFFFF))]
    hashed = turns.withColumns({f"x{k}": p for k, p in enumerate(parts, 1)}).withColumn("block", F.expr(f"(depth - 1) div {block}"))
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = scratch.saved(hashed.withColumns({s: F.sum(f"x{k}").over(within) for k, s in enumerate(_SUMS, 1)}), "sums")
    # Later blocks of long conversations begin with the sums of those before.
    ended = summed.groupBy("conv_id", "block").agg(*(F.max(s).alias(s) for s in _SUMS))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    many = summed.where("block > 0").select("conv_id").distinct()
    carried = ended.join(many, "conv_id", "left_semi").select("conv_id", "block", *(F.sum(s).over(earlier).alias(f"c_{s}") for s in _SUMS)).where("block > 0")
    later = summed.where("block > 0").join(carried, ["conv_id", "block"]).withColumns({s: F.col(s) + F.col(f"c_{s}") for s in _SUMS})
    whole = summed.where("block = 0").unionByName(later.select(*summed.columns))
    node = _node(F.col("depth"), [F.col(s) for s in _SUMS])
    parent = _node(F.col("depth") - 1, [F.col(s) - F.col(f"x{k}") for k, s in enumerate(_SUMS, 1)])
    return whole.select("conv_id", "depth", "chars", "last", node.alias("node"), parent.alias("parent"))


def looked_up(left: DataFrame, key: str, counts: DataFrame, rows: int, right: DataFrame) -> DataFrame:
    """``left`` joined with the one row of ``right`` that has its ``key``.

    ``counts`` (key, n_in) says how often each key occurs on the left, in ``rows`` rows together. Keys with more than
    HOT_SHARE of them, of which there are fewer than a thousand, meet a broadcast of their rows, so that their rows on
    the left stay where they are; all others are joined by a shuffle.
    """
    hot = counts.where(F.col("n_in") > HOT_SHARE * rows).select(key)
    hot_right, cold_right = right.join(F.broadcast(hot), key, "left_semi"), right.join(F.broadcast(hot), key, "left_anti")
    return left.join(F.broadcast(hot_right), key).unionByName(left.join(F.broadcast(hot), key, "left_anti").join(cold_right, key))


def subtree_sums(scratch: Scratch, nodes: DataFrame, depth: int) -> list[DataFrame]:
    """Tables (node, leaves, saved) that add up, by node, to the sums over all that is below it, by pointer jumping.

    ``nodes``: (node, parent, depth, leaves, saved), the root with a null parent. A round's table has what nodes at
    least that far below send to the node they point to.
    """
    active = nodes.where("depth > 0").select("node", "depth", F.col("parent").alias("jump"), "leaves", "saved")
    sent, reach = [], 1
    while reach <= depth:
        gained = scratch.saved(active.groupBy("jump").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.count("*").alias("n_in")), f"sent-{reach}")
        sent.append(gained.select(F.col("jump").alias("node"), "leaves", "saved"))
        reach *= 2
        if reach > depth:
            break
        more = gained.select(F.col("jump").alias("node"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
        added = active.where(F.col("depth") >= reach).join(more, "node", "left").select("node", "depth", "jump", *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")))
        added = scratch.saved(added, f"added-{reach}")
        # Who stands exactly that deep points to the root; the others take the pointer of the node they point to.
        further = added.where(F.col("depth") > reach)
        counts = further.groupBy("jump").agg(F.count("*").alias("n_in"))
        pointers = active.where(F.col("depth") > reach // 2).select(F.col("node").alias("jump"), F.col("jump").alias("next"))
        jumped = looked_up(further, "jump", counts, further.count(), pointers).select("node", "depth", F.col("next").alias("jump"), "leaves", "saved")
        at_root = added.where(F.col("depth") == reach).withColumn("jump", root_digest())
        active = scratch.saved(jumped.unionByName(at_root), f"active-{reach}")
    return sent


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal nodes in sorted batches (node, conv_id) as one row each: node, first id, ids joined by commas."""
    for batch in batches:
        nodes, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
        cuts = [k for k in range(len(nodes)) if k == 0 or nodes[k] != nodes[k - 1]] + [len(nodes)]
        runs = list(zip(cuts, cuts[1:], strict=False))
        yield pa.RecordBatch.from_pydict(
            {
                "node": pa.array([nodes[a] for a, _ in runs], pa.string()),
                "first": pa.array([ids[a] for a, _ in runs], pa.int64()),
                "ids": pa.array([",".join(map(str, ids[a:b])) for a, b in runs], pa.string()),
            }
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's runs in order; a node's text is fed to it piece by piece and never held whole."""
    node, state = None, None

    def told(rows: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": pa.array([x for x, _ in rows], pa.string()), "ends": pa.array([x for _, x in rows], pa.string())})

    for batch in batches:
        done = []
        for own, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if own != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield told(done)
    if state is not None:
        yield told([(node, state.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends): SHA-256 of the ids, in order and joined by commas, of the conversations that end at a node.

    Ids are sorted over all tasks by range and joined where they lie, so what meets at a node with very many ends is a
    row for some thousand of them.
    """
    ordered = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = ordered.mapInArrow(_chunks, "node string, first long, ids string")
    return joined.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node string, ends string")


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty ones; a null turn comes first, and turns of the same number are ordered by role and
    text. A repeated row is a turn of its own. A row without conv_id belongs to no conversation. An empty table has no
    conversation and gives no node. Columns beyond those of conversations are not read.
    """
    scratch = Scratch(conversations.sparkSession, "prefix-trie")
    turns, convs = rebuilt(scratch, conversations)
    steps = scratch.saved(paths(scratch, turns, block), "paths")
    below = steps.groupBy("node").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    top = top.select(root_digest().alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"))
    found = scratch.saved(below.unionByName(top), "found")
    children = found.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_in"))
    nodes = found.join(children, "node", "left").select(
        "node", "parent", "depth", "conv_id", "n_convs", F.coalesce("n_in", F.lit(0)).alias("n_children"), F.col("n_in").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    )
    nodes = scratch.saved(nodes, "nodes")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    ends = end_digests(steps.where("last").select("node", "conv_id").unionByName(convs.where("turns = 0").select(root_digest().alias("node"), "conv_id")))
    # All that is known of a node meets in one aggregate.
    said = ("parent", "depth", "conv_id", "n_convs", "n_children")
    rows = [nodes.select("node", *said, "leaves", "saved"), *subtree_sums(scratch, nodes, deepest), ends]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    whole = whole.groupBy("node").agg(*(F.max(c).alias(c) for c in (*said, "ends")), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    whole = scratch.saved(whole, "whole")
    above = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    held = whole.where("parent IS NOT NULL")
    counts = whole.where("n_children > 0").select(F.col("node").alias("parent"), F.col("n_children").alias("n_in"))
    tops = whole.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    named = looked_up(held, "parent", counts, held.count(), above).unionByName(tops)
    out = named.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )
    return scratch.result(out, "prefixes")
