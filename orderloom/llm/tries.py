"""Prefix trie of conversations: subtree counts from an Euler tour.

A node is a distinct sequence of first turns, known by 128 bits of sums of hashes of its
turns and their places; sums run along a conversation however many tasks hold it. Each
node has an enter and an exit arc. An enter arc leads to the first child's enter arc, or
to its own exit arc; an exit arc to the next sibling's enter arc, or to the parent's exit
arc; siblings are in the order of their smallest members. That list is ranked by
contraction: in every round the arcs whose hash exceeds both neighbours' leave the list,
a third of it, and their neighbours are linked over them. When few are left one task
counts them, and the rounds are undone with the ranks of those that stayed. So all rounds
together handle three times the list. Ranks are the arcs' positions on the tour; sums over
positions give what a subtree holds as the difference between its exit and its enter arc.

No step brings a node's members, a node's children or a conversation's turns into one
task as a group; frames are cut into ranges of their order instead, and what crosses a
border between ranges is one row per range. Only a node's list of ended conversations is
hashed in one stream, as its digest is of one text; it arrives as packed pieces.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import materialize, need

# Fixed values of the rebuilding rule: conversations of a hundred share the start of the first.
GROUP, STARTS = 100, 6
# Arcs that one task may rank at the end, and ids in one piece of a list to be hashed.
LAST_ARCS = 1 << 14
IDS_PER_PIECE = 4096
LEAST_BLOCK = 1 << 16
PARTS = ("s1", "s2", "s3", "s4")
NOTHING_SHA256 = hashlib.sha256(b"").hexdigest()


# --- ranges ----------------------------------------------------------------------


def in_ranges(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """The frame stored in ranges of the order, with `_range` and a `_row` number that follows it."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(
        ranged.withColumns({"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), label
    )


def _border_rows(ranged: DataFrame, columns: list[str]) -> DataFrame:
    """Per range the last row before it (`before`) and the first row after it (`after`), null at the ends."""
    ends = ranged.groupBy("_range").agg(
        F.min(F.struct("_row", *columns)).alias("first"), F.max(F.struct("_row", *columns)).alias("last")
    )
    along = Window.orderBy("_range")  # one row per range
    return ends.select("_range", F.lag("last").over(along).alias("before"), F.lead("first").over(along).alias("after"))


# --- turns -----------------------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, block, h1, h2, chars), stored; places count from 1 in the order of turns.

    `block` is -1 in the first range that holds rows of the conversation, else the range.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    read = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), role, text).alias("h2"),
        F.length(text).cast("long").alias("chars"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h1"), F.col("h2")]
    ranged = in_ranges(read, order, "turns")
    # A conversation that goes on from an earlier range crosses a border, so these are few.
    held = ranged.groupBy("conv_id", "_range").agg(F.count(F.lit(1)).alias("n"))
    several = held.groupBy("conv_id").agg(F.count(F.lit(1)).alias("ranges")).filter("ranges > 1")
    earlier = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    crossing = held.join(several, "conv_id", "left_semi").withColumn("earlier", F.sum("n").over(earlier))
    crossing = materialize(crossing.filter("earlier is not null").select("conv_id", "_range", "earlier"), "crossing")
    inside = Window.partitionBy("conv_id", "_range").orderBy("_row")
    numbered = ranged.withColumn("own", F.row_number().over(inside)).join(crossing, ["conv_id", "_range"], "left")
    return materialize(
        numbered.select(
            "conv_id", (F.col("own") + F.coalesce("earlier", F.lit(0))).cast("long").alias("place"),
            F.when(F.col("earlier").isNull(), -1).otherwise(F.col("_range")).alias("block"), "h1", "h2", "chars",
        ),
        "numbered-turns",
    )


def _base(conv_id: Column) -> Column:
    return conv_id - conv_id % GROUP


def _starts(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % STARTS).cast("int")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, block, h1, h2, chars) after each conversation took the start of its hundred's first."""
    heads = turns.filter((F.col("place") < STARTS) & (F.col("conv_id") % GROUP == 0))
    heads = materialize(heads.select(F.col("conv_id").alias("base"), "place", "h1", "h2", "chars"), "heads")
    own = turns.select("*", _base(F.col("conv_id")).alias("base"), _starts(F.col("conv_id")).alias("starts"))
    askers = own.filter("place = 1 and starts > 0").select("conv_id", "base", "starts")
    taken = askers.join(heads, "base").filter("place <= starts").select(
        "conv_id", F.col("place").alias("depth"), F.lit(-1).alias("block"), "h1", "h2", "chars"
    )
    lengths = heads.groupBy("base").agg(F.count(F.lit(1)).alias("there"))
    rest = own.filter("place > starts").join(lengths, "base", "left")
    ahead = F.least(F.col("starts").cast("long"), F.coalesce("there", F.lit(0).cast("long")))
    kept = rest.select("conv_id", (ahead + F.col("place") - F.col("starts")).alias("depth"), "block", "h1", "h2", "chars")
    return taken.unionByName(kept)


def _name(depth: Column, sums: list[Column]) -> list[Column]:
    """Two 64-bit names of a prefix from its depth and the sums of its turns' hashes."""
    return [F.xxhash64(F.lit(seed), depth.cast("long"), *[s.cast("long") for s in sums]) for seed in (1, 2)]


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, depth, chars, p1, p2, q1, q2): each turn's prefix and the one before it.

    Hashes are summed in four parts of 32 bits, which are exact for 2^31 turns.
    """
    mixed = rebuilt.withColumns({
        "x": F.xxhash64(F.lit(3), "h1", "h2", "depth"), "y": F.xxhash64(F.lit(4), "h1", "h2", "depth"),
    })
    low = F.lit((1 << 32) - 1)
    parts = [F.col("x").bitwiseAND(low), F.shiftrightunsigned("x", 32), F.col("y").bitwiseAND(low), F.shiftrightunsigned("y", 32)]
    cut = materialize(
        mixed.select("conv_id", "depth", "block", "chars", *[p.alias(f"own_{s}") for p, s in zip(parts, PARTS)]), "rebuilt"
    )
    # Sums of earlier blocks, for the few conversations that have several.
    long = cut.filter("block >= 0").select("conv_id").distinct()
    blocks = cut.join(long, "conv_id", "left_semi").groupBy("conv_id", "block").agg(
        *[F.sum(f"own_{s}").alias(s) for s in PARTS]
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("conv_id", "block", *[F.sum(s).over(earlier).alias(f"off_{s}") for s in PARTS])
    offsets = materialize(offsets.filter("off_s1 is not null"), "offsets")
    along = Window.partitionBy("conv_id", "block").orderBy("depth")
    summed = cut.select("*", *[F.sum(f"own_{s}").over(along).alias(s) for s in PARTS])
    whole = summed.join(offsets, ["conv_id", "block"], "left")
    sums = [F.col(s) + F.coalesce(f"off_{s}", F.lit(0)) for s in PARTS]
    before = [total - F.col(f"own_{s}") for total, s in zip(sums, PARTS)]
    p, q = _name(F.col("depth"), sums), _name(F.col("depth") - 1, before)
    return whole.select(
        "conv_id", "depth", "chars", p[0].alias("p1"), p[1].alias("p2"), q[0].alias("q1"), q[1].alias("q2")
    )


# --- digests of ended conversations ----------------------------------------------


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (p1, p2, conv_id, _range, _row) as pieces of comma-joined ids."""
    for batch in batches:
        p1, p2, ids, ranges, rows = (batch.column(i).to_numpy() for i in range(5))
        new = np.ones(len(ids), bool)
        new[1:] = (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])
        new[::IDS_PER_PIECE] = True
        at = np.flatnonzero(new)
        pieces = [",".join(map(str, ids[a:b].tolist())).encode() for a, b in zip(at, [*at[1:], len(ids)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[at]) for c in (p1, p2, rows)] + [pa.array(pieces, pa.binary())], names=["p1", "p2", "row", "ids"]
        )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which arrive in order."""
    node, digest = None, None

    def finished(found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=["p1", "p2", "ends"])

    for batch in batches:
        found = []
        for p1, p2, ids in zip(*(batch[c].to_pylist() for c in ("p1", "p2", "ids"))):
            if (p1, p2) == node:
                digest.update(b"," + ids)
                continue
            if node:
                found.append((*node, digest.hexdigest()))
            node, digest = (p1, p2), hashlib.sha256(ids)
        if found:
            yield finished(found)
    if node:
        yield finished([(*node, digest.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(p1, p2, ends): SHA-256 of the sorted ids of the conversations that end at a node."""
    counted = materialize(
        ends.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")), "end-counts"
    )
    single = counted.filter("n = 1").select("p1", "p2", F.sha2(F.col("least").cast("string").cast("binary"), 256).alias("ends"))
    several = ends.join(counted.filter("n > 1").select("p1", "p2"), ["p1", "p2"], "left_semi")
    order = [F.col(c) for c in ("p1", "p2", "conv_id")]
    ranged = several.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select("p1", "p2", "conv_id", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_row"))
    pieces = materialize(ranged.mapInArrow(_packed, "p1 long, p2 long, row long, ids binary"), "end-pieces")
    gathered = pieces.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "row")
    return single.unionByName(gathered.mapInArrow(_streamed, "p1 long, p2 long, ends string"))


# --- the tour --------------------------------------------------------------------


def _ranked_in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, places, onward, head = [], [], {}, None
    for batch in batches:
        for arc, prev, next_, far in zip(*(batch[c].to_pylist() for c in ("id", "prev", "next", "far"))):
            onward[arc] = (next_, far)
            head = arc if prev is None else head
    at, place = head, 0
    while at is not None:
        next_, far = onward[at]
        place += far
        ids.append(at)
        places.append(place)
        at = next_
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(places, pa.int64())], names=["id", "place"])


def list_ranks(links: DataFrame, last: int = LAST_ARCS) -> DataFrame:
    """(id, place) of the elements of one linked list (id, prev, next); the head has place 0."""
    current = materialize(links.withColumn("far", F.when(F.col("prev").isNull(), 0).otherwise(1).cast("long")), "list")
    rounds: list[DataFrame] = []
    while current.count() > last:
        def drawn(c: str) -> Column:
            return F.xxhash64(F.lit(len(rounds)), c)

        ends = F.col("prev").isNull() | F.col("next").isNull()
        leaves = ~ends & (drawn("id") > drawn("prev")) & (drawn("id") > drawn("next"))
        marked = current.withColumn("leaves", leaves)
        left = marked.filter("leaves").drop("leaves")
        rounds.append(left)
        none = F.lit(None).cast("long")
        stay = marked.filter("not leaves").select("id", "prev", "next", "far", none.alias("to_prev"), none.alias("to_next"))
        # An arc that leaves tells both neighbours, and the later one how far it had come.
        back = left.select(F.col("prev").alias("id"), none.alias("prev"), none.alias("next"), F.lit(0).cast("long").alias("far"),
                           none.alias("to_prev"), F.col("next").alias("to_next"))
        on = left.select(F.col("next").alias("id"), none.alias("prev"), none.alias("next"), "far",
                         F.col("prev").alias("to_prev"), none.alias("to_next"))
        told = stay.unionByName(back).unionByName(on).groupBy("id").agg(
            F.coalesce(F.max("to_prev"), F.max("prev")).alias("prev"),
            F.coalesce(F.max("to_next"), F.max("next")).alias("next"), F.sum("far").alias("far"),
        )
        current = materialize(told, "list")
    ranked = current.repartition(1).mapInArrow(_ranked_in_one_task, "id long, place long")
    ranks = materialize(ranked, "ranks")
    for left in reversed(rounds):
        known = ranks.select(F.col("id").alias("prev"), F.col("place").alias("from"))
        found = left.join(known, "prev").select("id", (F.col("from") + F.col("far")).alias("place"))
        ranks = ranks.unionByName(materialize(found, "ranks"))
    return ranks


def tour(nodes: DataFrame) -> DataFrame:
    """The arcs (id, prev, next) of the Euler tour of a tree of rows (node, parent, conv_id).

    The enter arc of a node is twice its number, the exit arc one more.
    """
    ranged = in_ranges(nodes.filter("parent is not null").select("node", "parent", "conv_id"),
                       [F.col("parent"), F.col("conv_id")], "siblings")
    borders = materialize(_border_rows(ranged, ["parent", "node"]), "borders")
    along = Window.partitionBy("_range").orderBy("_row")
    beside = ranged.select(
        "*", *[f("node").over(along).alias(f"{n}_node") for f, n in ((F.lag, "before"), (F.lead, "after"))],
        *[f("parent").over(along).alias(f"{n}_parent") for f, n in ((F.lag, "before"), (F.lead, "after"))],
    ).join(borders, "_range")

    def sibling(side: str) -> Column:
        inside, outside = F.col(f"{side}_node"), F.col(f"{side}.node")
        return F.when(inside.isNotNull(), F.when(F.col(f"{side}_parent") == F.col("parent"), inside)).when(
            F.col(f"{side}.parent") == F.col("parent"), outside
        )

    siblings = beside.select("node", sibling("before").alias("elder"), sibling("after").alias("younger"))
    families = ranged.groupBy(F.col("parent").alias("node")).agg(
        F.min(F.struct("conv_id", "node")).alias("eldest"), F.max(F.struct("conv_id", "node")).alias("youngest")
    )
    known = nodes.select("node", "parent").join(materialize(siblings, "beside"), "node", "left")
    known = known.join(materialize(families, "families"), "node", "left")
    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    arcs = F.array(
        F.struct(
            enter.alias("id"), F.coalesce(F.col("elder") * 2 + 1, F.col("parent") * 2).alias("prev"),
            F.coalesce(F.col("eldest.node") * 2, leave).alias("next"),
        ),
        F.struct(
            leave.alias("id"), F.coalesce(F.col("youngest.node") * 2 + 1, enter).alias("prev"),
            F.coalesce(F.col("younger") * 2, F.col("parent") * 2 + 1).alias("next"),
        ),
    )
    return known.select(F.inline(arcs))


def subtree_sums(ranks: DataFrame, nodes: DataFrame, values: list[str]) -> DataFrame:
    """(node, values) summed over each node's subtree, from sums along the tour up to its arcs."""
    arcs = ranks.select(F.shiftright("id", 1).alias("node"), (F.col("id") % 2 == 1).alias("leave"), "place")
    valued = arcs.join(nodes.select("node", *values), "node").select(
        "node", "leave", "place", *[F.when(F.col("leave"), 0).otherwise(F.col(v)).alias(v) for v in values]
    )
    # Blocks of positions, as long as there are blocks, so that neither grows beyond a task.
    block = max(LEAST_BLOCK, math.isqrt(2 * nodes.count()))
    placed = materialize(valued.withColumn("block", F.floor(F.col("place") / block)), "tour")
    sizes = placed.groupBy("block").agg(*[F.sum(v).alias(f"all_{v}") for v in values])
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("block", *[F.coalesce(F.sum(f"all_{v}").over(earlier), F.lit(0)).alias(f"off_{v}") for v in values])
    along = Window.partitionBy("block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.select("node", "leave", "block", *values, *[F.sum(v).over(along).alias(f"to_{v}") for v in values])
    summed = summed.join(materialize(offsets, "tour-offsets"), "block")
    upto = {v: F.col(f"off_{v}") + F.col(f"to_{v}") for v in values}
    # At the exit what the tour has gathered, less what it had before it entered.
    return summed.groupBy("node").agg(
        *[F.sum(F.when(F.col("leave"), upto[v]).otherwise(F.col(v) - upto[v])).alias(v) for v in values]
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256. Turns are ordered by `turn`, missing ones
    first, ties by role and then by hashes of the texts; missing roles and texts are
    empty. Rows without a conv_id belong to no conversation. Repeated rows are turns of
    their own; other columns are not read. A conversation that has no turn left is a
    member of the root. An empty table gives an empty result.
    """
    need(conversations, ("conv_id", "turn", "role", "text"))
    turns = numbered_turns(conversations)
    members = turns.filter("place = 1").select("conv_id")
    rows = materialize(prefixes(rebuilt_turns(turns)), "prefixes")
    zero = [F.lit(0)] * len(PARTS)
    root = [c.alias(n) for c, n in zip(_name(F.lit(0), zero), ("p1", "p2"))]
    none = F.lit(None).cast("long")
    top = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    top = top.select(*root, none.alias("q1"), none.alias("q2"), F.lit(0).cast("long").alias("depth"),
                     F.lit(0).cast("long").alias("chars"), "conv_id", "n_convs")
    below = rows.groupBy("p1", "p2").agg(
        *[F.min(c).alias(c) for c in ("q1", "q2", "depth", "chars", "conv_id")], F.count(F.lit(1)).alias("n_convs")
    )
    named = materialize(top.unionByName(below).withColumn("node", F.monotonically_increasing_id()), "nodes")
    parents = named.select(
        F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    nodes = materialize(named.join(parents, ["q1", "q2"], "left").drop("q1", "q2"), "linked-nodes")
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")).filter("node is not null")
    weighed = nodes.join(materialize(children, "children"), "node", "left").select(
        "node", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    weighed = materialize(weighed, "weighed-nodes")
    sums = subtree_sums(list_ranks(tour(nodes)), weighed, ["n_leaves", "saved_tokens"])
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "p1", "p2")).alias("last"))
    ends = members.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col(f"last.{n}"), c).alias(n) for c, n in zip(_name(F.lit(0), zero), ("p1", "p2"))]
    )
    digests = end_digests(materialize(ends, "ends"))
    return (
        nodes.join(weighed.select("node", "n_children"), "node")
        .join(materialize(sums, "subtrees"), "node")
        .join(materialize(digests, "end-digests"), ["p1", "p2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends", F.lit(NOTHING_SHA256)).alias("ends_sha256"),
        )
    )
