"""Balanced label propagation: equal documents share a shard, and shards are equal in bytes.

Linked documents (those of one group) start in shards by hash and move, round by round,
to the shard that holds most of their group's bytes, as long as that shard has room. They
move in cells, the part of a group that started in one shard; groups too large for a
shard have finer cells, fill their favourite shard and then gather in the next. Loads and
wishes are sums per shard; how many of the wishes a shard can grant is a share, granted by
hash, so no list of movers is ever sorted in one place.

Groups that are still in more shards than they need when nothing moves any more (most of
them, if much of the corpus is copies and all shards are full from the start) are taken
out and placed anew, each as one unit, together with the documents without a link: the few
units that weigh more than a hundredth of a shard go to the lightest shard each, largest
first, and all others are laid end to end in hash order and cut where each shard is full.
A group too large for that lies there cell by cell, side by side, so that only a cut splits it.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import blocks, dense_ids, materialize, need

SHARDS = 40
OVERHEAD = 16
# Linked documents may take this share of a shard; the rest is for evening out.
LINKED_SHARE = 0.9
MAX_ROUNDS = 12
# Propagation ends when less than this share of a shard could still move.
LEAST_MOVED = 0.001
# Cells of large groups are about this share of a shard.
CELL_SHARE = 0.005
# Unlinked documents above this share of a shard are placed one by one.
SINGLE_SHARE = 0.01
ROWS_PER_BLOCK = 50_000

GROUP = ["g1", "g2"]


def _by_shard(values: list, shard: Column, kind: str) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), shard)


def _sums(df: DataFrame, shard: str, n_shards: int) -> list[int]:
    """Bytes per shard: one number each."""
    found = {r[shard]: r["total"] for r in df.groupBy(shard).agg(F.sum("bytes").alias("total")).collect()}
    return [int(found.get(s) or 0) for s in range(n_shards)]


def propagate(cells: DataFrame, capacity: float, n_shards: int, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Move cells (g1, g2, origin, part, large, bytes, shard) towards their group's shards."""
    for round_ in range(max_rounds):
        loads = _sums(cells, "shard", n_shards)
        room = [max(0.0, capacity - load) for load in loads]
        held = cells.groupBy(*GROUP, "shard").agg(F.sum("bytes").alias("held"))
        open_ = held.withColumn("room", _by_shard(room, F.col("shard"), "double")).filter("room > 0")
        best = open_.groupBy(*GROUP).agg(F.max(F.struct("held", "room", (-F.col("shard")).alias("minus"))).alias("best"))
        aims = materialize(
            held.join(best, GROUP)
            .select(*GROUP, "shard", (-F.col("best.minus")).alias("aim"), "held", F.col("best.held").alias("there"))
            # equal holdings meet where most room is left
            .filter((F.col("held") <= F.col("there")) & (F.col("shard") != F.col("aim")))
            .drop("held", "there"),
            "aims",
        )
        wishes = cells.join(aims, [*GROUP, "shard"])
        wanted = _sums(wishes, "aim", n_shards)
        if sum(min(r, w) for r, w in zip(room, wanted)) < LEAST_MOVED * capacity:
            break
        share = [min(1.0, r / w) if w else 0.0 for r, w in zip(room, wanted)]
        # Small groups move together; the cells of a large one move each on its own.
        own = F.when(F.col("large"), F.xxhash64("origin", "part")).otherwise(F.lit(0))
        drawn = F.pmod(F.xxhash64(*GROUP, own, F.lit(round_)), F.lit(1_000_000)) / 1e6
        moved = cells.join(aims, [*GROUP, "shard"], "left")
        goes = F.col("aim").isNotNull() & (drawn < F.coalesce(_by_shard(share, F.col("aim"), "double"), F.lit(0.0)))
        cells = materialize(
            moved.select(*GROUP, "origin", "part", "large", "bytes", F.when(goes, F.col("aim")).otherwise(F.col("shard")).alias("shard")),
            "cells",
        )
    return cells


def _level(loads: list[int], free: int) -> list[int]:
    """How many of the `free` bytes each shard takes so that the lightest are filled up evenly."""
    order, level, left = sorted(range(len(loads)), key=loads.__getitem__), 0.0, float(free)
    for n, s in enumerate(order):
        top = loads[order[n + 1]] if n + 1 < len(order) else float("inf")
        level = min(top, loads[s] + left / (n + 1))
        left -= (level - loads[s]) * (n + 1)
        if left <= 0:
            break
    return [max(0, round(level) - load) for load in loads]


def _scattered(settled: DataFrame, goal: float) -> DataFrame:
    """(g1, g2, large, all) of groups in more shards than they need: one, or one more than a large group fills."""
    spread = settled.groupBy(*GROUP, "large").agg(F.sum("bytes").alias("all"), F.countDistinct("shard").alias("shards"))
    least = F.when(F.col("large"), F.ceil(F.col("all") / F.lit(max(1.0, goal))) + 1).otherwise(F.lit(1))
    return spread.filter(F.col("shards") > least).drop("shards")


def _place_singles(single: list, loads: list[int], limit: float) -> list[tuple]:
    """(uid, g1, g2, shard) of a bounded number of heavy units, largest first to the lightest shard.

    A group (its uid is null) that would take the lightest shard over the limit is left out.
    """
    heap = [(load, s) for s, load in enumerate(loads)]
    heapq.heapify(heap)
    chosen = []
    for row in sorted(single, key=lambda r: (-r["bytes"], r["uid"] is None, r["uid"], r["g1"], r["g2"])):
        load, s = heap[0]
        if row["uid"] is None and load + row["bytes"] > limit:
            continue
        chosen.append((row["uid"], row["g1"], row["g2"], s))
        loads[s] = load + row["bytes"]
        heapq.heapreplace(heap, (loads[s], s))
    return chosen


def _fill(light: DataFrame, shares: list[int], rows: int) -> DataFrame:
    """`light` (h, at, bytes, ...) with its `shard`: units in order of h and at, cut where each shard has its share of bytes."""
    n = blocks(rows, ROWS_PER_BLOCK, 64)
    # The top bits of a hash give its block, so blocks follow each other in hash order.
    block = F.shiftright(F.shiftrightunsigned("h", 32) * F.lit(n), 32)
    placed = light.withColumn("block", block.cast("int"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("block").agg(F.sum("bytes").alias("total"))
    starts = sums.select("block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("block").orderBy("h", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = placed.withColumn("so_far", F.sum("bytes").over(inside))
    joined = ends.join(starts, "block")
    # the middle of the unit decides
    middle = F.col("start") + F.col("so_far") - F.col("bytes") / 2
    limits, total = [], 0
    for share in shares[:-1]:
        total += share
        limits.append(total)
    cuts = F.array(*[F.lit(float(x)) for x in limits]) if limits else F.array().cast("array<double>")
    return joined.withColumn("shard", F.size(F.filter(cuts, lambda cut: cut <= middle)))


def shard(
    docs: DataFrame, n_shards: int = SHARDS, overhead: int = OVERHEAD, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, shard, slot), one row per row of `docs`.

    `size` is the text's bytes and `overhead`; a null text has none and counts as empty.
    Shards are 0 to n_shards - 1 and near equal in size; documents of equal texts are in
    as few shards as that allows. `slot` numbers the rows of a shard from 0 without gaps.
    Repeated rows and null ids are documents of their own; an empty table gives an empty
    result. Other columns are not read.
    """
    need(docs, (id_column, text_column))
    text = F.coalesce(F.col(text_column), F.lit(""))
    items = materialize(
        docs.select(
            F.col(id_column).alias("id"),
            (F.octet_length(text) + F.lit(overhead)).cast("long").alias("bytes"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.xxhash64(text).alias("g1"), F.xxhash64(F.lit(1), text).alias("g2"),
        ).withColumn("uid", F.monotonically_increasing_id()),
        "items",
    )
    whole = items.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    rows, goal = whole["rows"], (whole["bytes"] or 0) / n_shards
    groups = items.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("all"))
    linked = materialize(groups.filter("rows > 1").drop("rows"), "groups")
    parts = F.ceil(F.col("all") / F.lit(max(1.0, goal * CELL_SHARE * n_shards)))
    members = materialize(
        items.join(linked, GROUP).select(
            "uid", *GROUP, "bytes",
            F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(n_shards)).cast("int").alias("origin"),
            F.pmod(F.xxhash64("uid", F.lit(2)), parts).cast("int").alias("part"),
            (F.col("all") > goal * LINKED_SHARE / 4).alias("large"),
        ),
        "members",
    )
    cells = members.groupBy(*GROUP, "origin", "part", "large").agg(F.sum("bytes").alias("bytes"))
    start = materialize(cells.withColumn("shard", F.col("origin")), "cells")
    settled = propagate(start, goal * LINKED_SHARE, n_shards)
    torn = materialize(_scattered(settled, goal), "torn-groups")
    whole_cells = settled.join(torn, GROUP, "left_anti")
    loads = _sums(whole_cells, "shard", n_shards)
    free = materialize(items.select("uid", "bytes").join(members.select("uid"), "uid", "left_anti"), "unlinked")
    # At most n_shards / SINGLE_SHARE documents and groups can weigh so much.
    weighs = F.col("bytes") > goal * SINGLE_SHARE
    no_id, no_group = F.lit(None).cast("long"), [F.lit(None).cast("long").alias(g) for g in GROUP]
    single = free.select("uid", *no_group, "bytes").filter(weighs).unionByName(
        torn.filter(~F.col("large")).select(no_id.alias("uid"), *GROUP, F.col("all").alias("bytes")).filter(weighs)
    )
    chosen = _place_singles(single.collect(), loads, goal * (1 + SINGLE_SHARE))
    spark = docs.sparkSession
    sole = materialize(spark.createDataFrame(chosen, "uid long, g1 long, g2 long, shard int"), "singles")
    group_hash = F.xxhash64(*GROUP)
    small = torn.filter(F.col("all") <= goal * SINGLE_SHARE)
    # Groups too large for one place go cell by cell, side by side.
    broken = torn.filter(F.col("all") > goal * SINGLE_SHARE).join(sole, GROUP, "left_anti")
    none = F.lit(None).cast("int")
    units = materialize(
        free.filter(~weighs).select(F.xxhash64("uid").alias("h"), F.col("uid").alias("at"), "bytes", "uid", *no_group, none.alias("origin"), none.alias("part"))
        .unionByName(small.select(group_hash.alias("h"), F.col("g2").alias("at"), F.col("all").alias("bytes"), no_id.alias("uid"), *GROUP, none.alias("origin"), none.alias("part")))
        .unionByName(
            settled.join(broken, GROUP, "left_semi").select(
                group_hash.alias("h"), (F.col("part").cast("long") * n_shards + F.col("origin")).alias("at"), "bytes",
                no_id.alias("uid"), *GROUP, "origin", "part",
            )
        ),
        "units",
    )
    rest = int(units.agg(F.sum("bytes")).first()[0] or 0)
    filled = materialize(_fill(units, _level(loads, rest), rows).select("uid", *GROUP, "origin", "part", "shard"), "filled")
    cell = [*GROUP, "origin", "part"]
    groups_placed = filled.filter("uid is null and origin is null").select(*GROUP, "shard").unionByName(
        sole.filter("uid is null").select(*GROUP, "shard")
    )
    cells_placed = (
        whole_cells.select(*cell, "shard")
        .unionByName(settled.select(*cell).join(groups_placed, GROUP))
        .unionByName(filled.filter("origin is not null").select(*cell, "shard"))
    )
    assigned = (
        members.join(cells_placed, cell).select("uid", "shard")
        .unionByName(filled.filter("uid is not null").select("uid", "shard"))
        .unionByName(sole.filter("uid is not null").select("uid", "shard"))
    )
    placed = materialize(items.drop(*GROUP).join(assigned, "uid"), "placed")
    n_blocks = blocks(rows, ROWS_PER_BLOCK * n_shards, 8)
    slotted = dense_ids(placed, "shard", ["uid"], "slot", n_blocks)
    return slotted.select(
        F.col("id").alias(id_column), F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
    )
