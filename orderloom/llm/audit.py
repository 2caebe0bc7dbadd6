"""Interaction audit of filters: marginal effects and Shapley values from potentials.

A coalition is a set of filters, and its worth the number of documents that at least one
of its filters removes. One pass over the texts reduces a document to a bit mask of the
filters that it fails; counts by mask give the worth of all coalitions. The potential of
the game is worked out recursively over the coalitions by size of their number,

    P(S) = (worth(S) + sum of P(S without i) for i in S) / |S|,  P(nothing) = 0,

and the Shapley value of a filter is P(all) - P(all without it). What a filter removes as
a step of an order is the difference of two coalitions' worths. Worths are whole, so
potentials times the least common multiple of the sizes are whole as well, and so are
their sums over all orders: nothing is rounded.

After the masks, nothing larger than one row per part and mask is handled.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import materialize, need

SPACE = r"[\x20\x09-\x0D]+"


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text and its words; E needs all texts."""
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 2,
        "D": text.rlike("[#$%&*|]"),
    }


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic), one row per document; bit i of the mask is failed filter i.

    A text is a repeated one (E) if a row with a smaller id has it too; rows without an
    id have none that is smaller, and are not smaller than any. Null texts are empty, null
    sources the empty part. A document is good or toxic if any row of its id in `labels`
    says so; documents without an id have no label.
    """
    need(docs, ("doc_id", "text", "source"))
    need(labels, ("doc_id", "quality", "toxic"))
    read = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
    ).withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    bits = F.lit(0)
    for i, failed in enumerate(text_filters(F.col("text"), F.col("words")).values()):
        bits = bits + F.when(failed, 1 << i).otherwise(0)
    slim = materialize(
        read.select("id", "part", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), bits.alias("bits")), "masks"
    )
    # Of all texts only those found under several ids travel further.
    ids = slim.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    copied = materialize(ids.filter("first < last").select("digest", "first"), "copied-texts")
    known = slim.join(copied, "digest", "left")
    again = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    masked = known.select("id", "part", (F.col("bits") + F.when(again, 1 << 4).otherwise(0)).alias("mask"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    marked = masked.join(materialize(marks, "label-marks"), "id", "left")
    return marked.select(
        "part", "mask", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")]
    )


def coalition_worths(cells: Column, of: str, players: int) -> Column:
    """Array by coalition of the sum of `of` over cells whose mask has a filter of the coalition."""
    return F.transform(
        F.sequence(F.lit(0), F.lit((1 << players) - 1)),
        lambda s: F.aggregate(
            F.filter(cells, lambda c: c["mask"].bitwiseAND(s) != 0), F.lit(0).cast("long"), lambda total, c: total + c[of]
        ),
    )


def potentials(worths: Column, players: int, scale: int) -> Column:
    """Array by coalition of `scale` times the potential of the game.

    A coalition's number exceeds those of its parts, so one walk over the numbers finds
    every potential that the recursion asks for; the walk is a fold over 2^players places.
    """
    def next_potential(found: Column, s: Column) -> Column:
        parts = F.lit(0).cast("long")
        for i in range(players):
            bit = F.lit(1 << i)
            parts = parts + F.when(s.bitwiseAND(bit) != 0, F.get(found, s.bitwiseXOR(bit))).otherwise(0)
        whole = F.get(worths, s) * scale + parts
        return F.concat(found, F.array(F.call_function("div", whole, F.bit_count(s))))

    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << players) - 1)), start, next_potential)


def audit(documents: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """Effects of every filter at every step of every order, per part.

    `documents` has part, mask, good and toxic (0 or 1), one row per document; bit i of a
    mask stands for the i-th letter of `filters`. Returns a row per part, order and step
    with kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley (times
    the number of orders). An empty table gives an empty result.
    """
    n = len(filters)
    scale, orders = math.lcm(*range(1, n + 1)), math.factorial(n)
    counted = documents.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    # At most 2^n cells a part.
    parts = counted.groupBy("part").agg(
        F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("cells"), F.sum("docs").alias("all_docs")
    )
    cells = F.col("cells")
    games = parts.select("part", "all_docs", "cells", *[coalition_worths(cells, c, n).alias(c) for c in ("docs", "good", "toxic")])
    solved = materialize(games.withColumn("potential", potentials(F.col("docs"), n, scale)), "games")
    all_orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    ordered = solved.withColumn("filter_order", F.explode(all_orders))
    steps = ordered.select("*", F.posexplode(F.sequence(F.lit(1), F.lit(n))).alias("_place", "step"))
    own, before = F.lit(0), F.lit(0)
    for i, letter in enumerate(filters):
        at = F.instr("filter_order", letter)
        own = own + F.when(at == F.col("step"), 1 << i).otherwise(0)
        before = before + F.when(at < F.col("step"), 1 << i).otherwise(0)
    placed = steps.withColumns({"own": own, "before": before}).withColumn("after", F.col("own") + F.col("before"))

    def step_effect(of: str) -> Column:
        return F.get(of, F.col("after")) - F.get(of, F.col("before"))

    grand = (1 << n) - 1
    alone = F.aggregate(
        F.filter("cells", lambda c: c["mask"] == F.col("own")), F.lit(0).cast("long"), lambda total, c: total + c["docs"]
    )
    share = F.get("potential", F.lit(grand)) - F.get("potential", F.lit(grand).bitwiseXOR(F.col("own")))
    return placed.select(
        "part", "filter_order", "step",
        (F.col("all_docs") - F.get("docs", F.col("after"))).alias("kept"),
        step_effect("docs").alias("removed"),
        (F.get("docs", F.col("own")) - step_effect("docs")).alias("redundant"),
        alone.alias("unique_fails"),
        step_effect("good").alias("good_lost"),
        step_effect("toxic").alias("toxic_lost"),
        (share * (orders // scale)).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`audit` of the five filters A to E over documents and their labels."""
    return audit(masks(docs, labels))
