"""Dense ranks and running sums over a whole frame.

A window without PARTITION BY moves every row to one task. So the frame is always
range-partitioned, each range is numbered on its own, and small per-range offsets put the
pieces together.
The inputs must be cheap to read repeatedly (see `materialize`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.operators.scratch import materialize


def _in_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition and store the frame together with its range number.

    Storing fixes the range numbers: a recomputed range shuffle samples again and may
    cut elsewhere, while offsets and rows must agree on the cuts.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    return materialize(ranged, "ranges")


def _with_offsets(ranged: DataFrame, size: Column) -> DataFrame:
    """Attach to each row the total `size` of all earlier ranges."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, at most as many as there are shuffle partitions
    offsets = ranged.groupBy("_range").agg(size.alias("_size"))
    offsets = offsets.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return ranged.join(F.broadcast(offsets), "_range")


def ranks_and_sums(
    df: DataFrame, rank: str, rank_by: Sequence[str], ties: Sequence[Column], sums: Mapping[str, str] | None = None
) -> DataFrame:
    """Dense rank by columns, largest first and NULLs last, and running sums in the same order.

    `sums` maps result names to columns; each also gives `total_<name>`, the sum over all
    rows. One range-partitioned copy serves everything. `ties` tells rows of one rank
    apart, so a heavily repeated value is spread over several ranges: a range whose first
    value is the last one of the range before goes on with its rank.
    """
    sums = sums or {}
    order = [*[F.col(c).desc_nulls_last() for c in rank_by], *ties]
    # Stored first: cutting ranges samples the frame, which would else be worked out twice.
    ranged = _in_ranges(materialize(df, "unranked"), order)
    value = F.struct(*rank_by)  # NULL is the least value, so structs are ordered as the ranks are
    inside = Window.partitionBy("_range").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.lag(value).over(inside)
    changes = F.when(previous.isNull() | ~value.eqNullSafe(previous), 1).otherwise(0)
    placed = ranged.withColumn("_new", changes).select(
        "*", F.sum("_new").over(upto).alias("_nth"), *[F.sum(c).over(upto).alias(f"_upto_{n}") for n, c in sums.items()]
    )
    held = ranged.withColumn("_new", changes).groupBy("_range").agg(
        F.sum("_new").alias("_values"), F.max(value).alias("_first"), F.min(value).alias("_last"),
        *[F.sum(c).alias(f"_size_{n}") for n, c in sums.items()],
    )
    along = Window.orderBy("_range")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(along)), F.lit(False)).cast("int")
    counted = held.withColumn("_goes_on", goes_on)
    before = F.coalesce(F.sum(F.col("_values") - F.col("_goes_on")).over(earlier), F.lit(0)) - F.col("_goes_on")
    # one row per range, at most as many as there are shuffle partitions
    offsets = counted.select(
        "_range", before.alias("_before"),
        *[F.coalesce(F.sum(f"_size_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_size_{n}").over(Window.partitionBy()).alias(f"total_{n}") for n in sums],
    )
    joined = placed.join(F.broadcast(offsets), "_range")
    return joined.select(
        *df.columns, (F.col("_before") + F.col("_nth")).cast("bigint").alias(rank),
        *[(F.col(f"_before_{n}") + F.col(f"_upto_{n}")).alias(n) for n in sums], *[f"total_{n}" for n in sums],
    )


def dense_rank(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Dense rank by the columns, largest first, NULLs last."""
    return ranks_and_sums(df, name, columns, [F.xxhash64(*df.columns)])


def running_sum(df: DataFrame, name: str, value: str, order: Sequence[Column]) -> DataFrame:
    """Sum of `value` from the first row to this one; `order` must be unique."""
    inside = (
        Window.partitionBy("_range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = _with_offsets(_in_ranges(df, order), F.sum(value))
    return summed.withColumn(name, F.col("_offset") + F.sum(value).over(inside)).drop(
        "_range", "_offset"
    )
