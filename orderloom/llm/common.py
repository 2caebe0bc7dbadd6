"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.operators.scratch import materialize, scratch_path, scratch_scope
from orderloom.session import configure, ship_package

__all__ = [
    "blocks", "corpus_session", "dense_ids", "document_key", "given_id", "join_checked", "materialize", "need", "numbered_rows",
    "read_table", "scratch_path", "scratch_scope",
]

# Rows and bytes that one Arrow batch may hold on its way to a Python task: very long
# texts then cost a few batches more and no memory.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def corpus_session(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, bounded Arrow batches and the code on its executors."""
    ship_package(spark)
    explicit = spark.conf.getAll
    for key, value in BATCH_SETTINGS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return configure(spark)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def need(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def document_key(name: str = "doc_id") -> Column:
    """The id as an ordering key; a missing id sorts after every other."""
    return F.coalesce(F.col(name).cast("long"), F.lit((1 << 63) - 1))


def given_id(key: Column) -> Column:
    """The id of an ordering key again; null where it was missing."""
    return F.nullif(key, F.lit((1 << 63) - 1))


def numbered_rows(docs: DataFrame, id_column: str, text_column: str, codec: str | None = None) -> DataFrame:
    """(key, uid, text, rest), stored: the ordering key, a number of the row's own, the text and all other columns.

    Rows that share an id, or have none, are told apart and ordered by `uid`.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("rest")
    uid = F.monotonically_increasing_id().alias("uid")
    numbered = docs.select(document_key(id_column).alias("key"), uid, F.col(text_column).alias("text"), rest)
    return materialize(numbered, "rows", codec)


def blocks(rows: int, per_block: int, least: int = 1) -> int:
    """Number of blocks so that each holds about `per_block` rows."""
    return max(least, -(-rows // per_block))


# Rows of a few numbers each that a join may send to every task: some 40 MB.
BROADCAST_ROWS = 500_000


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a stored frame of slim rows, sent to every task if its counted rows allow.

    Beyond the bound both sides are shuffled by the key, as for any large join.
    """
    return big.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, on, how)


def dense_ids(df: DataFrame, group: str, order: list[str], name: str, n_blocks: int) -> DataFrame:
    """Number the rows of each `group` from 0 without gaps, in whatever order.

    A group is split over `n_blocks` blocks by the hash of the `order` columns; rows are
    numbered within their block, and the blocks' row counts give each block's start. So
    a group of any size is spread over tasks. `order` should tell rows apart; rows that
    it does not are copies, which may change places. `df` must be cheap to read twice
    and must not change between reads.
    """
    from pyspark.sql import Window

    blocked = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(n_blocks)).cast("int"))
    sizes = blocked.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        group, "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(group, "_block").orderBy(*order)
    numbered = blocked.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        numbered.join(starts, [group, "_block"])
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_block", "_start", "_place")
    )
