"""Exact top-k search by Fagin's threshold algorithm.

Candidates are dealt into shelves by hash, queries into groups, and every pair of a shelf
and a group is one unit of work. The rows of a unit are shuffled to it and never joined,
so no plan can send a side with all its copies to the driver. A unit takes its shelf in
blocks. In a block the rows are sorted by each dimension. For a query the lists are walked
from the end that its sign favours, all to the same depth; rows met for the first time are
scored. The best score of any row not yet met is bounded by the sum over dimensions of the
query's weight times the value at that depth, and the walk stops when the k-th best score
beats this bound. The blocks' results are merged per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import blocks, materialize, need

CANDIDATES_PER_BLOCK, QUERIES_PER_BLOCK = 4096, 16_384
# A shelf is one block until there are SHELVES of them, then grows to at most so many blocks:
# queries are copied once per shelf. Vectors of more than USUAL numbers count as several rows.
SHELVES, BLOCKS_PER_SHELF, USUAL = 64, 4, 64
FIRST_DEPTH = 16
LONGEST = (1 << 63) - 1


def exact(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices of whole numbers in a type in which their products are exact."""
    largest = float(np.abs(one).max(initial=0)) * float(np.abs(two).max(initial=0)) * max(1, one.shape[1])
    if largest < 2**53:
        return one, two
    kind = np.int64 if largest < 2**62 else object
    if kind is object:
        return np.vectorize(int, otypes=[object])(one), np.vectorize(int, otypes=[object])(two)
    return one.astype(kind), two.astype(kind)


def threshold_search(
    rows: np.ndarray, order: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, depth: int = FIRST_DEPTH
) -> tuple[np.ndarray, int]:
    """Numbers of the k rows with the highest inner products, ties to smaller ids, and the depth reached.

    `order` sorts every column of `rows` upwards. `own` is a row that does not count.
    The first step goes down to `depth`, every further one twice as far.
    """
    n, open_ = len(rows), np.ones(len(rows), bool)
    if own >= 0:
        open_[own] = False
    # Lists of positive weights are walked from their upper end, those of negative ones from the lower.
    down, up = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    best, scores = np.zeros(0, np.int64), np.zeros(0, rows.dtype)
    at = 0
    while at < n:
        upto = min(depth, n)
        met = np.zeros(n, bool)
        if len(down) + len(up):
            met[order[n - upto : n - at, down].ravel()] = True
            met[order[at:upto, up].ravel()] = True
        else:
            met[at:upto] = True
        new = np.flatnonzero(met & open_)
        open_[new] = False
        best, scores = np.concatenate([best, new]), np.concatenate([scores, rows[new] @ query])
        first = np.lexsort((ids[best], -scores))[:k]
        best, scores = best[first], scores[first]
        if len(down) + len(up) and len(best) == k:
            bound = (rows[order[n - upto, down], down] * query[down]).sum() + (rows[order[upto - 1, up], up] * query[up]).sum()
            if scores[-1] > bound:
                break
        at, depth = upto, 2 * depth
    return best, upto if n else depth


def _matrix(column: pa.Array, rows: int, scale: float) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).reshape(rows, -1)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scale: float = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score): the k rows of highest inner product for each query row.

    Components are multiplied by `scale` and rounded down to whole numbers, and scores
    are exact (beyond 64 bits they are cut to the nearest long). `is_query` is an
    expression over the id. Candidates are all rows but the query's own; vectors that
    are null or hold a null or non-finite component take no part, and vectors of another
    length are no candidates. Ties go to the smaller id, missing ids last. Repeated rows
    count as rows of their own. An empty table gives an empty result.
    """
    need(vectors, (id_column, vector_column))
    sound = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    clean = vectors.filter(F.col(vector_column).isNotNull() & sound).select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(LONGEST)).alias("id"),
        F.col(vector_column).cast("array<double>").alias("v"),
        F.size(vector_column).alias("dim"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = materialize(clean.withColumn("uid", F.monotonically_increasing_id()), "vectors")
    weight = F.greatest(F.col("dim") / USUAL, F.lit(1.0))
    sizes = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.ceil(F.sum(weight)).alias("weight"),
        F.ceil(F.sum(F.when(F.col("asks"), weight))).alias("asking"),
    ).first()
    per_block = CANDIDATES_PER_BLOCK
    grown = blocks(sizes["weight"] or 0, BLOCKS_PER_SHELF * per_block)
    n_shelves = min(blocks(sizes["rows"], per_block), max(SHELVES, grown))
    n_groups = blocks(sizes["asking"] or 0, QUERIES_PER_BLOCK)

    def dealt(count: int, *key: Column | str) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(count)).cast("int")

    def copied(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    slim = ("uid", "id", "v", "dim")
    candidates = rows.select(*slim, dealt(n_shelves, "uid").alias("shelf"), copied(n_groups).alias("group"))
    queries = rows.filter("asks").select(
        *slim, copied(n_shelves).alias("shelf"), dealt(n_groups, "uid", F.lit(1)).alias("group")
    )

    def run(asks: pa.Table, held: pa.Table) -> pa.Table:
        found = {name: [] for name in ("uid", "query_id", "id", "score")}
        if len(asks) and len(held):
            asks, held = asks.combine_chunks(), held.combine_chunks()
            asked, shelf = (_matrix(t.column("v").combine_chunks(), len(t), scale) for t in (asks, held))
            q_uid, q_id = asks.column("uid").to_numpy(), asks.column("id").to_numpy()
            for part in np.array_split(np.arange(len(held)), blocks(len(held), per_block)):
                c_uid, c_id = held.column("uid").to_numpy()[part], held.column("id").to_numpy()[part]
                q, c = exact(asked, shelf[part])
                order = np.argsort(c, axis=0, kind="stable")
                place = {u: i for i, u in enumerate(c_uid.tolist())}
                depth = FIRST_DEPTH
                for i in range(len(q)):
                    # Queries on one block need similar depths: begin with half of the last one's.
                    best, reached = threshold_search(c, order, c_id, q[i], place.get(int(q_uid[i]), -1), k, depth)
                    depth = max(FIRST_DEPTH, reached // 2)
                    for row in best.tolist():
                        score = int(c[row] @ q[i])
                        found["uid"].append(int(q_uid[i]))
                        found["query_id"].append(int(q_id[i]))
                        found["id"].append(int(c_id[row]))
                        found["score"].append(max(-LONGEST - 1, min(LONGEST, score)))
        return pa.table({n: pa.array(v, pa.int64()) for n, v in found.items()})

    unit = ("dim", "shelf", "group")
    paired = queries.groupBy(*unit).cogroup(candidates.groupBy(*unit))
    partial = paired.applyInArrow(run, "uid long, query_id long, id long, score long")
    ranked = Window.partitionBy("uid").orderBy(F.desc("score"), "id")
    merged = partial.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    back = F.when(F.col("id") < LONGEST, F.col("id"))
    return merged.select("query_id", "rank", back.alias(id_column), "score")
