"""Near-duplicate embeddings by an epsilon grid order join.

A cosine of at least c is a distance of at most e = sqrt(2 - 2c) between unit vectors. The
unit vectors are projected on their leading principal directions and put in the order of
the grid cells of width e that the projections lie in, cell by cell; the order is cut into
blocks. Blocks are joined as intervals of that order: starting from the whole order, a
pair of intervals is split into pairs of their parts unless the boxes around the parts'
projections are further apart than e, which no pair of their vectors can make up for.
What is left are pairs of blocks. Within a pair the same recursion goes on in numpy down
to short runs, whose cosines are worked out in double precision.

Equal vectors of a label are one node from the start. A pair of blocks returns for each
vector no list of links but their number, and one edge to the first vector that it hangs
together with inside the pair; sums and connected components put these together. So a
cluster of any size costs rows in proportion to its vectors and blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import materialize, need
from orderloom.llm.graph import components

COSINE = 0.93
# Directions of the grid, and the bounded sample of vectors that they are fitted on. They
# decide the order and what can be skipped, never what is linked.
DIRECTIONS = 8
SAMPLE_ROWS, SAMPLE_VALUES = 2048, 1 << 20
BLOCK_ROWS, RUN_ROWS = 1024, 128
# An interval has up to 2^SPLIT_BITS parts.
SPLIT_BITS = 3
# Slack for the rounding of projections.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components, and one that is not 0."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times powers of two that keep their squares in range, and the rows' lengths."""
    rows = rows.astype(np.float64)
    _, exponents = np.frexp(np.abs(rows).max(axis=1, initial=0))
    rows = np.ldexp(rows, -exponents[:, None])
    return rows, np.sqrt(np.einsum("ij,ij->i", rows, rows))


def principal_directions(nodes: DataFrame, count: int) -> np.ndarray:
    """Orthonormal columns, fitted on a bounded sample of the vectors of the commonest length."""
    common = nodes.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return np.zeros((1, 1))
    rows = min(SAMPLE_ROWS, max(2, SAMPLE_VALUES // common.dim))
    drawn = nodes.filter(F.size("vector") == common.dim).orderBy(F.xxhash64("h1"), "h1", "h2").limit(rows)
    sample, lengths = scaled(np.array([r.vector for r in drawn.select("vector").collect()]))
    unit = sample / lengths[:, None]
    _, _, directions = np.linalg.svd(unit - unit.mean(axis=0), full_matrices=False)
    return directions[:count].T


def _projected(rows: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Projections of the unit vectors; vectors of another length keep their first components."""
    rows, lengths = scaled(rows)
    unit = rows / lengths[:, None]
    count = directions.shape[1]
    if unit.shape[1] == len(directions):
        return unit @ directions
    return np.pad(unit[:, :count], ((0, 0), (0, max(0, count - unit.shape[1]))))


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of the vectors of a list column."""
    lengths = column.value_lengths().to_numpy()
    found = []
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        found.append((at, flat.reshape(len(at), length)))
    return found


def _with_cells(nodes: DataFrame, directions: np.ndarray, width: float) -> DataFrame:
    """Add the projections and the grid cells of rows (node, part, copies, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shape = (batch.num_rows, directions.shape[1])
            projected = np.zeros(shape)
            for at, rows in _matrix(batch.column("vector")):
                projected[at] = _projected(rows, directions)
            offsets = pa.array(np.arange(0, projected.size + 1, shape[1], dtype=np.int32))
            cells = np.floor(projected / width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (projected, cells)]],
                names=[*batch.schema.names, "projected", "cells"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, f"{kinds}, projected array<double>, cells array<int>")


def _blocks(batches: Iterator[pa.RecordBatch], rows_per_block: int) -> Iterator[pa.RecordBatch]:
    """Runs of one part and vector length of sorted rows, packed into blocks that keep the order."""
    held: list[tuple] = []
    key, number, range_ = None, 0, 0

    def block() -> pa.RecordBatch:
        nonlocal number
        node, copies, vectors, projected = (np.concatenate(x) for x in zip(*held))
        values = [range_, number, *key, node.tobytes(), copies.tobytes(), vectors.tobytes(),
                  projected.tobytes(), projected.min(axis=0).tolist(), projected.max(axis=0).tolist()]
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.int32(), *[pa.binary()] * 4, *[pa.list_(pa.float64())] * 2]
        names = ["range", "number", "part", "dim", "nodes", "copies", "vectors", "projected", "low", "high"]
        number += 1
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        range_ = batch.column("_range")[0].as_py()
        parts, dims = batch.column("part").to_pylist(), batch.column("vector").value_lengths().to_pylist()
        borders = [i for i in range(1, len(parts)) if (parts[i], dims[i]) != (parts[i - 1], dims[i - 1])]
        for a, b in zip([0, *borders], [*borders, len(parts)]):
            if held and key != (parts[a], dims[a]):
                yield block()
            key = (parts[a], dims[a])
            cut = batch.slice(a, b - a)
            node, copies = cut.column("node").to_numpy(), cut.column("copies").to_numpy()
            vectors = cut.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(b - a, key[1])
            projected = cut.column("projected").flatten().to_numpy().reshape(b - a, -1)
            at = 0
            while at < b - a:
                room = rows_per_block - sum(len(x[0]) for x in held)
                held.append(tuple(x[at : at + room] for x in (node, copies, vectors, projected)))
                at += room
                if sum(len(x[0]) for x in held) >= rows_per_block:
                    yield block()
    if held:
        yield block()


BLOCK_KINDS = (
    "range int, number long, part string, dim int, nodes binary, copies binary, vectors binary, "
    "projected binary, low array<double>, high array<double>"
)


def ordered_blocks(nodes: DataFrame, directions: np.ndarray, width: float, rows_per_block: int) -> DataFrame:
    """The blocks of the epsilon grid order, numbered from 0 by `seq`, stored."""
    cells = _with_cells(nodes, directions, width)
    order = [F.col("part"), F.size("vector"), F.col("cells"), F.col("node")]
    ranged = cells.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    packed = materialize(ranged.mapInArrow(lambda batches: _blocks(batches, rows_per_block), BLOCK_KINDS), "grid-blocks")
    sizes = packed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = materialize(sizes.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")), "block-starts")
    return packed.join(starts, "range").withColumn("seq", F.col("start") + F.col("number")).drop("range", "number", "start")


def close_blocks(boxes: DataFrame, width: float, count: int, directions: int) -> DataFrame:
    """(one, two) numbers of blocks, one <= two, whose boxes are no further apart than `width`.

    `boxes` has seq, part, dim, low and high and is stored. Interval i of a level holds the
    blocks whose numbers start with the bits of i, as far as they are of one part.
    """
    levels = 0
    while max(count - 1, 0) >> (SPLIT_BITS * levels):
        levels += 1

    def intervals(level: int) -> DataFrame:
        joined = boxes.withColumn("interval", F.shiftright("seq", SPLIT_BITS * level))
        if not level:
            return joined.select("part", "dim", "interval", "low", "high")
        sides = [F.array(*[f(F.get(c, F.lit(k))) for k in range(directions)]).alias(c) for f, c in ((F.min, "low"), (F.max, "high"))]
        return joined.groupBy("part", "dim", "interval").agg(*sides)

    top = intervals(levels).select("part", "dim", F.col("interval").alias("one"), F.col("interval").alias("two"))
    pairs = materialize(top, "close-intervals")
    for level in reversed(range(levels)):
        parts = materialize(intervals(level), "intervals")

        def side(name: str) -> DataFrame:
            return parts.select(
                "part", "dim", F.shiftright("interval", SPLIT_BITS).alias(name), F.col("interval").alias(f"{name}_part"),
                F.col("low").alias(f"{name}_low"), F.col("high").alias(f"{name}_high"),
            )

        apart = F.lit(0.0)
        for k in range(directions):
            low, high = ([F.get(f"{n}_{s}", F.lit(k)) for n in ("one", "two")] for s in ("low", "high"))
            gap = F.greatest(F.lit(0.0), low[0] - high[1], low[1] - high[0])
            apart = apart + gap * gap
        met = pairs.join(side("one"), ["part", "dim", "one"]).join(side("two"), ["part", "dim", "two"])
        near = met.filter((F.col("one_part") <= F.col("two_part")) & (apart <= width * width + SLACK))
        pairs = materialize(near.select("part", "dim", F.col("one_part").alias("one"), F.col("two_part").alias("two")), "close-intervals")
    return pairs.select("one", "two")


def linked_rows(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], cosine: float) -> np.ndarray:
    """Truth of `cosine` or more between all rows of two blocks (vectors, projections)."""
    width = 2 - 2 * cosine + SLACK
    (a, a_lengths), (b, b_lengths) = scaled(one[0]), scaled(two[0])
    linked = np.zeros((len(a), len(b)), bool)

    def join(i: int, j: int, k: int, m: int) -> None:
        p, q = one[1][i:j], two[1][k:m]
        gaps = np.maximum(0, np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0)))
        if gaps @ gaps > width:
            return
        if max(j - i, m - k) <= RUN_ROWS:
            linked[i:j, k:m] = a[i:j] @ b[k:m].T / np.outer(a_lengths[i:j], b_lengths[k:m]) >= cosine
        elif j - i >= m - k:
            middle = (i + j) // 2
            join(i, middle, k, m)
            join(middle, j, k, m)
        else:
            middle = (k + m) // 2
            join(i, j, k, middle)
            join(i, j, middle, m)

    join(0, len(a), 0, len(b))
    return linked


def first_met(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the rows and columns of a truth table the number of their component, -1 without a link."""
    rows, columns = (np.full(n, -1) for n in linked.shape)
    for start in np.flatnonzero(linked.any(axis=1)):
        if rows[start] >= 0:
            continue
        new = np.array([start])
        rows[new] = start
        while len(new):
            reached = np.flatnonzero(linked[new].any(axis=0) & (columns < 0))
            columns[reached] = start
            new = np.flatnonzero(linked[:, reached].any(axis=1) & (rows < 0)) if len(reached) else reached
            rows[new] = start
    return rows, columns


def _links(batches: Iterator[pa.RecordBatch], cosine: float, kind: str) -> Iterator[pa.RecordBatch]:
    """(node, links, head) of all vectors with a link in a pair of blocks."""
    for batch in batches:
        for pair in batch.to_pylist():
            sides = []
            for n in ("one", "two"):
                block = pair[f"{n}_block"]
                nodes, copies = (np.frombuffer(block[c], np.int64) for c in ("nodes", "copies"))
                vectors = np.frombuffer(block["vectors"], kind).reshape(len(nodes), -1)
                sides.append((nodes, copies, vectors, np.frombuffer(block["projected"], np.float64).reshape(len(nodes), -1)))
            one, two = sides
            same = pair["one"] == pair["two"]
            linked = linked_rows(one[2:], two[2:], cosine)
            if same:
                np.fill_diagonal(linked, True)  # a row and its own column are one vector
            rows, columns = first_met(linked)
            if same:
                np.fill_diagonal(linked, False)
            counted = [(one, rows, linked @ two[1])]
            if not same:
                counted.append((two, columns, linked.T @ one[1]))
            for side, heads, links in counted:
                at = np.flatnonzero(links)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(side[0][at]), pa.array(links[at].astype(np.int64)), pa.array(one[0][heads[at]])],
                        names=["node", "links", "head"],
                    )


def near_vectors(
    rows: DataFrame,
    cosine: float = COSINE,
    rows_per_block: int = BLOCK_ROWS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of `rows`.

    Vectors of one label that is not null are linked if their cosine is at least `cosine`;
    vectors of different lengths are not compared. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing. `component_id` is the smallest
    id reachable by links. Repeated rows are vectors of their own. A row without an id is
    a vector too: its component is named by the ids that there are, and is null, and the
    row kept, where there is none. Other columns are not read; an empty table gives an
    empty result.
    """
    need(rows, (id_column, vector_column, label_column))
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be over 0 and at most 1")
    single = rows.schema[vector_column].dataType.simpleString() == "array<float>"
    element, kind = ("float", "<f4") if single else ("double", "<f8")
    part = F.col(label_column).cast("string").alias("part")
    read = rows.select(F.col(id_column).cast("long").alias("id"), part, F.col(vector_column).cast(f"array<{element}>").alias("vector"))
    takes_part = F.col("part").isNotNull() & F.col("vector").isNotNull() & usable(F.col("vector"))
    named = read.select(
        "id", "part", "vector", *[F.when(takes_part, F.xxhash64(F.lit(s), "part", "vector")).alias(f"h{s}") for s in (1, 2)]
    )
    grouped = named.filter("h1 is not null").groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.first("part").alias("part"), F.first("vector").alias("vector")
    )
    nodes = materialize(grouped.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    width = math.sqrt(2 - 2 * cosine) + SLACK
    directions = principal_directions(nodes, DIRECTIONS)
    slim = nodes.select("node", "part", "copies", "vector")
    blocks = materialize(ordered_blocks(slim, directions, width, rows_per_block), "numbered-blocks")
    boxes = blocks.select("seq", "part", "dim", "low", "high")
    pairs = close_blocks(boxes, width, blocks.count(), directions.shape[1])

    def side(name: str) -> DataFrame:
        return blocks.select(F.col("seq").alias(name), F.struct("nodes", "copies", "vectors", "projected").alias(f"{name}_block"))

    # A pair is a task's worth of work: deal them out one by one.
    dealt = pairs.join(side("one"), "one").join(side("two"), "two").select("one", "two", "one_block", "two_block")
    found = dealt.repartition(F.xxhash64("one", "two")).mapInArrow(
        lambda batches: _links(batches, cosine, kind), "node long, links long, head long"
    )
    found = materialize(found, "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select("node", "head"), "node", "head")
    # Vectors that are alone in their component need no row here.
    known = nodes.select("node", "h1", "h2", "copies", "least").join(materialize(counts, "link-counts"), "node", "left")
    known = known.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = materialize(known.filter("copies > 1 or links is not null"), "linked-vectors")
    heads = known.groupBy("component").agg(F.min("least").alias("component_id"))
    notes = known.join(heads, "component").select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id", F.lit(True).alias("noted")
    )
    whole = named.select("id", "h1", "h2").join(materialize(notes, "vector-notes"), ["h1", "h2"], "left")
    component = F.when(F.col("noted"), F.col("component_id")).otherwise(F.col("id"))
    return whole.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (component.isNull() | F.coalesce(component == F.col("id"), F.lit(False))).alias("kept"),
    )
