"""Gradient boosting of squared error with a limit on leaves, many fits in shared passes.

Features are cut once into bins of nearly equal row counts. A tree grows best first: of
all leaves the one with the largest gain is split until the tree has its leaves. Gains
come from histograms, one grouping by fit, leaf, feature and bin for all fits of a search
together. A grouping covers every leaf that may be split next, so a tree takes as many
groupings as it is deep and not as many as it has leaves; which of the splits the
best-first order takes is decided afterwards, from gains that are all known. Rows find
their leaf along the splits made so far, which are constants of one expression: a
grouping joins nothing and costs the same however deep the trees are.

A pass over few rows is all latency. Fits of no more rows than a task may hold can be
grown one in a task, by the same rules on the same bins and with the same result; more
rows are grown in shared passes.

Labels, scores and leaf values are whole numbers of 1/SCALE units. Sums are therefore the
same in any order, and a fit does not depend on the number of cores or partitions. An
overflow raises (ANSI mode). What reaches the driver is bounded by fits times leaves.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.functions.ranking import running_sum
from orderloom.operators.scratch import materialize
from orderloom.session import ship_package

SCALE = 10_000
BINS = 255
LEAST_ROWS = 20  # rows that either side of a split must have
ROWS_PER_TASK = 2_000_000  # rows of a fit that one task may hold, in some 300 MB
CODES = 1 << 20  # bins that one histogram step looks up
ROOT = 1  # the children of node v are 2 v and 2 v + 1


@dataclass(frozen=True)
class Fit:
    """One model of a search: learning rate in percent, leaves, and where its rows are.

    It trains on months before `until` (all if None) and is scored on those from there to
    `last`.
    """

    rate: int
    leaves: int
    until: object = None
    last: object = None


@dataclass
class _Tree:
    """Nodes of a tree in growth: (sum, rows) and best split (gain, feature, bin, left sum, left rows)."""

    limit: int
    splits: dict[int, tuple[float, int, int, int, int]] = field(default_factory=dict)
    totals: dict[int, tuple[int, int]] = field(default_factory=dict)
    grown: set[int] = field(default_factory=set)
    places: dict[int, int] = field(default_factory=lambda: {ROOT: 0})  # numbers of the nodes, in order; the right child follows the left
    chosen: set[int] = field(default_factory=set)
    waits_for: int = ROOT

    def choose(self) -> bool:
        """Follow the best-first order as far as gains are known; whether the tree is done."""
        self.chosen = set()
        heap = [(-self.splits[ROOT][0], ROOT)] if ROOT in self.splits else []
        while heap and len(self.chosen) < self.limit - 1:
            _, node = heapq.heappop(heap)
            self.chosen.add(node)
            if len(self.chosen) == self.limit - 1:
                return True
            if node not in self.grown:
                self.waits_for = node
                return False
            for child in (2 * node, 2 * node + 1):
                if child in self.splits:
                    heapq.heappush(heap, (-self.splits[child][0], child))
        return True

    def next_splits(self) -> list[int]:
        """The leaf that the order waits for, and those of largest gain, as many as may still be split."""
        room = self.limit - 1 - len(self.chosen & self.grown)
        open_ = sorted((-s[0], node) for node, s in self.splits.items() if node not in self.grown and node != self.waits_for)
        return [self.waits_for, *(node for _, node in open_[: room - 1])]

    def grow(self, nodes: Iterable[int]) -> None:
        """Split nodes; what their children hold follows from the splits."""
        for v in nodes:
            (total, rows), (_, _, _, left, left_rows) = self.totals[v], self.splits[v]
            self.totals |= {2 * v: (left, left_rows), 2 * v + 1: (total - left, rows - left_rows)}
            self.places |= {2 * v: len(self.places), 2 * v + 1: len(self.places) + 1}
            self.grown.add(v)

    def leaf_of(self, node: int) -> int:
        """The leaf of the chosen tree that holds a node of the grown one."""
        path = [node]
        while path[-1] > ROOT:
            path.append(path[-1] // 2)
        return next(v for v in reversed(path) if v not in self.chosen)


def rounded_share(top: int, bottom: int) -> int:
    """top / bottom to the nearest whole number, halves away from zero."""
    size = (2 * abs(top) + bottom) // (2 * bottom)
    return size if top >= 0 else -size


def leaf_value(total: int, rows: int, rate: int) -> int:
    return rounded_share(rate * total, 100 * rows)


# --- bins ------------------------------------------------------------------------


def bin_borders(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Least value of every bin but the first, per feature.

    A feature of at most `bins` values has a bin for each. Otherwise a value's bin is the
    share of rows below it times `bins`, rounded down. Values are counted first and
    summed along ranges, so no feature is sorted in one task.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(features)])
    counted = materialize(rows.select(F.inline(pairs)).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")), "feature-values")
    upto = running_sum(counted, "upto", "n", [F.col("f"), F.col("v")])
    sizes = counted.groupBy("f").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("f").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("before", before)  # one row per feature
    share = F.call_function("div", (F.col("upto") - F.col("n") - F.col("before")) * bins, F.col("rows"))
    placed = upto.join(sizes, "f").withColumn("bin", F.when(F.col("values") > bins, share))
    # Few values: each is its own group.
    least = placed.groupBy("f", F.coalesce(F.col("bin").cast("double"), F.col("v")).alias("group")).agg(F.min("v").alias("v"))
    found: list[list[float]] = [[] for _ in features]
    for row in least.orderBy("f", "v").collect():  # at most features times bins
        found[row["f"]].append(row["v"])
    return [values[1:] for values in found]


def binned(rows: DataFrame, features: Sequence[str], borders: Sequence[Sequence[float]]) -> DataFrame:
    """Add `bins`, the number of borders at or below each feature's value."""
    cut = [i for i, b in enumerate(borders) if b]
    infinity = float("inf")
    read = rows.withColumns({f"_x{i}": F.col(features[i]).cast("double") for i in cut})
    if cut:
        read = Bucketizer(
            splitsArray=[[-infinity, *borders[i], infinity] for i in cut],
            inputCols=[f"_x{i}" for i in cut], outputCols=[f"_b{i}" for i in cut],
        ).transform(read)
    bins = F.array(*[F.col(f"_b{i}").cast("smallint") if b else F.lit(0).cast("smallint") for i, b in enumerate(borders)])
    return read.withColumn("bins", bins).drop(*[f"_{p}{i}" for p in "xb" for i in cut])


# --- growth ----------------------------------------------------------------------


def best_splits(held: DataFrame, least_rows: int) -> DataFrame:
    """(fit, leaf, total, rows, best) from rows (fit, leaf, residual, bins).

    `best` holds gain, feature and bin of the leaf's best split, values up to the bin to
    the left; ties go to the smaller feature and bin. It is null if no split leaves
    enough rows on both sides or gains anything.
    """
    cells = held.select("fit", "leaf", "residual", F.posexplode("bins").alias("feature", "bin"))
    histogram = cells.groupBy("fit", "leaf", "feature", "bin").agg(
        F.sum("residual").alias("total"), F.count(F.lit(1)).alias("rows")
    )
    # A histogram has at most as many rows as there are bins.
    whole = Window.partitionBy("fit", "leaf", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = histogram.select(
        "fit", "leaf", "feature", "bin",
        F.sum("total").over(upto).alias("left_total"), F.sum("rows").over(upto).alias("left_rows"),
        F.sum("total").over(whole).alias("total"), F.sum("rows").over(whole).alias("rows"),
    )
    right_total, right_rows = F.col("total") - F.col("left_total"), F.col("rows") - F.col("left_rows")

    def weight(total, rows):
        return total.cast("double") * total.cast("double") / rows.cast("double")

    allowed = (F.col("left_rows") >= least_rows) & (right_rows >= least_rows)
    gain = F.when(
        allowed, weight(F.col("left_total"), F.col("left_rows")) + weight(right_total, right_rows)
        - weight(F.col("total"), F.col("rows"))
    )
    scored = cut.withColumn("gain", gain)
    split = F.struct("gain", (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), "left_total", "left_rows")
    best = F.max(F.when(F.col("gain") > 0, split))
    return scored.groupBy("fit", "leaf").agg(
        F.max("total").alias("total"), F.max("rows").alias("rows"), best.alias("best")
    )


def _small(like: DataFrame, rows: Iterable[tuple], names: str) -> DataFrame:
    """A frame of one row per fit for a broadcast join; it needs no job of its own."""
    kinds = {"fit": pa.int32(), "until": pa.date32(), "last": pa.date32()}
    columns = names.split()
    values = [*zip(*rows)] or [()] * len(columns)
    table = pa.table({n: pa.array(v, kinds[n]) for n, v in zip(columns, values)})
    return F.broadcast(like.sparkSession.createDataFrame(table))


def _numbers(values: Iterable[int]) -> Column:
    """A constant array, made from one literal however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _by_node(trees: Sequence[_Tree], table: Mapping[tuple[int, int], int], place: Column) -> Column:
    """What a table of fits times leaves says of the row's fit and the node of this number; -1 if nothing."""
    width = max(len(tree.places) for tree in trees)
    cells = [-1] * (width * len(trees))
    for (fit, node), value in table.items():
        cells[fit * width + trees[fit].places[node]] = value
    return F.get(_numbers(cells), F.col("fit") * width + place)


def _leaf(trees: Sequence[_Tree]) -> Column:
    """Number of the node that holds a row (fit, bins), walked from the root along the splits made."""
    cuts = {(i, v): tree.splits[v] for i, tree in enumerate(trees) for v in tree.grown}
    by, upto = ({cell: cut[k] for cell, cut in cuts.items()} for k in (1, 2))
    left = {(i, v): trees[i].places[2 * v] for i, v in cuts}
    depth = max((v.bit_length() for _, v in cuts), default=0)

    def step(node: Column, _: Column) -> Column:
        feature = _by_node(trees, by, node)
        side = F.when(F.get("bins", feature) <= _by_node(trees, upto, node), 0).otherwise(1)
        return F.when(feature < 0, node).otherwise(_by_node(trees, left, node) + side)

    root = F.lit(0).cast("long")
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), root, step) if depth else root


def _grow(state: DataFrame, fits: Sequence[Fit], least_rows: int) -> list[_Tree]:
    """One tree for every fit."""
    trees = [_Tree(fit.leaves) for fit in fits]
    asked = {i: [ROOT] for i in range(len(fits))}
    while asked:
        wanted = {(i, v): 1 for i, nodes in asked.items() for v in nodes}
        held = state.filter("trains").withColumn("leaf", _leaf(trees)).filter(_by_node(trees, wanted, F.col("leaf")) > 0)
        nodes_of = [[*tree.places] for tree in trees]
        for r in best_splits(held.select("fit", "leaf", "residual", "bins"), least_rows).collect():
            tree, node, best = trees[r["fit"]], nodes_of[r["fit"]][r["leaf"]], r["best"]
            tree.totals[node] = (r["total"], r["rows"])
            if best:
                tree.splits[node] = (best["gain"], -best["feature"], -best["bin"], best["left_total"], best["left_rows"])
        splits = {i: trees[i].next_splits() for i in asked if not trees[i].choose()}
        for i, nodes in splits.items():
            trees[i].grow(nodes)
        asked = {i: [c for v in nodes for c in (2 * v, 2 * v + 1)] for i, nodes in splits.items()}
    # A tree's last split needs no histograms of its children.
    for tree in trees:
        tree.grow(tree.chosen - tree.grown)
    return trees


# --- fits of one task ------------------------------------------------------------


def _histogram(codes: np.ndarray, residual: np.ndarray, rows: np.ndarray, width: int, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums of residuals and counts per feature and bin; `wide` sums may exceed what doubles hold exactly."""
    part, features = residual[rows], len(codes)
    sums, counts = np.zeros((features, width), np.int64), np.zeros((features, width), np.int64)
    step = max(1, CODES // max(1, len(rows)))
    for first in range(0, features, step):
        some = codes[first : first + step]
        n = len(some)
        places = (some[:, rows] + (np.arange(n) * width)[:, None]).ravel()

        def summed(values: np.ndarray) -> np.ndarray:
            return np.bincount(places, np.tile(values, n), n * width).astype(np.int64).reshape(n, width)

        counts[first : first + n] = np.bincount(places, minlength=n * width).reshape(n, width)
        sums[first : first + n] = (summed(part >> 26) << 26) + summed(part & ((1 << 26) - 1)) if wide else summed(part)
    return sums, counts


def _best_split(sums: np.ndarray, counts: np.ndarray, least_rows: int) -> tuple[float, int, int, int, int] | None:
    """`best_splits` of one leaf: (gain, feature, bin, left sum, left rows)."""
    left, left_rows = sums.cumsum(axis=1), counts.cumsum(axis=1)
    total, rows = left[0, -1], left_rows[0, -1]
    allowed = np.flatnonzero((left_rows >= least_rows) & (rows - left_rows >= least_rows))
    if not len(allowed):
        return None
    one, one_rows = left.ravel()[allowed], left_rows.ravel()[allowed]

    def weight(t, n):
        t = np.asarray(t).astype(np.float64)
        return t * t / np.asarray(n).astype(np.float64)

    gain = weight(one, one_rows) + weight(total - one, rows - one_rows) - weight(total, rows)
    at = int(gain.argmax())  # the first of equal ones has the smaller feature and bin
    if not gain[at] > 0:
        return None
    return float(gain[at]), *divmod(int(allowed[at]), sums.shape[1]), int(one[at]), int(one_rows[at])


def _grow_here(
    codes: np.ndarray, residual: np.ndarray, trains: np.ndarray, limit: int, least_rows: int
) -> tuple[dict[int, tuple[int, int]], dict[int, tuple[int, int]], dict[int, np.ndarray]]:
    """One tree, best first: cuts (feature, bin), the leaves' (sum, rows) and the numbers of all their rows."""
    held, own = {ROOT: np.arange(len(residual))}, {ROOT: np.flatnonzero(trains)}
    largest = int(np.abs(residual).max(initial=0)) * len(residual)
    if largest >= 1 << 62:
        raise OverflowError("Sums of residuals may not fit into 64 bits.")
    width, wide = int(codes.max(initial=0)) + 1, largest >= 1 << 53
    totals = {ROOT: (int(residual[own[ROOT]].sum()), len(own[ROOT]))}
    cuts: dict[int, tuple[int, int]] = {}
    cells: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[float, int, tuple]] = []

    def offer(node: int, found: tuple[np.ndarray, np.ndarray]) -> None:
        split = _best_split(*found, least_rows)
        if split:
            cells[node] = found
            heapq.heappush(heap, (-split[0], node, split))

    if limit > 1 and len(codes):
        offer(ROOT, _histogram(codes, residual, own[ROOT], width, wide))
    while heap and len(cuts) < limit - 1:
        _, node, (_, feature, upto, left, left_rows) = heapq.heappop(heap)
        cuts[node] = (feature, upto)
        children = (2 * node, 2 * node + 1)
        for rows_of in (held, own):
            rows = rows_of.pop(node)
            goes = codes[feature, rows] <= upto
            rows_of |= dict(zip(children, (rows[goes], rows[~goes])))
        total, rows = totals.pop(node)
        totals |= dict(zip(children, ((left, left_rows), (total - left, rows - left_rows))))
        whole = cells.pop(node)
        if len(cuts) == limit - 1:
            break  # a tree's last split needs no histograms of its children
        # The larger child holds what the smaller one does not.
        small = min(children, key=lambda v: totals[v][1])
        found = _histogram(codes, residual, own[small], width, wide)
        offer(small, found)
        offer(children[0] + children[1] - small, (whole[0] - found[0], whole[1] - found[1]))
    return cuts, totals, held


def _fit_here(
    codes: np.ndarray, label: np.ndarray, trains: np.ndarray, base: int, fit: Fit,
    least_rows: int, iterations: int, stages: Sequence[int],
) -> tuple[list[str], list[float | None]]:
    """Cuts and leaves of every tree of a fit as JSON, and the mean absolute error after each stage."""
    if int(np.abs(label).max(initial=0)) * SCALE >= 1 << 62:
        raise OverflowError("Labels may not fit into 64 bits.")
    score, grown, errors = np.full(len(label), base, np.int64), [], []
    scored = np.flatnonzero(~trains)
    for number in range(1, iterations + 1):
        cuts, totals, held = _grow_here(codes, label * SCALE - score, trains, fit.leaves, least_rows)
        for node, rows in held.items():
            score[rows] += leaf_value(*totals[node], fit.rate)
        grown.append(json.dumps([[[v, *cut] for v, cut in cuts.items()], [[v, *t] for v, t in totals.items()]]))
        ends = number in stages and len(scored)
        errors.append(float(np.abs(score[scored].astype(np.float64) / SCALE - label[scored]).mean()) if ends else None)
    return grown, errors


def _fit_in_tasks(
    state: DataFrame, fits: Sequence[Fit], bases: Mapping[int, int], least_rows: int, iterations: int, stages: Sequence[int]
) -> list:
    """Rows (fit, number, tree, mae) of all fits, in order; each fit is grown in a task of its own."""
    ship_package(state.sparkSession)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        i, n = rows.column("fit")[0].as_py(), len(rows)
        flat = rows.column("bins").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        codes = np.ascontiguousarray(flat.reshape(n, -1).T.astype(np.int16))
        label, trains = (rows.column(c).to_numpy() for c in ("label", "trains"))
        grown, errors = _fit_here(codes, label, trains.astype(bool), bases[i], fits[i], least_rows, iterations, stages)
        numbers = pa.array(range(1, len(grown) + 1), pa.int32())
        return pa.table({
            "fit": pa.array([i] * len(grown), pa.int32()), "number": numbers, "tree": pa.array(grown, pa.string()),
            "mae": pa.array(errors, pa.float64()),
        })

    # Eight partitions a fit: adaptive execution does not pack them, and few hold two fits.
    dealt = state.repartition(8 * len(fits), "fit").groupBy("fit")
    done = dealt.applyInArrow(run, "fit int, number int, tree string, mae double")
    return sorted(done.collect(), key=lambda r: (r["fit"], r["number"]))


# --- models ----------------------------------------------------------------------


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: base and, per tree, nodes of (feature, least value to the right, value)."""

    features: tuple[str, ...]
    base: int
    trees: tuple[dict[int, tuple[int, float, int]], ...]

    def first(self, trees: int) -> BoostedTrees:
        """The model after its first trees."""
        return BoostedTrees(self.features, self.base, self.trees[:trees])

    def transform(self, df: DataFrame, column: str = "prediction") -> DataFrame:
        """Add predictions, walked along the trees in built-in expressions."""
        packed = json.dumps([{str(v): {"f": f, "x": x, "y": y} for v, (f, x, y) in t.items()} for t in self.trees])
        model = F.from_json(F.lit(packed), "array<map<string, struct<f: int, x: double, y: bigint>>>")
        values = F.array(*[F.col(c).cast("double") for c in self.features])
        depth = max([v.bit_length() for t in self.trees for v in t], default=0)

        def step(tree, node):
            here = F.element_at(tree, node.cast("string"))
            right = F.when(F.get(values, here["f"]) >= here["x"], 1).otherwise(0)
            return F.when(here["f"] < 0, node).otherwise(node * 2 + right)

        def value(tree):
            leaf = F.aggregate(F.sequence(F.lit(0), F.lit(depth)), F.lit(ROOT).cast("long"), lambda node, _: step(tree, node))
            return F.element_at(tree, leaf.cast("string"))["y"]

        total = F.aggregate(model, F.lit(self.base).cast("long"), lambda sum_, tree: sum_ + value(tree))
        return df.withColumn(column, total.cast("double") / SCALE)


@dataclass(frozen=True)
class Boosted:
    """Outcome of a run: models and per fit the mean absolute error after each stage asked for."""

    models: list[BoostedTrees]
    errors: dict[tuple[int, int], float]
    leaves: list[list[dict[int, tuple[int, int]]]]  # per fit and tree: leaf -> (rows, value)


def boost(
    rows: DataFrame,
    fits: Sequence[Fit],
    features: Sequence[str],
    iterations: int,
    stages: Sequence[int] = (),
    label: str = "Actual_Demand",
    least_rows: int = LEAST_ROWS,
    rows_per_task: int = 0,
) -> Boosted:
    """Fit all models at once; `rows` has Month, the label and the features.

    Bins are cut once, on all rows, and shared by the fits. If no fit has more than
    `rows_per_task` rows, each is grown in a task of its own. Otherwise all grow in shared
    passes, and every iteration is written to the shared folder, which cuts its lineage.
    """
    rows = materialize(rows.select("Month", *dict.fromkeys([label, *features])), "boosting-rows")
    borders = bin_borders(rows, features)
    data = binned(rows, features, borders).select("Month", F.col(label).cast("bigint").alias("label"), "bins")
    wanted = _small(data, [(i, f.until, f.last) for i, f in enumerate(fits)], "fit until last")
    month, until = F.col("Month"), F.col("until")
    copied = data.withColumn("fit", F.explode(F.sequence(F.lit(0), F.lit(len(fits) - 1)))).join(wanted, "fit")
    inside = until.isNull() | (month < until) | (month <= F.col("last"))
    state = copied.filter(inside).select("fit", "label", "bins", (until.isNull() | (month < until)).alias("trains"))
    state = materialize(state, "boosting-state")
    sizes = state.groupBy("fit").agg(
        F.sum(F.when(F.col("trains"), F.col("label"))).alias("total"),
        F.count_if("trains").alias("rows"), F.count(F.lit(1)).alias("held"), F.count("label").alias("labelled"),
    ).collect()
    bases = {r["fit"]: rounded_share(r["total"] * SCALE, r["rows"]) for r in sizes if r["rows"]}
    if len(bases) < len(fits):
        raise ValueError("Every fit needs rows to train on.")
    state = state.withColumn("score", F.get(_numbers(bases[i] for i in range(len(fits))), F.col("fit")))
    grown: list[list[dict]] = [[] for _ in fits]
    leaves: list[list[dict]] = [[] for _ in fits]
    errors: dict[tuple[int, int], float] = {}

    def record(i: int, cuts: Mapping[int, tuple[int, int]], totals: Mapping[int, tuple[int, int]]) -> dict[int, int]:
        values = {v: leaf_value(*total, fits[i].rate) for v, total in totals.items()}
        grown[i].append({v: (f, borders[f][b], 0) for v, (f, b) in cuts.items()} | {v: (-1, 0.0, y) for v, y in values.items()})
        leaves[i].append({v: (totals[v][1], y) for v, y in values.items()})
        return values

    in_tasks = all(r["held"] == r["labelled"] <= rows_per_task for r in sizes)
    for r in _fit_in_tasks(state, fits, bases, least_rows, iterations, stages) if in_tasks else ():
        cuts, totals = json.loads(r["tree"])
        record(r["fit"], {v: (f, b) for v, f, b in cuts}, {v: (total, rows) for v, total, rows in totals})
        if r["mae"] is not None:
            errors[r["fit"], r["number"]] = r["mae"]
    for number in () if in_tasks else range(1, iterations + 1):
        state = state.withColumn("residual", F.col("label") * SCALE - F.col("score"))
        trees = _grow(state, fits, least_rows)
        gains: dict[tuple[int, int], int] = {}
        for i, tree in enumerate(trees):
            last = [v for v in tree.totals if v not in tree.chosen and (v == ROOT or v // 2 in tree.chosen)]
            values = record(i, {v: tree.splits[v][1:3] for v in tree.chosen}, {v: tree.totals[v] for v in last})
            gains |= {(i, v): values[tree.leaf_of(v)] for v in tree.totals if v not in tree.grown}
        held = state.withColumn("leaf", _leaf(trees))
        moved = held.withColumn("score", F.col("score") + _by_node(trees, gains, F.col("leaf")))
        state = materialize(moved.select("fit", "label", "bins", "trains", "score"), "boosting-state")
        if number in stages:
            off = F.abs(F.col("score").cast("double") / SCALE - F.col("label"))
            for r in state.filter("not trains").groupBy("fit").agg(F.avg(off).alias("mae")).collect():
                errors[r["fit"], number] = r["mae"]
    models = [BoostedTrees(tuple(features), bases[i], tuple(grown[i])) for i in range(len(fits))]
    return Boosted(models, errors, leaves)
