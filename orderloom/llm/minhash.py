"""Near-duplicate documents by DartMinHash signatures, banded joining and exact checks.

Each weighted element (a word shingle) owns a plane of weight by rank on which hashed
darts land, one per unit of area. A text of total weight W looks at the darts below its
elements' weights with rank up to about k (ln k + 4) / W, throws each into one of k
coordinates by hash and keeps the dart of least rank per coordinate. Two texts agree in
a coordinate with the probability of their weighted Jaccard similarity. The cost is a
few hash values per element plus the darts, not k values per element.

Bands of five coordinates make candidates at similarity 0.8 with a probability above
0.9999; every link is then checked exactly on shingle sets. Equal texts are one node from
the start. A bucket's nodes are first compared with its leader alone, the node that meets
the most others in all its buckets: of an original and its edited copies, which resemble
each other less than the original, that is the original. Where a bucket then still holds
several classes, its nodes are joined by their rarest shingles. Two sets of a and b
shingles with similarity s share s / (1 + s) * (a + b) of them, so the first shingle they
have in common, in order of frequency, has that many behind it in both. What an edit
changed is rare and comes first, so copies that are too unlike to be linked seldom meet,
and no linked pair is lost. Nodes of one class are not compared any more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import document_key, join_checked, materialize, need, scratch_scope
from orderloom.llm.graph import components
from orderloom.llm.shingles import groups, mix, shingle_sets

BANDS, ROWS = 26, 5
SIMILARITY = 0.8
# The first rank interval; further ones double. Wider is less to hash and more to throw.
FIRST_INTERVAL = 0.25
WORD_CHARACTER = r"[^\x20\x09-\x0D]"


# --- signatures ------------------------------------------------------------------


@lru_cache(maxsize=64)
def _poisson(area: float) -> np.ndarray:
    """Distribution function of the number of darts in a region of this area."""
    top = int(area + 12 * math.sqrt(area) + 24)
    terms = [math.exp(n * math.log(area) - area - math.lgamma(n + 1)) for n in range(top)]
    return np.cumsum(terms)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _darts(seeds: np.ndarray, weights: np.ndarray, level: int, interval: int):
    """(element index, rank, dart hash) in one rank interval and one level of weight.

    Level 0 covers weights from 0 to 1, level n from 2^(n-1) to 2^n; an element sees the
    darts below its own weight.
    """
    low, high = (0.0, 1.0) if level == 0 else (2.0 ** (level - 1), 2.0**level)
    start = 0.0 if interval == 0 else FIRST_INTERVAL * 2.0 ** (interval - 1)
    length = FIRST_INTERVAL if interval == 0 else start
    region = mix(seeds + np.uint64((level << 8 | interval) * 0x632BE59BD9B4E019 % (1 << 64)))
    counts = np.searchsorted(_poisson((high - low) * length), _unit(region), "right")
    element = np.repeat(np.arange(len(seeds)), counts)
    nth = np.arange(len(element)) - np.repeat(np.cumsum(counts) - counts, counts)
    dart = mix(region[element] + (nth.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F))
    rank = start + length * _unit(dart)
    if level or (weights < 1).any():
        height = low + (high - low) * _unit(mix(dart ^ np.uint64(0x2545F4914F6CDD1D)))
        below = height < weights[element]
        element, rank, dart = element[below], rank[below], dart[below]
    return element, rank, dart


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, texts: int, k: int) -> np.ndarray:
    """A (texts, k) array of dart hashes; rows of texts without elements are 0.

    `owner` is the sorted number of the text of each weighted element.
    """
    best = np.full(texts * k, np.inf)
    found = np.zeros(texts * k, np.uint64)
    totals = np.bincount(owner, weights, texts)
    wanted = k * (math.log(k) + 4)
    with np.errstate(divide="ignore"):
        reach = np.where(totals > 0, wanted / totals, 0.0)
    intervals = np.where(totals > 0, 1 + np.ceil(np.log2(np.maximum(reach / FIRST_INTERVAL, 1))), 0).astype(int)
    levels = 1 + np.ceil(np.log2(np.maximum(weights, 1))).astype(int)
    done = np.zeros(texts, int)
    while (done < intervals).any():
        for interval in range(int(intervals.max())):
            due = ((interval < intervals) & (interval >= done))[owner]
            for level in range(int(levels[due].max()) if due.any() else 0):
                rows = np.flatnonzero(due & (levels > level))
                element, rank, dart = _darts(elements[rows], weights[rows], level, interval)
                place = owner[rows[element]] * k + (mix(dart ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(k)).astype(np.int64)
                np.minimum.at(best, place, rank)
                least = rank == best[place]
                found[place[least]] = dart[least]
        done = intervals.copy()
        # A coordinate that no dart has met yet: look twice as far in that text.
        empty = (np.isinf(best).reshape(texts, k).any(axis=1)) & (totals > 0)
        intervals[empty] += 1
    return found.reshape(texts, k)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band of `rows` coordinates, different for different bands."""
    parts = signature[:, : bands * rows].reshape(-1, bands, rows)
    total = np.arange(1, bands + 1, dtype=np.uint64)[None, :].repeat(len(parts), 0)
    for r in range(rows):
        total = mix(total * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, r])
    return total.view(np.int64)


def _sign(docs: DataFrame, weighted: bool, bands: int, rows: int) -> DataFrame:
    """(key, digest, bands, weight) of rows (key, digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed, totals = [], []
            for _, data in groups(batch.column(2).to_pylist()):
                owner, elements, counts = shingle_sets(data)
                weights = counts.astype(float) if weighted else np.ones(len(counts))
                signed = signatures(owner, elements, weights, len(data), bands * rows)
                hashed.append(band_hashes(signed, bands, rows))
                totals.append(np.bincount(owner, weights, len(data)))
            flat = np.concatenate(hashed).ravel() if hashed else np.zeros(0, np.int64)
            offsets = pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
            weight = pa.array(np.concatenate(totals) if totals else np.zeros(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists, weight], names=["key", "digest", "bands", "weight"]
            )

    return docs.mapInArrow(run, "key long, digest binary, bands array<long>, weight double")


def _sets(texts: DataFrame, weighted: bool) -> DataFrame:
    """(node, shingles) of rows (node, text), and the shingles' counts if weighted."""
    counted = ", counts array<int>" if weighted else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in groups(batch.column(1).to_pylist()):
                owner, elements, counts = shingle_sets(data)
                offsets = pa.array(np.searchsorted(owner, np.arange(len(data) + 1)).astype(np.int32))
                columns = {
                    "node": batch.column(0).slice(first, len(data)),
                    "shingles": pa.ListArray.from_arrays(offsets, pa.array(elements.view(np.int64))),
                }
                if weighted:
                    columns["counts"] = pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return texts.mapInArrow(run, f"node long, shingles array<long>{counted}")


# --- linking ---------------------------------------------------------------------


def text_digest(text: Column) -> Column:
    """128 bits of the text; null and blank texts count as empty."""
    worded = F.when(text.rlike(WORD_CHARACTER), text).otherwise(F.lit(""))
    return F.unhex(F.md5(worded.cast("binary")))


def _similarity(weighted: bool) -> Column:
    """Jaccard similarity of the two shingle sets of a pair, by count if weighted."""
    if not weighted:
        common = F.size(F.array_intersect("a.shingles", "b.shingles"))
        return common / (F.size("a.shingles") + F.size("b.shingles") - common)
    one, two = (F.map_from_arrays(F.col(f"{s}.shingles"), F.col(f"{s}.counts")) for s in "ab")
    least = F.aggregate(
        F.map_values(F.map_zip_with(one, two, lambda k, x, y: F.least(F.coalesce(x, F.lit(0)), F.coalesce(y, F.lit(0))))),
        F.lit(0), lambda total, n: total + n,
    )
    both = sum(F.aggregate(f"{s}.counts", F.lit(0), lambda total, n: total + n) for s in "ab")
    return least / (both - least)


def _links(pairs: DataFrame, sets: DataFrame, similarity: float, weighted: bool) -> DataFrame:
    """Of pairs (a, b) of nodes those at least so similar."""
    held = F.struct(*[c for c in sets.columns if c != "node"])
    one = sets.select(F.col("node").alias("a"), held.alias("one"))
    two = sets.select(F.col("node").alias("b"), held.alias("two"))
    joined = pairs.join(one, "a").join(two, "b")
    checked = joined.select("a", "b", F.struct(F.col("one").alias("x"), F.col("two").alias("y")).alias("p"))
    named = checked.select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("p.x").alias("a"), F.col("p.y").alias("b"))
    return named.filter(_similarity(weighted) >= similarity).select(F.col("u").alias("a"), F.col("v").alias("b"))


def _leaders(members: DataFrame) -> DataFrame:
    """(bucket, leader, leader_weight): the node of each bucket that meets the most others."""
    best = F.max(F.struct("score", (-F.col("node")).alias("minus"), "weight")).alias("best")
    chosen = members.groupBy("bucket").agg(best)
    return chosen.select("bucket", (-F.col("best.minus")).alias("leader"), F.col("best.weight").alias("leader_weight"))


def _open_nodes(members: DataFrame, leaders: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label) of the nodes of buckets where others than the leader are of several classes."""
    labelled = _relabel(members.select("bucket", "node", F.col("node").alias("label")), "label", labels)
    others = labelled.join(leaders, "bucket").filter("node != leader")
    spread = others.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_ = materialize(spread.filter("low != high").select("bucket"), "open-buckets")
    return others.join(open_, "bucket", "left_semi").select("node", "label").distinct()


def rare_pairs(nodes: DataFrame, sets: DataFrame, similarity: float, weighted: bool) -> DataFrame:
    """(a, b) of nodes (node, label) with different labels whose sets may be so similar.

    Holds every pair that is. Of a counted shingle each occurrence is an element of its
    own. An element that only one node has can't be in common, so it only moves the others
    back. Per element all nodes meet those that are not of its most common label, as two
    of that label need no comparison.
    """
    held = nodes.join(sets, "node")
    if weighted:
        both = held.select("node", "label", F.explode(F.arrays_zip("shingles", "counts")).alias("z"))
        times = both.select("node", "label", "z.shingles", F.explode(F.sequence(F.lit(1), F.col("z.counts"))).alias("nth"))
        flat = times.select("node", "label", F.xxhash64("shingles", "nth").alias("element"))
    else:
        flat = held.select("node", "label", F.explode("shingles").alias("element"))
    flat = materialize(flat, "elements")
    sizes = flat.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
    common = flat.groupBy("element").agg(
        F.count(F.lit(1)).alias("frequency"), F.min("label").alias("low"), F.max("label").alias("high")
    ).filter("frequency > 1")
    # Elements within one class find nothing new, but they keep their places in the order.
    placed = flat.join(common.select("element", "frequency", (F.col("low") != F.col("high")).alias("useful")), "element")
    ranked = placed.groupBy("node", "label").agg(F.sort_array(F.collect_list(F.struct("frequency", "element", "useful"))).alias("found"))
    first = F.col("size") - F.size("found")
    reach = F.col("size") - F.ceil(similarity * F.col("size") - 1e-9) + 1 - first
    rows = ranked.join(sizes, "node").withColumns({"first": first, "reach": reach}).filter("reach > 0")
    rows = rows.select(
        "node", "label", "size", "first", F.posexplode(F.slice("found", 1, F.col("reach").cast("int"))).alias("nth", "found")
    ).filter("found.useful")
    rows = materialize(
        rows.select("found.element", "node", "label", "size", (F.col("size") - F.col("first") - F.col("nth")).alias("behind")),
        "rare-elements",
    )
    counted = rows.groupBy("element", "label").agg(F.count(F.lit(1)).alias("n"))
    usual = counted.groupBy("element").agg(F.max(F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("labels"))
    usual = usual.filter("labels > 1").select("element", F.col("most.label").alias("usual"))
    few = rows.join(usual, "element").filter("label != usual").drop("usual")
    needed = F.ceil(similarity / (1 + similarity) * (F.col("x.size") + F.col("y.size")) - 1e-9)
    alike = (F.col("x.label") != F.col("y.label")) & (F.least("x.behind", "y.behind") >= needed)
    met = rows.alias("x").join(few.alias("y"), (F.col("x.element") == F.col("y.element")) & alike)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def classes(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    weighted: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(key, digest, number, class_id, class_size, copies, kept), one row per row of `docs`.

    Two texts are linked when the Jaccard similarity of their five-word shingles is at
    least `similarity` (of shingle counts if `weighted`); classes are the connected
    components. `key` is the id (a missing one as the largest long), `class_id` the
    smallest key in the class, and `copies` the number of rows with this key and text.
    Exactly one row of each class is `kept`: of the rows with the smallest key those with
    the smallest digest, and of repeated rows the first by `number`. Ids may repeat or
    be missing: rows that share one are of one class only if their texts are linked.
    Equal texts are always one class; so are all null, empty and blank texts.
    An empty table gives an empty result, and other columns are not read.
    """
    need(docs, (id_column, text_column))
    slim = docs.select(document_key(id_column).alias("key"), text_digest(F.col(text_column)).alias("digest"), F.col(text_column).alias("text"))
    with scratch_scope(docs.sparkSession) as keep:
        signed = _sign(slim, weighted, bands, rows).withColumn("number", F.monotonically_increasing_id())
        signed = keep(materialize(signed, "signatures"))
        nodes = materialize(
            signed.groupBy("digest")
            .agg(F.min("key").alias("first"), F.first("bands").alias("bands"), F.first("weight").alias("weight"))
            .withColumn("node", F.monotonically_increasing_id()),
            "nodes",
        )
        in_bands = nodes.select("node", "weight", F.explode("bands").alias("bucket"))
        shared = in_bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        together = materialize(in_bands.join(materialize(shared, "buckets"), "bucket"), "together")
        scores = materialize(together.groupBy("node").agg(F.sum("size").alias("score")), "scores")
        members = materialize(together.join(scores, "node").select("bucket", "node", "weight", "score"), "members")
        wanted = materialize(
            scores.select("node").join(nodes.select("node", "digest", F.col("first").alias("key")), "node"), "candidates"
        )
        texts = join_checked(slim, wanted, ["key", "digest"]).select("node", "text")
        sets = materialize(_sets(texts, weighted).dropDuplicates(["node"]), "shingle-sets")
        leaders = materialize(_leaders(members), "leaders")
        lighter, heavier = F.least("weight", "leader_weight"), F.greatest("weight", "leader_weight")
        guided = members.join(leaders, "bucket").filter((F.col("node") != F.col("leader")) & (lighter >= similarity * heavier))
        pairs = guided.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
        linked = materialize(_links(pairs, sets, similarity, weighted), "links")
        labels = materialize(components(linked, "a", "b"), "leader-labels")
        open_ = materialize(_open_nodes(members, leaders, labels), "open-nodes")
        linked = _links(materialize(rare_pairs(open_, sets, similarity, weighted), "rare-pairs"), sets, similarity, weighted)
        for side in "ab":
            linked = _relabel(linked, side, labels)
        merged = components(materialize(linked.filter("a != b"), "late-links"), "a", "b")
        labels = materialize(_merge(labels, merged), "labels")
        whole = nodes.select("digest", "first", "node", F.col("node").alias("label"))
        whole = materialize(_relabel(whole, "label", labels), "labelled")
        sizes = signed.groupBy("digest", "key").agg(F.count(F.lit(1)).alias("copies"), F.min("number").alias("first_number"))
        held = signed.groupBy("digest").agg(F.count(F.lit(1)).alias("held"))
        weighed = whole.join(materialize(held, "held"), "digest")
        # A class is named by a row of its own: other classes may have the same smallest key.
        named = weighed.groupBy("label").agg(F.min(F.struct("first", "digest")).alias("head"), F.sum("held").alias("class_size"))
        by_digest = keep(materialize(
            whole.join(materialize(named, "classes"), "label").select("digest", "head", "class_size"), "digests"
        ))
        copies = keep(materialize(sizes, "copies"))
    rows_ = signed.select("key", "digest", "number").join(by_digest, "digest").join(copies, ["digest", "key"])
    leads = (F.col("key") == F.col("head.first")) & (F.col("digest") == F.col("head.digest"))
    return rows_.select(
        "key", "digest", "number", F.col("head.first").alias("class_id"), "class_size", "copies",
        (leads & (F.col("number") == F.col("first_number"))).alias("kept"),
    )


def _relabel(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """Replace labels that were merged into smaller ones."""
    renamed = labels.select(F.col("node").alias(column), F.col("component").alias("_to"))
    return df.join(renamed, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to").select(*df.columns)


def _merge(labels: DataFrame, merged: DataFrame) -> DataFrame:
    """Labels of both comparisons: the earlier ones followed on, and the new ones."""
    earlier = _relabel(labels, "component", merged)
    new = merged.join(labels.select("node"), "node", "left_anti")
    return earlier.unionByName(new)


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """One row of `docs` of each class: of those with the smallest id the one with the smallest digest.

    Rows without an id come after all others. Of rows with the same id and text any one
    stays, as one document.
    """
    id_column, text_column = settings.get("id_column", "doc_id"), settings.get("text_column", "text")
    columns = [F.col(f"_row.`{c}`") for c in docs.columns]
    with scratch_scope(docs.sparkSession) as keep:
        first = keep(materialize(classes(docs, **settings).filter("kept").select("key", "digest", "copies"), "first"))
    whole = docs.select(
        document_key(id_column).alias("key"),
        text_digest(F.col(text_column)).alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    kept = join_checked(whole, first, ["key", "digest"])
    single = kept.filter("copies = 1").select(*columns)
    repeated = kept.filter("copies > 1").dropDuplicates(["key", "digest"]).select(*columns)
    return single.unionByName(repeated)
