"""Best-fit packing of tokenised documents into sequences of a fixed length.

Best-fit decreasing looks at nothing but lengths, and there are at most `capacity` of
those. So the corpus is reduced to a histogram of piece lengths (at most `capacity`
rows, at any corpus size); the histogram is packed with a segment tree over remaining
capacities, equal pieces in equally filled sequences being placed as one run. The
result, a plan of runs, says for "the r-th piece of length n" which sequence and offset
it gets. Every piece then finds its place by its number among the pieces of its length,
which Spark hands out in parallel. The plan equals best-fit decreasing done document by
document over the whole corpus.
"""

from __future__ import annotations

import array
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.bpe import Bpe, tokenizer_text
from orderloom.llm.common import blocks, dense_ids, materialize, need

PIECE_ROWS_PER_BLOCK = 50_000


# --- planning over lengths -------------------------------------------------------


class CapacityTree:
    """A segment tree over remaining capacities that finds the tightest open one."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, remaining: int, bins: int) -> None:
        node = remaining + self.leaves
        while node:
            self.open[node] += bins
            node >>= 1

    def tightest(self, size: int) -> int | None:
        """The least remaining capacity of at least `size` that an open bin has."""
        node = size + self.leaves
        if self.open[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


@dataclass(frozen=True)
class Run:
    """Pieces first_rank.. of one length, `per_bin` each into the bins first_bin.. from `offset` on."""

    length: int
    first_rank: int
    pieces: int
    first_bin: int
    per_bin: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Run]:
    """Runs that pack `counts[n]` pieces of each length n by best-fit decreasing.

    The tightest fitting bin stays the tightest while it has room, so it takes as many
    equal pieces as fit before the next bin of its remaining capacity is looked at.
    """
    tree, groups = CapacityTree(capacity), defaultdict(list)
    runs, bins = [], 0

    def reopen(remaining: int, first: int, count: int) -> None:
        if remaining and count:
            tree.add(remaining, count)
            groups[remaining].append((first, count))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, first = capacity, bins
                count = -(-left // (capacity // length))
                bins += count
            else:
                first, count = groups[remaining].pop()
                tree.add(remaining, -count)
            each = remaining // length
            full = min(count, left // each)
            parts = [(first, full, each)]
            if full < count and left > full * each:
                parts.append((first + full, 1, left - full * each))
            used = 0
            for at, n, per_bin in parts:
                if n:
                    runs.append(Run(length, rank, n * per_bin, at, per_bin, capacity - remaining))
                    reopen(remaining - per_bin * length, at, n)
                    rank, left, used = rank + n * per_bin, left - n * per_bin, used + n
            reopen(remaining, first + used, count - used)
    return runs


# --- tokenising ------------------------------------------------------------------


class FastBpe(Bpe):
    """The same ids with a compiled merge loop for words that the caches do not have."""

    def __init__(self, file_text: str):
        import tiktoken

        super().__init__(file_text)
        special = set(self.special.values())
        ranks = {b: i for i, b in enumerate(self.bytes_of) if b and i not in special}
        core = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self._core = core.encode_ordinary

    def _encode_piece(self, piece: str) -> bytes:
        words, core = self.words(piece), self._core
        if len(words) == 1:
            return array.array("I", core(piece)).tobytes()
        return array.array("I", [i for word in words for i in core(word)]).tobytes()


_LOADED: dict[int, FastBpe] = {}


def _loaded(file_text: str) -> FastBpe:
    key = hash(file_text)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = FastBpe(file_text)
    return _LOADED[key]


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece: only the first may be shorter than the capacity."""
    first = tokens % capacity or min(tokens, capacity)
    return [(0, first), *((s, capacity) for s in range(first, tokens, capacity))] if tokens else []


PIECES = "id {kind}, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """One row per piece of each document's ids followed by `end_id`."""
    file = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))
    end = array.array("I", [end_id]).tobytes()
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(file.value)
        for batch in batches:
            owner, number, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = np.frombuffer(bpe.encode_bytes(text or "") + end, np.uint32).astype("<u4").tobytes()
                for k, (at, size) in enumerate(cut(len(ids) // 4, capacity)):
                    owner.append(row)
                    number.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(number, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return slim.mapInArrow(run, PIECES.format(kind=kind))


# --- packing ---------------------------------------------------------------------


def place(numbered: DataFrame, runs: list[Run], rank_column: str) -> DataFrame:
    """Add sequence_id and offset to pieces numbered within their length."""
    by_length = defaultdict(list)
    for run in runs:
        by_length[run.length].append(run)
    # The plan has a few runs per length, however many pieces there are.
    plan = {
        length: (np.array([(r.first_rank, r.first_bin, r.per_bin, r.offset) for r in own], np.int64))
        for length, own in by_length.items()
    }
    shared = numbered.sparkSession.sparkContext.broadcast(plan)
    fields = numbered.schema.fieldNames()
    at_length, at_rank = fields.index("length"), fields.index(rank_column)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(at_length).to_numpy(zero_copy_only=False)
            ranks = batch.column(at_rank).to_numpy(zero_copy_only=False)
            bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                table, rank = shared.value[int(length)], ranks[rows]
                first, first_bin, per_bin, offset = table[np.searchsorted(table[:, 0], rank, "right") - 1].T
                bins[rows] = first_bin + (rank - first) // per_bin
                offsets[rows] = offset + (rank - first) % per_bin * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bins), pa.array(offsets)], names=[*fields, "sequence_id", "offset"]
            )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields)
    return numbered.mapInArrow(locate, f"{types}, sequence_id long, offset long")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pack every document into sequences of at most `capacity` ids.

    Returns (id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.
    A document is its ids and then `end_id`, so a null or empty text is one id long.
    Longer documents than a sequence are cut, the first piece being the shorter one.
    Repeated rows and null ids are packed like any other row; equal lengths take their
    places in an arbitrary order; an empty table packs into nothing. Other columns of
    `docs` are not read.
    """
    need(docs, (id_column, text_column))
    cut_up = materialize(pieces(docs, tokenizer, capacity, end_id, id_column, text_column), "pieces")
    counts = {r["length"]: r["count"] for r in cut_up.groupBy("length").count().collect()}
    n_blocks = blocks(sum(counts.values()), PIECE_ROWS_PER_BLOCK, 64)
    numbered = dense_ids(cut_up, "length", ["id", "piece", "ids_crc32"], "rank", n_blocks)
    placed = place(numbered, best_fit_decreasing(counts, capacity), "rank")
    return placed.select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
