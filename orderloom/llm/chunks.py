"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes; its value over the last 22 bytes decides which
word starts are chunk borders. Borders therefore depend on nothing but the text right
before them, and an insertion moves only the borders it touches. Chunks are a few words
long; from each border on, as many whole chunks as make up `min_words` words are one
variable span with one digest. A span that an earlier document, or an earlier place of
the same document, has too is cut out. Overlapping spans cover a repeated passage from
its first border to its last.

All spans are compared over the whole corpus. A first pass ships 64-bit digests alone
and finds those that occur twice; a second pass ships the full 128-bit digest and place
of the spans that may repeat.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import materialize, need, numbered_rows, scratch_scope
from orderloom.llm.shingles import _BYTES, _powers, groups, mix

MIN_WORDS = 12
# A word start is a border if these bits of the gear hash are 0: one in four.
BORDER_BITS = np.uint32(0b11 << 20)
# Bytes between two texts of a group: longer than the hash looks back.
GAP = b"\0" * 32

_GEAR = np.random.Generator(np.random.PCG64(29)).integers(0, 1 << 32, 256, np.uint32)
_OTHER_BYTES = np.random.Generator(np.random.PCG64(31)).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of the last 32 bytes' gear values, each shifted by its distance.

    That is h = (h << 1) + gear[byte] rolled along, worked out by doubling the reach.
    """
    h = _GEAR[data]
    for reach in (1, 2, 4, 8, 16):
        h[reach:] = h[reach:] + (h[:-reach] << np.uint32(reach))
    return h


def spans(data: Sequence[bytes], min_words: int) -> tuple[np.ndarray, ...]:
    """(text number, start, end, digest, second digest) of all spans of a group of texts.

    Start and end count bytes from the text's own beginning.
    """
    joined = np.frombuffer(GAP + GAP.join(data) + GAP, np.uint8)
    sizes = np.array([len(d) for d in data])
    begins = np.cumsum(sizes + len(GAP)) - sizes
    space = (joined == 32) | ((joined >= 9) & (joined <= 13)) | (joined == 0)
    starts_word = np.zeros(len(joined) + 1, bool)
    starts_word[1:-1] = space[:-1] & ~space[1:]
    starts_word[:-1] |= (joined >= 0xE3) & (joined < 0xF8)  # scripts written without blanks
    hashed = gear_hash(joined)
    border = starts_word.copy()
    border[1:] &= (hashed & BORDER_BITS) == 0
    border[begins] = border[begins + sizes] = True
    places = np.flatnonzero(border)
    words = np.concatenate([[0], np.cumsum(starts_word)])[places]
    owner = np.searchsorted(begins, places, "right") - 1
    text_end = begins[owner] + sizes[owner]
    until = np.searchsorted(words, words + min_words, "left")
    inside = until < len(places)
    end = places[np.minimum(until, len(places) - 1)]
    good = inside & (places < text_end) & (end <= text_end)
    owner, start, end = owner[good], places[good], end[good]
    _powers.reach(len(joined) + 1)
    digests = []
    for table in (_BYTES, _OTHER_BYTES):
        sums = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(table[joined] * _powers.up[: len(joined)], out=sums[1:])
        digests.append(mix((sums[end] - sums[start]) * _powers.down[start] + (end - start).astype(np.uint64)))
    return owner, start - begins[owner], end - begins[owner], *digests


def _emit(docs: DataFrame, min_words: int, places: bool) -> DataFrame:
    """Digest of each span, and if asked for also its row's key and uid, its second digest and place.

    `place` is twice the start, and odd if the text has the span earlier on as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data in groups(batch["text"].to_pylist()):
                owner, start, _, digest, other = spans(data, min_words)
                columns = {"digest": digest.view(np.int64)}
                if places:
                    order = np.lexsort((start, other, digest, owner))
                    same = np.zeros(len(owner), bool)
                    a, b = order[:-1], order[1:]
                    same[b] = (owner[a] == owner[b]) & (digest[a] == digest[b]) & (other[a] == other[b])
                    columns |= {c: batch[c].slice(first, len(data)).to_numpy()[owner] for c in ("key", "uid")}
                    columns |= {"other": other.view(np.int64), "place": 2 * start.astype(np.int64) + same}
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=[*columns])

    more = ", key long, uid long, other long, place long" if places else ""
    return docs.mapInArrow(run, f"digest long{more}")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(uid, digest, place, first_key) of the spans to cut, from rows (key, uid, text).

    `first_key` is the smallest key of a document that has the span.
    """
    seen = _emit(docs, min_words, False).groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    twice = materialize(seen.filter("n > 1").select("digest"), "repeated-digests")
    held = materialize(_emit(docs, min_words, True).join(twice, "digest"), "repeated-spans")
    first = held.groupBy("digest", "other").agg(F.min(F.struct("key", "uid")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.filter("n > 1").drop("n"), "first-spans")
    later = (F.struct("key", "uid") > F.col("first")) | (F.col("place") % 2 == 1)
    return held.join(first, ["digest", "other"]).filter(later).select(
        "uid", "digest", "place", F.col("first.key").alias("first_key")
    )


def _cut(data: bytes, marked: set[tuple[int, int]], min_words: int) -> tuple[str, int, int]:
    """The text without its marked spans, the bytes cut out, and the number of gaps."""
    _, start, end, digest, _ = spans([data], min_words)
    kept, at, gaps, digests = [], 0, 0, digest.view(np.int64)
    for s, e, d in zip(start.tolist(), end.tolist(), digests.tolist()):
        if (s, d) in marked:
            if s > at or not gaps:
                kept.append(data[at:s])
                gaps += 1
            at = max(at, e)
    kept.append(data[at:])
    text = b"".join(kept)
    return text.decode(), len(data) - len(text), gaps


def dedup_substrings(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    report: str | None = "repeats",
) -> DataFrame:
    """Cut from each text the spans that an earlier document, or it itself, has before.

    Returns every row of `docs` with all its columns, the text shortened, and a struct
    column named `report` (it replaces a column of that name; none if None): removed_bytes,
    removed_spans and first_ids, the sorted ids of documents whose spans were met again.

    Documents are ordered by id; those without an id come last. Rows with the same
    id, or without one, are documents of their own in the order of reading. Null texts
    stay null, empty ones empty, and a text of fewer than `min_words` words is
    never changed. An empty table gives an empty result.
    """
    need(docs, (id_column, text_column))
    with scratch_scope(docs.sparkSession) as keep:
        rows = keep(numbered_rows(docs, id_column, text_column))
        slim = rows.select("key", "uid", F.coalesce("text", F.lit("")).alias("text"))
        found = repeated_spans(slim, min_words)
        spot = F.struct(F.shiftright("place", 1).alias("start"), "digest", "first_key")
        by_document = keep(materialize(found.groupBy("uid").agg(F.collect_set(spot).alias("marks")), "marks"))
    marked = rows.join(by_document, "uid", "left")
    shape = marked.select("rest").schema["rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cut, gaps, firsts = [], [], [], []
            for text, marks in zip(batch["text"].to_pylist(), batch["marks"].to_pylist()):
                if marks and text:
                    text, size, n = _cut(text.encode(), {(m["start"], m["digest"]) for m in marks}, min_words)
                    texts.append(text)
                    cut.append(size)
                    gaps.append(n)
                    firsts.append(sorted({m["first_key"] for m in marks}))
                else:
                    texts.append(text)
                    cut.append(0)
                    gaps.append(0)
                    firsts.append([])
            repeats = pa.StructArray.from_arrays(
                [pa.array(cut, pa.int64()), pa.array(gaps, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
                names=["removed_bytes", "removed_spans", "first_ids"],
            )
            yield pa.RecordBatch.from_arrays(
                [batch["rest"], pa.array(texts, pa.string()), repeats], names=["rest", "text", "repeats"]
            )

    kind = "struct<removed_bytes:bigint,removed_spans:bigint,first_ids:array<bigint>>"
    done = marked.select("text", "rest", "marks").mapInArrow(run, f"rest {shape}, text string, repeats {kind}")
    columns = [F.col("text").alias(c) if c == text_column else F.col(f"rest.`{c}`") for c in docs.columns if c != report]
    return done.select(*columns, *([F.col("repeats").alias(report)] if report else []))
