"""Line deduplication: a segment-partition edit join over the distinct lines of a corpus.

If two lines differ by at most t edits, and one is cut into t + 1 segments, at least one
segment is found unchanged in the other: segment i at its distance from the left end,
shifted by at most i, or at its distance from the right end, shifted by at most t - i.
Lines are dealt into classes of neighbouring lengths, and a class fixes where its segments
are, so that one key per segment serves lines of different lengths. A line less than t
characters above the least length of its class is entered in the class below as well. So
each line is entered under its segments, and meets other lines there or with those few
substrings that lie next to a middle segment. Pairs with a key in common are then checked
by banded bit-parallel edit distance: one bit per diagonal of the band, one step per
character, all in 64-bit columns.

Keys carry the line's 64-bit hash, which names it, and a digest of its length and letter
counts. An edit changes these by two in all at most, so pairs whose counts differ by more
than 2 t never leave the join. Equal lines are one line from the start. Everything is
built-in expressions, explodes and joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.llm.common import blocks, join_checked, materialize, need, numbered_rows, scratch_scope

EDITS = 2
# Shorter lines are compared for equality alone: two edits would change their meaning.
NEAR_CHARS = 24
PAIRS_PER_TASK = 2000
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
# Lengths that share a class, and so the places of their segments.
CLASS_CHARS = 8
# What a tag holds, modulo 8 in three bits each, 63 bits in all: length and letter counts.
LETTERS = "enaitrsoldhucmpgbfvw"
LETTER_BITS = 3
COUNTS = 1 << LETTER_BITS


# --- edit distance ---------------------------------------------------------------


def bind(value: Column, use) -> Column:
    """`use(value)` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def within_edits(longer: Column, shorter: Column, edits: int) -> Column:
    """Whether two texts are at most `edits` insertions, deletions or replacements apart.

    `longer` has at least as many characters as `shorter`, and at most `edits` more.
    Bit b of the vectors stands for the cell b - edits rows off the main diagonal; `up`
    and `down` say where a cell is one more or one less than the one above it. The
    distance is followed along the diagonal that ends in the last cell.
    """
    spelt = F.struct(F.split(longer, "").alias("longer"), F.split(shorter, "").alias("shorter"))
    # Bound once: an optimizer that moves this filter can't make a step split the texts anew.
    return bind(spelt, lambda s: _within(s["longer"], s["shorter"], edits))


def _within(longer: Column, shorter: Column, edits: int) -> Column:
    """`within_edits` of two arrays of characters."""
    width = 2 * edits + 1
    full = F.lit((1 << width) - 1).cast("long")
    ahead = F.size(longer) - F.size(shorter)
    goal = F.call_function("shiftleft", F.lit(1).cast("long"), ahead + edits)

    def equal(char: Column, place: Column) -> Column:
        """Bits of the band's cells whose two characters are the same."""
        same = F.lit(0).cast("long")
        for b in range(width):
            here = F.get(longer, place - edits + b) == char
            same = same.bitwiseOR(F.when(here, F.lit(1 << b)).otherwise(F.lit(0)).cast("long"))
        return same

    def advance(state: Column, same: Column) -> Column:
        up, down = state["up"], state["down"]
        carried = (same.bitwiseAND(up) + up).bitwiseXOR(up)
        # cells that cost nothing more than their diagonal predecessor
        free = carried.bitwiseOR(same).bitwiseOR(down).bitwiseAND(full)
        return bind(free, lambda free: next_column(state, free))

    def next_column(state: Column, free: Column) -> Column:
        up, down = state["up"], state["down"]
        right_up = down.bitwiseOR(full.bitwiseXOR(free.bitwiseOR(up)))
        right_down = free.bitwiseAND(up)
        moved = F.shiftright(free, 1)  # the band is one row lower in the next column
        return F.struct(
            right_down.bitwiseOR(full.bitwiseXOR(moved.bitwiseOR(right_up))).alias("up"),
            moved.bitwiseAND(right_up).alias("down"),
            (state["cost"] + F.when(free.bitwiseAND(goal) == 0, 1).otherwise(0)).cast("long").alias("cost"),
        )

    start = F.struct(
        F.lit(((1 << width) - 1) - ((1 << edits) - 1)).cast("long").alias("up"),
        F.lit(0).cast("long").alias("down"),
        ahead.cast("long").alias("cost"),
    )
    last = F.aggregate(F.transform(shorter, equal), start, advance)
    return last["cost"] <= edits


# --- segments --------------------------------------------------------------------


def _segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """Start (from 1) and length of each of edits + 1 segments, the longer ones last."""
    n = edits + 1
    longer = length % n
    base = ((length - longer) / n).cast("int")
    found, start = [], F.lit(1)
    for i in range(n):
        size = base + F.when(F.lit(n - i) <= longer, 1).otherwise(0)
        found.append((start.cast("int"), size.cast("int")))
        start = start + size
    return found


def _classes(length: Column, edits: int, least: int) -> tuple[Column, Column, Column]:
    """Least length of the line's class and of the class below, and whether the line is in both."""
    width = max(CLASS_CHARS, edits)
    above = (length - least) % width
    own = (length - above).cast("int")
    return own, (own - width).cast("int"), (own > least) & (above < edits)


def _key(number: int, base: Column, part: Column) -> Column:
    return F.xxhash64(F.lit(number), base, part)


def _in_classes(line: Column, length: Column, edits: int, least: int, shifts) -> Column:
    """Keys of the segments at their own places moved by `shifts(i)`, in each class of the line."""
    def keys(base: Column) -> Column:
        found = []
        for i, (start, size) in enumerate(_segments(base, edits)):
            # the end that fewer edits can lie before
            at = start if i <= edits - i else start + length - base
            for shift in shifts(i):
                place = at + shift
                fits = (place >= 1) & (place + size - 1 <= length)
                found.append(F.when(fits, _key(i, base, F.substring(line, place, size))))
        return F.array(*found).cast("array<bigint>")

    own, below, both = _classes(length, edits, least)
    return F.when(both, F.concat(keys(own), keys(below))).otherwise(keys(own))


def entry_keys(line: Column, length: Column, edits: int, least: int = 1) -> Column:
    """One key per segment and class of the line, which has `least` characters or more."""
    return _in_classes(line, length, edits, least, lambda i: (0,))


def shifted_keys(line: Column, length: Column, edits: int, least: int = 1, back: bool = True) -> Column:
    """The keys that segments of a near line may have next to their own places; some may be null.

    Without `back` only those further on. That is enough for up to two edits if both
    lines look for each other: if neither the first nor the last segment is unchanged,
    there is an edit in each, and what lies between them is moved one place on in one
    line as seen from the other.
    """
    def shifts(i: int) -> list[int]:
        most = min(i, edits - i)
        return [d for d in range(-most if back else 1, most + 1) if d]

    return _in_classes(line, length, edits, least, shifts)


def probe_keys(line: Column, length: Column, edits: int, least: int = 1) -> Column:
    """All keys under which lines at most `edits` apart may be entered."""
    return F.concat(entry_keys(line, length, edits, least), shifted_keys(line, length, edits, least))


def with_tag(df: DataFrame, line: str = "line") -> DataFrame:
    """Add `tag`, the length and letter counts of a line; different lines may well share one."""
    size = F.octet_length(line)
    tag = F.length(line).bitwiseAND(F.lit(COUNTS - 1)).cast("long")
    for letter in LETTERS:
        count = size - F.octet_length(F.replace(F.col(line), F.lit(letter), F.lit("")))
        tag = F.shiftleft(tag, LETTER_BITS).bitwiseOR(count.bitwiseAND(F.lit(COUNTS - 1)).cast("long"))
    return df.withColumn("tag", tag)


def _field_gap(one: Column, two: Column, place: int) -> Column:
    """By how much one count of two tags differs at least; place 0 is the last letter."""
    def counted(tag: Column) -> Column:
        return F.shiftrightunsigned(tag, LETTER_BITS * place).bitwiseAND(F.lit(COUNTS - 1))

    d = F.abs(counted(one) - counted(two))
    return F.least(d, COUNTS - d)  # counts go round


def _length_gap(one: Column, two: Column) -> Column:
    """By how much the lengths of two tags differ at least."""
    return _field_gap(one, two, len(LETTERS))


def _count_gap(one: Column, two: Column) -> Column:
    """By how much the length and the letter counts of two tags differ at least."""
    gap = F.lit(0)
    for place in range(len(LETTERS) + 1):
        gap = gap + _field_gap(one, two, place)
    return gap


# --- the join --------------------------------------------------------------------


def _occurrences(rows: DataFrame) -> DataFrame:
    """(key, uid, pos, line, h1, h2) of every line with a word, from rows (key, uid, text)."""
    lines = rows.select("key", "uid", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    worded = lines.filter(F.col("line").rlike(WORD_CHARACTER))
    return worded.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")})


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Plan without whole-stage code while the block runs.

    A line's keys make one generated method of more bytecode than the JVM compiles;
    projections on their own are split into methods that it does compile.
    """
    name = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _keyed(rows: DataFrame, edits: int, near_chars: int) -> DataFrame:
    """All lines without their text: place, hashes, and for long ones tag, entry and shifted keys."""
    lines = _occurrences(rows).withColumn("length", F.length("line"))
    line, length, long = F.col("line"), F.col("length"), F.col("length") >= near_chars
    return with_tag(lines).select(
        "key", "uid", "pos", "h1", "h2", "tag",
        F.when(long, entry_keys(line, length, edits, near_chars)).alias("entries"),
        F.when(long, shifted_keys(line, length, edits, near_chars, edits > 2)).alias("shifted"),
    )


def near_links(rows: DataFrame, keyed: DataFrame, repeated: DataFrame, edits: int = EDITS) -> DataFrame:
    """(earlier, later) lines at most `edits` apart, each a struct of key, uid, pos, h1 and h2.

    `rows` has key, uid and text, `keyed` their lines, and `repeated` the first occurrence
    (key, uid, pos) of lines that occur more than once, by h1 and h2.
    """
    known = join_checked(keyed.filter("entries is not null"), repeated, ["h1", "h2"], "left")
    distinct = known.filter(F.col("first").isNull() | (F.struct("key", "uid", "pos") == F.col("first")))

    def keys(kind: str, name: str) -> DataFrame:
        """Each line once per key, its hash named `name`."""
        return distinct.select(F.explode(kind).alias("k"), F.col("h1").alias(name), F.col("tag").alias(f"{name}_tag"))

    one, two = F.col("one_tag"), F.col("two_tag")
    alike = (_length_gap(one, two) <= edits) & (_count_gap(one, two) <= 2 * edits)
    # The entries are shuffled once: all three uses read the same exchange.
    straight = keys("entries", "one").join(keys("entries", "two"), "k").filter((F.col("one") < F.col("two")) & alike)
    shifted = keys("entries", "one").join(keys("shifted", "two"), "k").filter((F.col("one") != F.col("two")) & alike)
    met = straight.unionByName(shifted)
    pairs = materialize(
        met.select(F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two")).distinct(), "line-pairs"
    )
    names = pairs.select(F.col("one").alias("h1")).unionByName(pairs.select(F.col("two").alias("h1"))).distinct()
    slim = distinct.select("key", "uid", "pos", "h1", "h2")
    places = materialize(join_checked(slim, materialize(names, "line-names"), ["h1"]), "line-places")
    spelt = join_checked(rows.select("uid", "text"), places, ["uid"]).select(
        "key", "uid", "pos", "h1", "h2", F.get(F.split("text", "\n"), F.col("pos")).alias("line")
    )
    texts = materialize(spelt, "line-texts")

    def side(name: str) -> DataFrame:
        return texts.select(F.col("h1").alias(name), F.struct("key", "uid", "pos", "h1", "h2", "line").alias(f"{name}_line"))

    both = pairs.join(side("one"), "one").join(side("two"), "two").select("one_line", "two_line")
    # The check is long for few bytes: deal pairs out by number and not by size.
    both = both.repartition(blocks(pairs.count(), PAIRS_PER_TASK, 12))
    longer_first = F.length("one_line.line") >= F.length("two_line.line")
    ordered = both.select(
        "one_line", "two_line",
        F.when(longer_first, F.col("one_line.line")).otherwise(F.col("two_line.line")).alias("longer"),
        F.when(longer_first, F.col("two_line.line")).otherwise(F.col("one_line.line")).alias("shorter"),
    )
    near = F.length("longer") - F.length("shorter") <= edits
    linked = ordered.filter(F.when(near, within_edits(F.col("longer"), F.col("shorter"), edits)).otherwise(F.lit(False)))
    one, two = (F.struct(*[F.col(f"{s}_line.{c}") for c in ("key", "uid", "pos", "h1", "h2")]) for s in ("one", "two"))
    return linked.select(F.least(one, two).alias("earlier"), F.greatest(one, two).alias("later")).distinct()


def dedup_lines(
    docs: DataFrame,
    edits: int = EDITS,
    near_chars: int = NEAR_CHARS,
    id_column: str = "doc_id",
    text_column: str = "text",
    report: str | None = "lines",
) -> DataFrame:
    """Remove every line that repeats an earlier one, exactly or up to `edits` edits.

    Lines are split at the line feed and ordered by document id (missing ids last) and
    place. Of equal lines the first stays. A line of `near_chars` or more characters
    also goes, in all its places, if an earlier line is at most `edits` apart, whether
    that one stays or not. Lines without a word always stay.

    Returns every row of `docs` with all its columns, the text shortened, and a struct
    column named `report` (it replaces a column of that name; none if None): n_lines, removed_exact,
    removed_near and n_links (pairs of different lines at most `edits` apart in which
    lines of the text take part). Null texts stay null. Rows with the same id, or
    without one, are documents of their own in the order of reading. An empty table gives
    an empty result.
    """
    need(docs, (id_column, text_column))
    with scratch_scope(docs.sparkSession) as keep:
        # It lies beside the shuffles of every step, so it is packed more tightly.
        whole = keep(numbered_rows(docs, id_column, text_column, "zstd"))
        rows = whole.select("key", "uid", F.coalesce("text", F.lit("")).alias("text"))
        with small_methods(docs.sparkSession):
            seen = materialize(_keyed(rows, edits, near_chars), "lines")
        first = seen.groupBy("h1", "h2").agg(F.min(F.struct("key", "uid", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
        repeated = materialize(first.filter("n > 1").drop("n"), "repeated-lines")
        links = materialize(near_links(rows, seen, repeated, edits), "line-links")
        ends = links.select(F.col("earlier").alias("end"), F.lit(False).alias("near")).unionByName(
            links.select(F.col("later").alias("end"), F.lit(True).alias("near"))
        )
        linked = ends.groupBy("end.h1", "end.h2").agg(F.max("near").alias("near"), F.count(F.lit(1)).alias("links"))
        notes = repeated.join(linked, ["h1", "h2"], "full")
        noted = join_checked(seen.select("key", "uid", "pos", "h1", "h2"), materialize(notes, "line-notes"), ["h1", "h2"])
        near = F.coalesce("near", F.lit(False))
        again = F.coalesce(F.struct("key", "uid", "pos") != F.col("first"), F.lit(False))
        marked = noted.select(
            "uid", "pos", near.alias("near"), (again & ~near).alias("again"), F.coalesce("links", F.lit(0)).alias("links")
        )
        by_document = marked.groupBy("uid").agg(
            F.collect_list(F.when(F.col("near") | F.col("again"), F.col("pos"))).alias("gone"),
            F.collect_list(F.when(F.col("near"), F.col("pos"))).alias("gone_near"),
            F.sum("links").alias("links"),
        )
        marks = keep(materialize(by_document, "line-marks"))
    # Only the slim side is hashed. At no size are the marks sent to every task: they grow with the corpus.
    joined = whole.join(marks.hint("shuffle_hash"), "uid", "left")
    none = F.array().cast("array<int>")
    located = joined.withColumns({
        "parts": F.split("text", "\n"), "out": F.coalesce("gone", none), "out_near": F.coalesce("gone_near", none)
    })
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("out"))
    text = F.when(
        F.size("out") > 0, F.array_join(F.transform(kept, lambda i: F.get("parts", i)), "\n")
    ).otherwise(F.col("text"))
    counts = F.struct(
        F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("n_lines"),
        (F.size("out") - F.size("out_near")).cast("long").alias("removed_exact"),
        F.size("out_near").cast("long").alias("removed_near"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )
    same = [text.alias(c) if c == text_column else F.col(f"rest.`{c}`") for c in docs.columns if c != report]
    return located.select(*same, *([counts.alias(report)] if report else []))
