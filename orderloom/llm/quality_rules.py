"""Quality rules: a threshold table compiled into one projection of text ratios.

Every measure is a built-in Spark expression over the row's own text, so scoring is one
scan without a shuffle and without user functions. A rule bounds a ratio of two counts in
whole percent; it is compared by multiplication, in whole numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import need

# White space and symbols of the measures below.
SPACE = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
NOT_CAPITAL = r"[^\p{Lu}]+"

# Frequent function words, by language.
STOP_WORDS = (
    # English
    "a", "and", "as", "at", "be", "by", "for", "in", "is", "it", "not", "of", "on", "that", "the", "this",
    "to", "was", "with",
    # French
    "au", "aux", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "par", "pas", "pour",
    "que", "qui", "un", "une",
    # German
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "ist", "mit", "nicht", "sich", "und",
    "von", "zu",
    # Spanish
    "con", "del", "el", "los", "para", "por", "se", "su", "y",
)

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """`of` must be between `least` and `most` percent of `base`; None leaves a side open."""

    name: str
    of: str
    base: str
    least: int | None = None
    most: int | None = None

    def broken(self) -> Column:
        share, whole = F.col(self.of) * 100, F.col(self.base)
        tests = []
        if self.least is not None:
            tests.append(share < whole * self.least)
        if self.most is not None:
            tests.append(share > whole * self.most)
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]


# The rules every text has to pass first: at least ten words, and at most a fifth of them
# in five-word windows that the text repeats.
BASE_RULES = (
    Rule("few_words", "n_words", "one", least=10 * 100),
    Rule("repeated_windows", "n_repeat_words", "n_words", most=20),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", least=300, most=1200),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("capitals", "n_capitals", "word_chars", most=40),
    Rule("stop_words", "n_stop_words", "n_words_past_20", least=4),
    Rule("repeated_neighbours", "n_neighbours", "n_words", most=20),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=40),
)


def measure(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Add the counts that the rules compare; all are long.

    Words are runs of other characters than blank and U+0009 to U+000D. Lines are split
    at the line feed, and only lines with a word count. `n_repeat_words` is the number
    of words that lie in a window of five words found twice or more in the text;
    windows are compared by 64-bit hash.
    """
    def at(i, k):
        return F.get("_hashes", i + k)

    text = F.coalesce(F.col(text_column), F.lit(""))
    worded = docs.withColumns(
        {
            "_words": F.array_remove(F.split(text, SPACE), ""),
            "_lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_CHARACTER)),
            "n_symbols": F.length(F.regexp_replace(text, NOT_SYMBOL, "")).cast("long"),
            "n_capitals": F.length(F.regexp_replace(text, NOT_CAPITAL, "")).cast("long"),
        }
    )
    counted = worded.withColumns(
        {
            "one": F.lit(1).cast("long"),
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(*STOP_WORDS))).cast("long"),
            "n_words_past_20": F.greatest(F.size("_words") - 20, F.lit(0)).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        }
    ).drop("_words", "_lines")
    last = F.size("_hashes") - WINDOW
    windowed = counted.withColumns(
        {
            "n_neighbours": F.size(
                F.filter("_hashes", lambda h, i: (i > 0) & (h == F.get("_hashes", i - 1)))
            ).cast("long"),
            "_windows": F.when(
                last >= 0,
                F.transform(
                    F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                    lambda i: F.xxhash64(*(at(i, k) for k in range(WINDOW))),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("_hashes")
    # Only texts that repeat a window at all pay for sorting windows with their places.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    placed = windowed.withColumn(
        "_sorted",
        F.when(
            repeats, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ).otherwise(nothing),
    )

    def twice(x, k):
        before, after = F.get("_sorted", k - 1), F.get("_sorted", k + 1)
        return ((k > 0) & (before["h"] == x["h"])) | F.coalesce(after["h"] == x["h"], F.lit(False))

    starts = placed.withColumn(
        "_starts", F.array_sort(F.transform(F.filter("_sorted", twice), lambda x: x["i"]))
    )
    # Each repeated window covers its own words up to the start of the next one.
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda start, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - start, F.lit(WINDOW))),
        ),
        F.lit(0).cast("long"),
        lambda total, words: total + words,
    )
    return starts.withColumn("n_repeat_words", covered).drop("_windows", "_sorted", "_starts")


MEASURES = (
    "one", "n_words", "word_chars", "n_symbols", "n_capitals", "n_stop_words", "n_words_past_20", "n_lines", "n_dup_lines",
    "n_neighbours", "n_repeat_words",
)


def judge(docs: DataFrame, text_column: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add the struct column `quality`: the measures, base_failed, kept and the names of broken rules.

    Null and empty texts have no word and fail the base rules. Nothing is dropped, every
    other column stays as it is (a column named `quality` is replaced), and repeated rows
    are judged alike; an empty table gives an empty result.
    """
    need(docs, (text_column,))
    # The text travels beside the row, so that no column of the caller can clash.
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text_column).alias("_text"))
    measured = measure(inner, "_text")

    def names(of):
        return F.array_join(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in of]), ",")

    base = F.lit(False)
    for rule in BASE_RULES:
        base = base | rule.broken()
    judged = measured.withColumn("base_failed", base).withColumn("failed", names((*BASE_RULES, *rules)))
    quality = F.struct(
        *MEASURES[1:], "base_failed", (F.col("failed") == "").alias("kept"), F.col("failed").alias("failed_rules")
    )
    keep = [F.col(f"_row.`{c}`") for c in docs.columns if c != "quality"]
    return judged.select(*keep, quality.alias("quality"))


def select_clean(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of `docs` that every rule keeps, with their own columns."""
    columns = [F.col(f"_all.`{c}`") for c in docs.columns]
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"), F.col(text_column).alias("_read")
    )
    # The row number keeps the filter above the measures: pushed below, it would repeat them all.
    judged = judge(whole, "_read").select("_all", "quality.kept", F.monotonically_increasing_id().alias("_number"))
    return judged.filter(F.col("kept") & (F.col("_number") >= 0)).select(*columns)
