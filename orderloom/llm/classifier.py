"""A quality classifier: regularised quadratic discriminant analysis of text statistics.

Each document becomes a short vector of transformed statistics, all built-in expressions.
Training sums counts, values and products per class in one aggregation, so it uses every
labelled row at any size and brings two rows to the driver. There each class covariance is
shrunk towards the pooled one and towards a sphere, and factored once by Cholesky. Scoring
is the difference of the two Mahalanobis log densities, again one built-in expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import materialize, need
from orderloom.llm.quality_rules import measure

# Weight of the pooled covariance, and then of the sphere, in each class covariance.
POOLED, SPHERE = 0.1, 0.02
FEATURES = (
    "log_words", "word_length", "symbols", "capitals", "stop_words", "lines", "dup_lines", "neighbours",
    "repeated", "log_line_words",
)


@dataclass(frozen=True)
class Discriminant:
    """Per class: log prior, mean, inverse Cholesky factor and log determinant of the covariance."""

    priors: tuple[float, float]
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    logdets: tuple[float, float]


def features(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Add the array column `x` to rows (id, text): one double per name in FEATURES.

    Null and empty texts have no word; every statistic of theirs is 0.
    """
    measured = measure(docs, text_column)

    def share(of: str, base: str) -> Column:
        return F.sqrt(F.coalesce(F.try_divide(F.col(of).cast("double"), F.col(base).cast("double")), F.lit(0.0)))

    values = {
        "log_words": F.log1p("n_words"),
        "word_length": F.log1p(F.coalesce(F.try_divide(F.col("word_chars").cast("double"), F.col("n_words")), F.lit(0.0))),
        # past one symbol a word, more of them say nothing new
        "symbols": F.least(share("n_symbols", "n_words"), F.lit(1.0)),
        "capitals": share("n_capitals", "word_chars"),
        "stop_words": share("n_stop_words", "n_words"),
        "lines": share("n_lines", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "neighbours": share("n_neighbours", "n_words"),
        "repeated": share("n_repeat_words", "n_words"),
        "log_line_words": F.log1p(F.coalesce(F.try_divide(F.col("n_words").cast("double"), F.col("n_lines")), F.lit(0.0))),
    }
    return measured.select(*docs.columns, F.array(*[values[name].cast("double") for name in FEATURES]).alias("x"))


def fit(labelled: DataFrame, label_column: str = "label", pooled: float = POOLED, sphere: float = SPHERE) -> Discriminant | float:
    """Fit to rows (x, label); labels other than 0 and 1 are ignored.

    If a class has fewer than two rows, the share of label 1 (one half without any row)
    is returned: the score of every document then.
    """
    p = len(FEATURES)
    x = [F.get("x", F.lit(i)) for i in range(p)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(p) for j in range(i + 1)]
    found = {
        r[label_column]: r
        for r in labelled.filter(F.col(label_column).isin(0, 1)).groupBy(label_column).agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()
    }
    counts = [found[k]["n"] if k in found else 0 for k in (0, 1)]
    if min(counts) < 2:
        return counts[1] / sum(counts) if sum(counts) else 0.5
    means, covariances = [], []
    for k in (0, 1):
        row, n = found[k], counts[k]
        mean = np.array([row[f"s{i}"] for i in range(p)]) / n
        second = np.array([[row[f"p{max(i, j)}_{min(i, j)}"] for j in range(p)] for i in range(p)]) / n
        means.append(mean)
        covariances.append(second - np.outer(mean, mean))
    shared = (counts[0] * covariances[0] + counts[1] * covariances[1]) / sum(counts)
    factors, logdets = [], []
    for c in covariances:
        shrunk = (1 - pooled) * c + pooled * shared
        shrunk = (1 - sphere) * shrunk + sphere * max(np.trace(shrunk) / p, 1e-9) * np.eye(p)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        logdets.append(2 * float(np.log(np.diag(lower)).sum()))
    priors = tuple(float(np.log(n / sum(counts))) for n in counts)
    return Discriminant(priors, tuple(means), tuple(factors), tuple(logdets))


def _log_density(model: Discriminant, k: int) -> Column:
    """Log density of `x` in class k, up to a constant, plus the log prior."""
    away = [F.get("x", F.lit(i)) - F.lit(float(m)) for i, m in enumerate(model.means[k])]
    distance = F.lit(0.0)
    for i, row in enumerate(model.factors[k]):
        part = sum((F.lit(float(row[j])) * away[j] for j in range(i + 1)), F.lit(0.0))
        distance = distance + part * part
    return F.lit(model.priors[k] - model.logdets[k] / 2) - distance / 2


def score(vectors: DataFrame, model: Discriminant | float) -> DataFrame:
    """Add `score` from 0 to 1 to rows with `x`: higher means that label 1 is likelier."""
    if isinstance(model, float):
        return vectors.withColumn("score", F.lit(model))
    both = vectors.withColumns({"l0": _log_density(model, 0), "l1": _log_density(model, 1)})
    gap = F.greatest(F.least(F.col("l0") - F.col("l1"), F.lit(700.0)), F.lit(-700.0))
    return both.withColumn("score", 1 / (1 + F.exp(gap))).drop("l0", "l1")


def classify(
    docs: DataFrame, labels: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality"
) -> DataFrame:
    """(id, held_out, score), one row per row of `docs`.

    `held_out` is an expression over the id column; labels of such documents are not
    learnt from. Labels without a document, null labels and null ids teach nothing; a
    label that is given twice counts twice. Null and empty texts get a score like any
    other. An empty table gives an empty result, and other columns are not read.
    """
    need(docs, (id_column, text_column))
    need(labels, (id_column, label_column))
    plain = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    vectors = materialize(features(plain).select(F.col("id").alias(id_column), "x"), "features")
    known = labels.select(F.col(id_column), F.col(label_column).alias("label")).filter(~held_out)
    model = fit(vectors.join(known, id_column).select("x", "label"))
    return score(vectors, model).select(id_column, held_out.alias("held_out"), "score")
