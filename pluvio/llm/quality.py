"""Quality classifier: regularised quadratic discriminant analysis.

A document is described by the statistics of :mod:`pluvio.llm.features`,
standardised over the labelled rows. Each class is a Gaussian. Its
covariance is shrunk towards the pooled covariance of the classes, then
towards that one's diagonal. The raw score is the difference of the two log densities,
each from a Mahalanobis distance by forward substitution with a Cholesky
factor that is computed once, plus the log prior ratio. A logistic curve
fitted on the training scores turns it into a probability.

Training reads every labelled row: the moments are sums that Spark takes
over all of them (two rows reach the driver), and the curve is fitted on a
histogram of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import free_prefix, others, staged
from pluvio.llm.features import NAMES, statistics

TO_POOLED, TO_DIAGONAL = 0.5, 0.1
THRESHOLD = 0.3
#: The histogram that the curve is fitted on.
BINS, REACH = 800, 100.0


@dataclass(frozen=True)
class Discriminant:
    """A fitted model; with ``factors`` empty, every score is ``constant``."""

    constant: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: tuple = ()
    factors: tuple = ()
    offsets: tuple = ()
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0, priors included."""
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            # factor is the inverse of the Cholesky factor: distance = |factor (z - mean)|^2
            density.append(offset - 0.5 * np.square((z - mean) @ factor.T).sum(axis=1))
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -500, 500)))


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: count, mean, covariance."""
    d = len(NAMES)
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(d)],
        *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]).collect()
    made = {}
    for r in sums:
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        second = np.zeros((d, d))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"] / r["n"]
        made[int(r["quality"])] = (r["n"], mean, second - np.outer(mean, mean))
    return made


def _discriminant(moments: dict) -> Discriminant:
    total = sum(n for n, _, _ in moments.values())
    if set(moments) != {0, 1}:
        return Discriminant(constant=0.5 if not total else float(1 in moments))
    prior = {c: moments[c][0] / total for c in moments}
    centre = sum(prior[c] * moments[c][1] for c in moments)
    variance = sum(prior[c] * (np.diag(moments[c][2]) + (moments[c][1] - centre) ** 2) for c in moments)
    scale = np.sqrt(np.maximum(variance, 1e-12))
    inside = {c: moments[c][2] / np.outer(scale, scale) for c in moments}
    pooled = sum(prior[c] * inside[c] for c in moments)
    means, factors, offsets = [], [], []
    for c in (0, 1):
        shrunk = (1 - TO_POOLED) * inside[c] + TO_POOLED * pooled
        shrunk = (1 - TO_DIAGONAL) * shrunk + TO_DIAGONAL * np.diag(np.diag(pooled)) + 1e-6 * np.eye(len(scale))
        factor = np.linalg.cholesky(shrunk)
        means.append((moments[c][1] - centre) / scale)
        factors.append(np.linalg.inv(factor))
        offsets.append(float(np.log(prior[c]) - np.log(np.diag(factor)).sum()))
    return Discriminant(prior[1], centre, scale, tuple(means), tuple(factors), tuple(offsets))


def _curve(margins: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve; counts: (bins, 2) by class.

    Targets are drawn in by one count, so a perfect separation has a finite
    curve; fitted by damped Newton steps on the scaled margin.
    """
    n0, n1 = counts.sum(axis=0)
    goal = (counts[:, 0] / (n0 + 2) + counts[:, 1] * (n1 + 1) / (n1 + 2)) / np.maximum(counts.sum(axis=1), 1)
    weight = counts / np.array([n0, n1]) / 2  # both classes count alike: the cut lies between them
    weight = weight.sum(axis=1)
    design = np.stack([margins / 10, np.ones_like(margins)], axis=1)
    beta, ridge = np.array([1.0, 0.0]), 1e-6

    def loss(b: np.ndarray) -> float:
        z = design @ b
        return float((weight * (np.logaddexp(0, z) - goal * z)).sum() + ridge * (b @ b))

    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        slope = design.T @ (weight * (p - goal)) + 2 * ridge * beta
        curve = (design.T * (weight * p * (1 - p))) @ design + 2 * ridge * np.eye(2)
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(beta - size * step) > loss(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(beta[0] / 10), float(beta[1])


def _statistics(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield part.map(statistics)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from; a row without id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _x(text_col: str, x_col: str | None) -> Column:
    """The statistics of a row: its column ``x_col``, or else those of its text (null counts as empty)."""
    return F.col(x_col) if x_col else F.pandas_udf(_statistics, "array<double>")(F.coalesce(F.col(text_col), F.lit("")))


def described(docs: DataFrame, text_col: str = "text", out: str = "x") -> DataFrame:
    """``docs`` without the text, with its statistics as ``out``: computed once,
    written, and read to fit and to score (as ``x_col``). Null texts count as empty."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return staged(docs.select(*kept, _x(text_col, None).alias(out)), "described")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        x_col: str | None = None) -> Discriminant:
    """Learn ``labels.quality`` (0 or 1; other values and null are no labels)
    from all rows of ``docs`` that are labelled and not held out.

    Repeated rows count as often as they are there. With no labels the model
    scores 0.5, with one class only that class.
    """
    marks = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality"))
             .where("quality in (0, 1)").where(~held_out(F.col("id"))))
    known = docs.select(F.col(id_col).alias("id"), _x(text_col, x_col).alias("x"))
    rows = staged(known.where(~held_out(F.col("id"))).join(marks, "id").select("quality", "x"), "training")
    model = _discriminant(_moments(rows))
    if not model.factors:
        return model

    @F.pandas_udf("int")
    def bin_of(x: pd.Series) -> pd.Series:
        at = (model.margin(np.stack(x)) / REACH + 1) / 2 * BINS
        return pd.Series(np.clip(at, 0, BINS - 1).astype(np.int32))

    counts = np.zeros((BINS, 2))
    for r in rows.groupBy(bin_of("x").alias("bin"), "quality").count().collect():  # at most 2 * BINS rows
        counts[r["bin"], r["quality"]] = r["count"]
    margins = ((np.arange(BINS) + 0.5) / BINS * 2 - 1) * REACH
    slope, shift = _curve(margins, counts)
    return Discriminant(**{**model.__dict__, "slope": slope, "shift": shift})


def score(docs: DataFrame, model: Discriminant, text_col: str = "text", x_col: str | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 if the score is at least 0.3). Reads only the text, or the
    statistics of it that ``x_col`` holds and that are then dropped; null and
    empty texts are scored as texts without words. Input columns of these two
    names are replaced; an empty table stays empty."""

    @F.pandas_udf("double")
    def scored(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in rows:
            made = list(part) if x_col else [statistics(t) for t in part]
            yield pd.Series(model.score(np.array(made, float).reshape(len(part), len(NAMES))))

    at = free_prefix(docs, "_quality_score_")
    made = docs.withColumn(at, scored(F.col(x_col) if x_col else F.coalesce(F.col(text_col), F.lit(""))))
    return made.select(*others(made, ["score", "predicted", at, *([x_col] if x_col else [])]), F.col(at).alias("score"),
                       (F.col(at) >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their
    columns, whatever they are called. Null and empty texts are judged like
    any other, repeated rows alike; an empty table stays empty."""
    rows = described(docs.select("doc_id", "text", F.struct("*").alias("row")))
    return score(rows, fit(rows, labels, x_col="x"), x_col="x").where("predicted = 1").select("row.*")
