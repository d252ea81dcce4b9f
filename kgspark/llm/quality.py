"""A quality classifier: regularised quadratic discriminant analysis on transformed document statistics.

Each class has a mean and a covariance, shrunk towards the pooled covariance and towards its own scaled identity.
A score is the logistic of the difference of two log densities: half the difference of the squared Mahalanobis lengths,
by triangular solves with Cholesky factors computed once, plus log determinants and log priors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm.common import cut, ship, text_or_empty

#: Byte classes counted for every text: marks that prose rarely has, table bars, sentence marks, digits, capitals, letters.
CLASSES = {
    "odd": b"#$%&*+<=>@\\^_`{}~[]/", "bar": b"|", "shout": b"!?", "stop": b".,;:", "digit": b"0123456789",
    "capital": bytes(range(65, 91)), "small": bytes(range(97, 123)), "line": b"\n", "white": b" \t\r\x0b\x0c",
}
FEATURES = ("length", "odd", "bar", "shout", "stop", "digit", "capital", "line", "word_length", "word_spread", "variety", "repeats", "same_lines")
SIZE = len(FEATURES)


def _logit(part: float, whole: float, usual: float, weight: float = 30.0) -> float:
    """Log odds of a share, drawn towards a usual one as if ``weight`` more had been seen: short texts stay near it."""
    return float(np.log((part + weight * usual) / (whole - part + weight * (1 - usual))))


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text; the empty text has defined values too."""
    raw = text.encode("utf-8", "surrogatepass")
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n = {k: int(seen[list(v)].sum()) for k, v in CLASSES.items()}
    words = text.split()
    lines = text.split("\n")
    size = len(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=size)
    kinds = len(set(words))
    repeats = sum(map(str.__eq__, words[1:], words)) if size > 1 else 0
    black = max(len(raw) - n["white"] - n["line"], 0)
    letters = n["capital"] + n["small"]
    length = (sizes.sum() + 5 * 5.5) / (size + 5)
    return [
        float(np.log1p(len(raw))), _logit(n["odd"], black, 0.002), _logit(n["bar"], black, 0.002), _logit(n["shout"], black, 0.002), _logit(n["stop"], black, 0.03),
        _logit(n["digit"], black, 0.005), _logit(n["capital"], letters, 0.03), _logit(n["line"], max(len(raw), n["line"]), 0.005),
        float(np.log(length)), float(0.5 * np.log((np.square(sizes - length).sum() + 5 * 9.0) / (size + 5))),
        # How many different words there are, against what a text of its length tends to have.
        float(np.log1p(kinds) - 0.85 * np.log1p(size)), _logit(repeats, max(size, 1), 0.01), _logit(len(lines) - len(set(lines)), len(lines), 0.02),
    ]


def features(text: Column) -> Column:
    """The statistics as array<double>, by Arrow batches."""
    ship(SparkSession.active())

    @F.udf("array<double>", useArrow=True)
    def one(value):
        return statistics(value)

    return one(text)


@dataclass(frozen=True)
class Discriminant:
    """What scoring needs: for each class its mean, the inverse Cholesky factor of its covariance, and a constant."""

    means: np.ndarray  # 2 x d
    factors: np.ndarray  # 2 x d x d: L^-1, so that |L^-1 (x - m)|^2 is the squared Mahalanobis length
    constants: np.ndarray  # 2: log prior - half the log determinant

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1, rounded so that the order in which sums were added doesn't show."""
        logs = [c - 0.5 * np.square((x - m) @ f.T).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return np.round(1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -60, 60))), 6)


def fit(labelled: DataFrame, features_col: str = "features", label_col: str = "label", to_pooled: float = 0.1, to_identity: float = 0.02) -> Discriminant:
    """Fit on all rows of ``labelled`` (features array<double>, label 0 or 1): Spark adds up two rows of moments.

    ``to_pooled`` and ``to_identity`` are the shrinkage weights. A class without rows takes the pooled moments; with no
    rows at all every score is the prior of one half.
    """
    f = [F.col(features_col)[i] for i in range(SIZE)]
    pairs = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
    sums = labelled.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(label_col).cast("int").alias("label")).agg(
        F.count("*").alias("n"), F.array(*[F.sum(x) for x in f]).alias("s"), F.array(*[F.sum(f[i] * f[j]) for i, j in pairs]).alias("q")
    )
    by = {r.label: r for r in sums.collect()}  # two rows
    n, mean, cov = np.zeros(2), np.zeros((2, SIZE)), np.zeros((2, SIZE, SIZE))
    for k, r in by.items():
        n[k], mean[k] = r.n, np.array(r.s) / r.n
        for (i, j), q in zip(pairs, r.q, strict=True):
            cov[k, i, j] = cov[k, j, i] = q / r.n - mean[k, i] * mean[k, j]
    total = n.sum()
    pooled = (n[:, None, None] * cov).sum(axis=0) / total if total else np.eye(SIZE)
    centre = (n[:, None] * mean).sum(axis=0) / total if total else np.zeros(SIZE)
    factors, constants = [], []
    for k in (0, 1):
        if not n[k]:
            mean[k], cov[k] = centre, pooled
        c = (1 - to_pooled) * cov[k] + to_pooled * pooled
        c = (1 - to_identity) * c + to_identity * (np.trace(c) / SIZE + 1e-6) * np.eye(SIZE)
        lower = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log((n[k] + 1) / (total + 2)) - np.log(np.diag(lower)).sum())
    return Discriminant(mean, np.stack(factors), np.array(constants))


def score(features_col: Column, model: Discriminant) -> Column:
    ship(SparkSession.active())

    @F.pandas_udf("double")
    def batch(x):
        import pandas as pd

        return pd.Series(model.scores(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

    return batch(features_col)


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 by 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def with_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Score every whole text; the classifier learns from the labelled rows that are not held out.

    Returns a row per input row: the id, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier), ``predicted``.
    Null texts count as empty; null ids are scored, not learned from. Labels that contradict one another for an id, and
    null labels, are left out; a text repeated under one id is learned from as often as it occurs. Statistics come from
    the text alone; other columns are ignored.
    """
    found = cut(docs.select(F.col(id_col).cast("long").alias("id"), features(text_or_empty(text_col)).alias("features")), "features")
    model = fit(learnable(found, labels, id_col, label_col))
    scored = found.select("id", held_out(F.col("id")).alias("held_out"), score(F.col("features"), model).alias("score"))
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def learnable(found: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Features beside labels, without the rows that are held out."""
    clean = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most").drop("most")
    )
    return found.filter(~held_out(F.col("id"))).join(clean, "id").select("features", "label")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", at_least: float = 0.5) -> DataFrame:
    """The documents that score ``at_least``, with all their columns; see ``with_scores``.

    Texts are read twice: for the statistics that labels are joined to (of all rows that are not held out), and for the scores.
    """
    found = docs.select(F.col(id_col).cast("long").alias("id"), features(text_or_empty(text_col)).alias("features"))
    model = fit(learnable(found, labels, id_col, label_col))
    return docs.filter(score(features(text_or_empty(text_col)), model) >= at_least)
