"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each text gives a short vector of statistics, made roughly normal by logs and logits. Per class a
mean and a covariance are fitted; covariances are shrunk towards the pooled one and its diagonal.
The score is a logistic function of the difference of the two log densities, whose Mahalanobis
distances use Cholesky factors computed once.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, free_name, release, remainder_is

STATS = ("bytes", "upper", "digit", "shout", "bar", "punctuation", "space", "word length", "longest word", "distinct words",
         "repeated lines", "line length", "compression", "marked words", "sentence ends", "top word")
_CLASS = np.zeros(256, np.int64)  # 0 other, 1 upper, 2 lower, 3 digit, 4 space, 5 '!', 6 '|', 7 sentence end, 8 other punctuation
for _c in range(128):
    _s = chr(_c)
    _CLASS[_c] = (1 if _s.isupper() else 2 if _s.islower() else 3 if _s.isdigit() else 4 if _s.isspace() else 5 if _s == "!" else 6 if _s == "|" else 7 if _s in ".?" else 8 if _s.isprintable() else 0)


def _logit(part: float, whole: float) -> float:
    return float(np.log((part + 0.5) / (whole - part + 0.5)))


def document_stats(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; NULL counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9)
    words, lines = text.split(), text.split("\n")
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n, m, distinct = len(raw), len(words), len(counts)
    letters = int(kinds[1] + kinds[2])
    filled = [x for x in lines if x]
    marked = sum(not (w[0].isalnum() and (w[-1].isalnum() or w[-1] in ".,")) for w in words)
    return [
        float(np.log1p(n)), _logit(kinds[1], letters), _logit(kinds[3], n), _logit(kinds[5], n), _logit(kinds[6], n), _logit(kinds[8], n), _logit(kinds[4], n),
        float(np.log1p(sizes.mean())) if m else 0.0, float(np.log1p(sizes.max())) if m else 0.0, float(np.log1p(distinct) / np.log1p(m)) if m else 1.0,
        _logit(len(filled) - len(set(filled)), len(filled)), float(np.log1p(n / max(1, len(filled)))),
        float(np.log((len(zlib.compress(raw, 1)) + 1) / (n + 1))), _logit(marked, m), _logit(kinds[7], m + kinds[7]), _logit(max(counts.values(), default=0), m),
    ]


def stats_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        rows = pd.Series([document_stats(t) for t in texts])
        release()
        return rows

    return stats(text.cast("string"))


@dataclass
class Discriminant:
    """Two shrunk Gaussians; ``roots`` are the inverse Cholesky factors of their covariances."""

    means: np.ndarray  # (2, d)
    roots: np.ndarray  # (2, d, d)
    offsets: np.ndarray  # (2,): log prior minus half the log determinant
    scale: float

    @classmethod
    def fit(cls, counts: np.ndarray, sums: np.ndarray, outers: np.ndarray, shrink: float, scale: float) -> "Discriminant":
        d = sums.shape[1]
        n = np.maximum(counts, 1.0)
        means = sums / n[:, None]
        covs = outers / n[:, None, None] - means[:, :, None] * means[:, None, :]
        pooled = (covs * counts[:, None, None]).sum(0) / max(1.0, counts.sum())
        target = 0.5 * pooled + 0.5 * np.diag(np.diag(pooled)) + 1e-3 * np.eye(d)
        roots, offsets = np.zeros((2, d, d)), np.zeros(2)
        for k in range(2):
            weight = shrink + (1 - shrink) * d / (d + counts[k])  # few rows of a class: mostly the common shape
            low = np.linalg.cholesky((1 - weight) * covs[k] + weight * target)
            roots[k] = np.linalg.inv(low)
            offsets[k] = np.log((counts[k] + 1) / (counts.sum() + 2)) - np.log(np.diag(low)).sum()
        return cls(means, roots, offsets, scale)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability-like score of class 1 for rows of statistics."""
        logs = [self.offsets[k] - 0.5 * (((x - self.means[k]) @ self.roots[k].T) ** 2).sum(1) for k in range(2)]
        return 1 / (1 + np.exp(np.clip((logs[0] - logs[1]) * self.scale, -700, 700)))


def class_sums(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str) -> DataFrame:
    """(y, n, s, o): rows of each class, the sums of their statistics and those of all products of two.

    The sums are Spark's own: a task has one Python worker at a time, which takes the statistics.
    """
    known = labels.select(F.col(id_col).alias("k"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1)).groupBy("k").agg(F.max("y").alias("y"))
    rows = docs.select(F.col(id_col).alias("k"), stats_column(F.col(text_col)).alias("x")).join(known, "k").select("x", "y")
    x = [F.col("x")[i] for i in range(len(STATS))]
    products = [F.sum(a * b) for i, a in enumerate(x) for b in x[i:]]
    return rows.groupBy("y").agg(F.count("*").alias("n"), F.array(*map(F.sum, x)).alias("s"), F.array(*products).alias("o"))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", shrink: float = 0.05, scale: float = 0.5,
                id_col: str = "doc_id", text_col: str = "text") -> Discriminant:
    """Fits both classes from all labelled documents by their summed moments.

    Only two rows of sums reach the driver. Labels other than 0 and 1 (NULL too) are ignored; a key
    with several labels has their larger one. Without labels every score is about one half.
    """
    bounded_batches(docs.sparkSession)
    d = len(STATS)
    counts, sums, outers = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    upper = np.triu_indices(d)
    for r in class_sums(docs, labels, label, id_col, text_col).collect():
        counts[r.y], sums[r.y], outers[r.y][upper] = r.n, r.s, r.o
        outers[r.y].T[upper] = r.o
    return Discriminant.fit(counts, sums, outers, shrink, scale)


def score_quality(docs: DataFrame, model: Discriminant, out: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text in column ``out``.

    Every text is scored, NULL and empty ones as empty; all columns of ``docs`` stay. If one is
    called ``out`` already, the score's name gets underscores in front. No rows, no scores.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([document_stats(t) for t in texts], float).reshape(-1, len(STATS))
        release()
        return pd.Series(model.score(x))

    return docs.withColumn(free_name(docs, out), score(F.col(text_col).cast("string")))


def learnable(df: DataFrame, modulus: int, held: int, id_col: str = "doc_id") -> DataFrame:
    """Rows with a key whose crc32 remainder is not the held-out one."""
    return df.where(F.col(id_col).isNotNull() & ~remainder_is(F.col(id_col), modulus, held))
