"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and every run of other characters than letters becomes one blank. Counts of
hashed n-grams per language are summed by Spark; the matrix of log probabilities (languages x
buckets, a fixed size per language) is broadcast, and batches of texts are scored as sparse rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, byte_slices, free_name, is_alpha, mix64

SIZES = (1, 2, 3)
BUCKETS = 1 << 16
UNKNOWN = "und"


def grams(texts: list[str], buckets: int = BUCKETS, sizes: tuple[int, ...] = SIZES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n, (text index, bucket) of the n-grams of all texts, in text order."""
    joined = "\n".join(t.lower() for t in texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter((len(t.lower()) + 1 for t in texts), np.int64, len(texts)))
    letter = is_alpha(codes)
    last = np.zeros(len(codes), bool)
    last[ends - 1] = True
    keep = letter | last
    keep[1:] |= letter[:-1]  # the first of a run of other characters stands for the blank
    doc = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))[keep]
    symbol = np.where(letter, codes, 32)[keep].astype(np.uint64)
    hashed = np.zeros(len(symbol), np.uint64)
    for n in range(1, max(sizes) + 1):
        m = len(symbol) - n + 1
        if m <= 0:
            return
        hashed = mix64(hashed[:m] * np.uint64(0x9E3779B97F4A7C15) + symbol[n - 1 :] + np.uint64(n))
        if n in sizes:
            whole = doc[:m] == doc[n - 1 :]
            yield doc[:m][whole], (hashed[whole] & np.uint64(buckets - 1)).astype(np.int64)


def has_letter(texts: list[str]) -> np.ndarray:
    return np.fromiter((any(map(str.isalpha, t)) for t in texts), bool, len(texts))


@dataclass
class Bayes:
    languages: list[str]
    logs: np.ndarray  # (buckets, languages) log probabilities, float32
    prior: np.ndarray  # (languages,)

    def score(self, texts: list[str | None], most: int = 1 << 19) -> tuple[list[str], np.ndarray]:
        """(language, its posterior) of each whole text."""
        texts = [t or "" for t in texts]
        found, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = np.flatnonzero(has_letter(texts)) if self.languages else np.zeros(0, np.int64)
        sizes = np.fromiter((len(texts[i]) for i in known), np.int64, len(known))
        for a, b in byte_slices(sizes, most):
            part = known[a:b]
            total = np.tile(self.prior, (len(part), 1))
            for doc, bucket in grams([texts[i] for i in part]):
                for k in range(len(self.languages)):
                    total[:, k] += np.bincount(doc, self.logs[bucket, k], len(part))
            best = total.argmax(1)  # ties: the first language by name
            score[part] = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
            for i, k in zip(part, best, strict=True):
                found[i] = self.languages[k]
        return found, score


def fit_languages(docs: DataFrame, buckets: int = BUCKETS, smooth: float = 0.1, lang_col: str = "lang", text_col: str = "text") -> Bayes:
    """Counts the n-grams of every text with a language, in Spark; languages are sorted by name.

    Rows with NULL language or text are left out. What reaches the driver is one number per
    language and bucket that occurs. Without rows the model knows no language.
    """
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            for a, b in byte_slices(sizes, 1 << 19):
                names = sorted(set(langs[a:b]))
                row = np.fromiter((names.index(x) for x in langs[a:b]), np.int64, b - a)
                for doc, bucket in grams(texts[a:b], buckets):
                    sums = np.bincount(row[doc] * buckets + bucket, minlength=len(names) * buckets).reshape(len(names), buckets)
                    for name, s in zip(names, sums, strict=True):
                        total[name] = total[name] + s if name in total else s
                for name, k in zip(names, np.bincount(row, minlength=len(names)), strict=True):
                    total.setdefault(f"\0{name}", np.zeros(1, np.int64))
                    total[f"\0{name}"] = total[f"\0{name}"] + k
        for name, s in total.items():
            at = np.flatnonzero(s)
            texts_of = name.startswith("\0")
            yield pa.RecordBatch.from_arrays([pa.array([name.lstrip("\0")] * len(at), pa.string()), pa.array(at - texts_of, pa.int64()), pa.array(s[at], pa.int64())], names=["lang", "bucket", "n"])

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts.lang.unique())
    table, texts = np.full((buckets, len(languages)), smooth), np.ones(len(languages))
    for k, name in enumerate(languages):
        own = counts[counts.lang == name]
        inside = own.bucket >= 0  # bucket -1 holds the number of texts
        table[own.bucket[inside], k] += own.n[inside]
        texts[k] += own.n[~inside].sum()
    logs = np.log(table) - np.log(table.sum(0))
    return Bayes(languages, logs.astype(np.float32), np.log(texts / texts.sum()))


def identify_language(docs: DataFrame, model: Bayes, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``found``: struct of lang_pred and score (its posterior, 0 to 1).

    ``und`` with score 0 for NULL texts, texts without a letter, and a model without languages.
    All columns stay; a column already called ``found`` gives underscores in front of the new one.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def found(texts: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.score(texts.tolist())
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return docs.withColumn(free_name(docs, "found"), found(F.col(text_col).cast("string")))
