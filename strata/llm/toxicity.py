"""Toxicity: a factorization machine over hashed terms, with learned pairwise interactions.

A text is the set of its distinct words and of the beginnings of its longer words, hashed into
buckets. Every bucket has a linear weight and a latent vector; the score of a text is the logistic
of bias, weights and all pairwise products of its buckets' vectors (in linear time by the usual
identity). All terms are trained together: one that is neutral by itself can matter beside another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, bounded_batches, byte_slices, free_name, mix64, span_hashes, stored
from strata.llm.token_file import open_store

#: Beginnings of words that are terms too, in letters: they stand for inflected forms.
STEMS = (4, 5)


def text_terms(texts: list[str | None], most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(text index, term hash) of each distinct term of each whole text, by index."""
    texts = [t or "" for t in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    rows, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, b in byte_slices(sizes, most):
        words = Words(texts[a:b])
        doc, term = [words.doc], [words.hash]
        for size in STEMS:
            long = words.ends - words.starts > size
            doc.append(words.doc[long])
            term.append(span_hashes(words.codes, words.starts[long], words.starts[long] + size) ^ np.uint64(size))
        doc, term = np.concatenate(doc), np.concatenate(term)
        order = np.lexsort((term, doc))
        doc, term = doc[order], term[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
        rows.append(doc[new] + a)
        terms.append(term[new])
    return np.concatenate(rows), np.concatenate(terms)


def buckets_column(text: Column, bits: int) -> Column:
    """The distinct buckets of a text's terms, ascending."""
    @F.pandas_udf("array<int>")
    def buckets(texts: pd.Series) -> pd.Series:
        rows, found = text_terms(texts.tolist())
        cut = np.searchsorted(rows, np.arange(len(texts) + 1))
        return pd.Series([np.unique(bucket_of(found[a:b], bits)) for a, b in zip(cut[:-1], cut[1:], strict=True)], dtype=object)

    return buckets(text.cast("string"))


def bucket_of(terms: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(terms) >> np.uint64(64 - bits)).astype(np.int32)


@dataclass
class FactorizationMachine:
    bits: int
    bias: float
    weights: np.ndarray  # (buckets,)
    factors: np.ndarray  # (buckets, k)

    @classmethod
    def start(cls, bits: int, rank: int, seed: int = 11, spread: float = 0.02) -> "FactorizationMachine":
        rng = np.random.default_rng(seed)
        return cls(bits, 0.0, np.zeros(1 << bits, np.float32), rng.normal(0, spread, (1 << bits, rank)).astype(np.float32))

    def margin(self, rows: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of each of ``n`` texts, and the sums of their latent vectors.

        ``rows`` and ``at`` are the text and the bucket of each of their distinct buckets, by text.
        """
        factors = self.factors[at]
        both = np.concatenate((self.weights[at][:, None] - 0.5 * (factors**2).sum(1, keepdims=True), factors), 1)
        sums = np.zeros((n, both.shape[1]))
        if len(rows):
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            sums[rows[first]] = np.add.reduceat(both, first, dtype=float)
        return self.bias + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2).sum(1), sums[:, 1:]

    def score(self, texts: list[str | None]) -> np.ndarray:
        rows, terms = text_terms(texts)
        both = np.unique((rows << 32) | bucket_of(terms, self.bits))
        margin, _ = self.margin(both >> 32, both & 0xFFFFFFFF, len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -700, 700)))


class Trainer:
    """Stochastic gradient steps on the logistic loss; each bucket's step shrinks with its summed squared slopes.

    ``texts`` is the number of examples that hold each bucket. Buckets of few texts move slowly (``rare``), so
    that what a text has for itself does not explain it before what it has in common with others;
    interactions need more texts than single weights do (``rare_pairs``). Weights and vectors
    shrink towards nothing by a fixed amount with each step (``sparse``, ``sparse_pairs``), which only
    terms with a steady slope outgrow. ``calm`` is where the sums of squares begin.
    """

    def __init__(self, machine: FactorizationMachine, texts: np.ndarray, rate: float = 0.3, calm: float = 1.0, rare: float = 5.0, rare_pairs: float = 1000.0, sparse: float = 0.5, sparse_pairs: float = 1.0):
        self.fm, self.rate, self.sparse, self.sparse_pairs = machine, rate, sparse, sparse_pairs
        self.pace = ((texts / (texts + rare)) ** 2).astype(np.float32)
        self.pace_pairs = ((texts / (texts + rare_pairs)) ** 2).astype(np.float32)
        self.seen = {"bias": calm, "weights": np.full(len(machine.weights), calm, np.float32), "factors": np.full(len(machine.weights), calm, np.float32)}
        self.met = np.zeros(len(machine.weights), bool)

    def step(self, rows: np.ndarray, at: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """One step on a batch; ``weight`` is each text's share in the loss."""
        fm = self.fm
        margin, sums = fm.margin(rows, at, len(y))
        slope = weight * (1 / (1 + np.exp(-np.clip(margin, -700, 700))) - y)
        total = float(slope.sum())
        self.seen["bias"] += total**2
        fm.bias -= self.rate * total / self.seen["bias"] ** 0.5
        if not len(rows):
            return
        order = np.argsort(at, kind="stable")
        at, rows = at[order], rows[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        own = at[first]
        g = slope[rows].astype(np.float32)
        linear = np.add.reduceat(g, first)
        pairs = np.add.reduceat(g[:, None] * (sums[rows].astype(np.float32) - fm.factors[at]), first)
        self.met[own] = True
        self.seen["weights"][own] += linear**2
        step = self.rate * self.pace[own] / np.sqrt(self.seen["weights"][own])
        moved = fm.weights[own] - step * linear
        fm.weights[own] = np.sign(moved) * np.maximum(np.abs(moved) - step * self.sparse, 0)
        self.seen["factors"][own] += (pairs**2).mean(1)
        step = (self.rate * self.pace_pairs[own] / np.sqrt(self.seen["factors"][own]))[:, None]
        moved = fm.factors[own] - step * pairs
        norm = np.sqrt((moved**2).sum(1, keepdims=True))
        fm.factors[own] = moved * np.maximum(1 - step * self.sparse_pairs / np.maximum(norm, 1e-12), 0)

    def done(self) -> FactorizationMachine:
        """The machine; buckets that no text had stand for nothing."""
        self.fm.factors[~self.met] = 0
        return self.fm


#: Examples of a training step, and how many steps are taken at least (small tables are read more often).
STEP_ROWS, LEAST_STEPS = 128, 600


def _examples(files: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text index, bucket, y) of the stored examples, a step at a time: no more are held."""
    import pyarrow.parquet as pq

    for uri in files:
        store, path = open_store(unquote(uri))
        with store.open_input_file(path) as f:
            for batch in pq.ParquetFile(f).iter_batches(STEP_ROWS, columns=["y", "at"]):
                at = batch.column(batch.schema.names.index("at"))
                n = np.diff(at.offsets.to_numpy())
                y = batch.column(batch.schema.names.index("y")).to_numpy().astype(float)
                yield np.repeat(np.arange(len(n)), n), at.flatten().to_numpy().astype(np.int64), y


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows_per_class: int = 6000, share: float = 0.5, bits: int = 18, rank: int = 8,
                 epochs: int = 10, id_col: str = "doc_id", text_col: str = "text") -> FactorizationMachine:
    """Trains on at most ``rows_per_class`` labelled documents of each class, by lowest key hash.

    All terms of these texts take part: they are hashed into ``1 << bits`` buckets. The examples are
    stored in Spark and read a step at a time, at least ``epochs`` times, so the driver holds the
    machine (20 MB by default) and one step, however long the texts are. ``rows_per_class`` also
    bounds the broadcast of the chosen keys. Labels other than 0 and 1 are ignored; a key with
    several has the larger. The classes weigh ``share`` and 1 - ``share``; with one class only, or
    no labels, every score is ``share``.
    """
    bounded_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("k"), F.col(label).cast("int").alias("y")).where(F.col("k").isNotNull() & F.col("y").isin(0, 1)).groupBy("k").agg(F.max("y").alias("y"))
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(rows_per_class) for y in (0, 1)]
    picked = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).join(F.broadcast(chosen[0].unionByName(chosen[1])), "k")
    rows = picked.select("y", buckets_column(F.col("t"), bits).alias("at"), F.xxhash64("k", "t").alias("h"))
    examples = stored(rows.repartition(8, "h").sortWithinPartitions("h").select("y", "at"), "examples")  # classes well mixed
    files = sorted(examples.inputFiles())
    texts, count, steps = np.zeros(1 << bits, np.int64), np.zeros(2), 0
    for _, at, y in _examples(files):
        steps += 1
        texts += np.bincount(at, minlength=1 << bits)
        count += np.bincount(y.astype(int), minlength=2)
    machine = FactorizationMachine.start(bits, rank)
    share = min(max(share, 1e-3), 1 - 1e-3)
    if not count.all():
        machine.bias, machine.factors[:] = float(np.log(share / (1 - share))), 0
        return machine
    trainer, of_class = Trainer(machine, texts), np.array([1 - share, share]) * count.sum() / count
    for _ in range(max(epochs, math.ceil(LEAST_STEPS / steps))):
        for text, at, y in _examples(files):
            trainer.step(text, at, y, of_class[y.astype(int)])
    return trainer.done()


def score_toxicity(docs: DataFrame, model: FactorizationMachine, out: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the toxicity (0 to 1) of each whole text in column ``out``.

    NULL and empty texts, and texts without known terms, get the learned bias as a probability. Texts
    of any length are scored whole; rows with equal texts get equal scores.
    All columns stay; a column already called ``out`` makes the score's name start with underscores.
    """
    bounded_batches(docs.sparkSession)

    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts.tolist()))

    return docs.withColumn(free_name(docs, out), score(F.col(text_col).cast("string")))
