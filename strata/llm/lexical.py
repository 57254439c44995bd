"""Ranked lexical search: term-at-a-time with a limited number of accumulators.

One pass over the texts keeps, for each document, its number of terms and the occurrences of the
queries' terms; document frequencies are summed from that table. The table's partitions are the
shards: a task reads its documents block by block, inverts a block and takes each query's terms
rarest first. A document gets an accumulator as long as the terms that are left could lift a new one to the k-th
best partial score; after that only the accumulators that exist are updated, to their exact scores.
Each task gives k documents a query, and those are ranked. No posting is shuffled, so a term that
stands in every document is no hot key.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, release, stored

#: Term bytes: digits, letters in lower case and all of a sign beyond ASCII; others separate terms.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: About so many (query, term) rows are searched for in one pass; more queries take more passes.
PASS_TERMS = 200_000
#: A block of documents that a task inverts at once: about 50 MB.
BLOCK_POSTINGS, BLOCK_DOCS = 1_000_000, 65_536
#: The document length has this share (of 100) in the weight of an occurrence, the rest is fixed.
LENGTH_SHARE = 90


def terms(raw: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, in order: runs of letters, digits and signs beyond ASCII; A-Z in lower case."""
    return raw.translate(_TABLE).split() if raw else []


@dataclass
class Queries:
    """Queries of one pass: their keys and term numbers, each term's weight; N and L of the collection."""

    keys: list
    of: list[np.ndarray]  # term numbers, rarest first
    weight: np.ndarray
    n_docs: int
    n_terms: int
    best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 90 + (90 * n * N) div L, without overflow."""
    if not n_terms:
        return np.full(len(n), 100 - LENGTH_SHARE, np.int64)
    if LENGTH_SHARE * n_docs * int(n.max(initial=0)) < 2**63:
        return 100 - LENGTH_SHARE + LENGTH_SHARE * n_docs * n // n_terms
    return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(x) * n_docs // n_terms for x in n], np.int64)


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def search_block(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(documents, exact scores) that may be among the k best of a block with a score of ``floor`` or more.

    ``lists`` has (ascending documents, contributions) of each term of the query, rarest first. No
    document whose score reaches both the k-th best and ``floor`` is missing.
    """
    left = np.cumsum([0, *(int(c.max()) for _, c in reversed(lists))])[::-1]  # what terms from j on can add at most
    score, made, open_, live, kth = np.zeros(size, np.int64), np.zeros(size, bool), True, np.zeros(0, np.int64), floor
    for j, (docs, add) in enumerate(lists):
        kth = max(kth, _kth(score[live], k))
        if open_ and left[j] < kth:
            open_ = False
            live = np.sort(live)
        if open_:
            new = docs[~made[docs]]
            made[new] = True
            live = np.concatenate((live, new))
            score[docs] += add
            continue
        live = live[score[live] + left[j] >= kth]  # the others cannot reach the k-th any more
        if len(live) * 16 < len(docs):
            at = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
            hit = docs[at] == live
            score[live[hit]] += add[at[hit]]
        else:
            score[docs] += add
    return live, score[live]


def _top(docs: np.ndarray, nulls: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best by descending score, then ascending key, NULL keys last."""
    keep = (scores > 0) & (scores >= _kth(scores, k))
    docs, nulls, scores = docs[keep], nulls[keep], scores[keep]
    order = np.lexsort((docs, nulls, -scores))[:k]
    return docs[order], nulls[order], scores[order]


def _search(queries: Queries, k: int, docs: np.ndarray, nulls: np.ndarray, n: np.ndarray, counts: np.ndarray, ids: np.ndarray, tf: np.ndarray) -> None:
    """Adds a block of documents with their postings to the best of each query."""
    m = _length_norm(n, queries.n_docs, queries.n_terms)
    doc = np.repeat(np.arange(len(n)), counts)
    add = queries.weight[ids] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
    order = np.argsort(ids, kind="stable")
    ids, doc, add = ids[order], doc[order], add[order]
    cut = np.searchsorted(ids, np.arange(len(queries.weight) + 1))
    for q, wanted in enumerate(queries.of):
        lists = [(doc[cut[t] : cut[t + 1]], add[cut[t] : cut[t + 1]]) for t in wanted if cut[t + 1] > cut[t]]
        if lists:
            old = queries.best[q]
            found, scores = search_block(lists, len(n), k, int(old[2][-1]) if len(old[2]) == k else 0)
            queries.best[q] = _top(np.concatenate((old[0], docs[found])), np.concatenate((old[1], nulls[found])), np.concatenate((old[2], scores)), k)


def postings(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, ids, tfs) of each row: its terms with repeats, the vocabulary's terms in it and how often."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            n, ids, tfs = [], [], []
            for raw in batch.column(1):
                found = terms(raw.as_py())
                n.append(len(found))
                seen = Counter(filter(None.__ne__, map(known.get, found)))
                ids.append(np.fromiter(seen.keys(), "<i4", len(seen)).tobytes())
                tfs.append(np.fromiter(seen.values(), "<i4", len(seen)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(tfs, pa.binary())], names=["doc_id", "n", "ids", "tfs"])
        release()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("raw"))
    return rows.mapInArrow(run, "doc_id long, n long, ids binary, tfs binary")


def _counts(index: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """(document frequency of each of ``size`` terms, N, L), summed in Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            n = batch.column(0).to_numpy(zero_copy_only=False)
            docs, length = docs + int((n > 0).sum()), length + int(n.sum())
            df += np.bincount(np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *at.tolist()], pa.int64()), pa.array([docs, length, *df[at].tolist()], pa.int64())], names=["term", "n"])

    summed = index.select("n", "ids").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    got = dict(zip(summed.term.tolist(), summed.n.tolist(), strict=True))
    return np.array([got.get(t, 0) for t in range(size)], np.int64), got.get(-1, 0), got.get(-2, 0)


def _best_of_tasks(index: DataFrame, queries: Queries, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        queries = Queries(**vars(shared.value) | {"best": [(none, none.astype(bool), none)] * len(shared.value.keys)})
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            rows = pa.Table.from_batches(held)
            held.clear()
            ids, tf = (np.frombuffer(b"".join(rows.column(c).to_pylist()), "<i4").astype(np.int64) for c in ("ids", "tfs"))
            counts = np.fromiter((len(x) // 4 for x in rows.column("ids").to_pylist()), np.int64, rows.num_rows)
            key = rows.column("doc_id")
            _search(queries, k, key.fill_null(0).to_numpy(), key.is_null().to_numpy().astype(bool), rows.column("n").to_numpy(), counts, ids, tf)

        size = docs = 0
        for batch in batches:
            held.append(batch)
            size, docs = size + batch.column(2).nbytes // 4, docs + batch.num_rows
            if size >= BLOCK_POSTINGS or docs >= BLOCK_DOCS:
                flush()
                size = docs = 0
        if held:
            flush()
        for key, (found, null, score) in zip(queries.keys, queries.best, strict=True):
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(found), pa.int64()), pa.array(found, pa.int64(), mask=null), pa.array(score, pa.int64())], names=["item_id", "doc_id", "score"])
        release()

    return index.mapInArrow(run, "item_id long, doc_id long, score long")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", pass_terms: int = PASS_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of each query.

    Equal scores rank by ascending doc_id, NULL keys last. Every row of ``docs`` is a document of its
    own, also when keys repeat or are NULL. NULL and empty texts, and texts without a term, count
    nowhere and are never found. Queries with one id, NULL too, are one query of all their terms, once each; one
    without known terms has no rows. Empty tables give no rows; other columns are ignored.
    Queries are taken in passes of about ``pass_terms`` terms, so what a pass broadcasts is bounded.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(raw.as_py()))) for raw in batch.column(1)]
            keys = [k for k, ts in zip(batch.column(0).to_pylist(), found, strict=True) for _ in ts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([t for ts in found for t in ts], pa.binary())], names=["item_id", "term"])

    wanted = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").cast("binary").alias("raw"))
    wanted = stored(wanted.mapInArrow(split, "item_id long, term binary").distinct(), "query-terms")
    passes = -(-wanted.count() // pass_terms)
    out = None
    for p in range(passes):
        rows = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).toPandas()
        vocabulary = sorted(set(rows.term))
        place = {t: i for i, t in enumerate(vocabulary)}
        of: dict = {}
        for key, term in zip(rows.item_id.astype(object).where(rows.item_id.notna(), None), rows.term, strict=True):
            of.setdefault(None if key is None else int(key), []).append(place[term])
        index = stored(postings(docs, vocabulary, id_col, text_col), "postings")
        df, n_docs, n_terms = _counts(index, len(vocabulary))
        weight = np.array([term_weight(n_docs, int(x)) for x in df], np.int64)
        order = np.lexsort((np.arange(len(df)), df))
        rarity = np.empty(len(df), np.int64)
        rarity[order] = np.arange(len(df))
        queries = Queries(list(of), [np.array(sorted(ts, key=rarity.__getitem__)) for ts in of.values()], weight, n_docs, n_terms)
        best = _best_of_tasks(index, queries, k)
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    # first among slices of an item's rows, then among the best of the slices
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("item_id", F.pmod(F.xxhash64("doc_id"), F.lit(16))).orderBy(*by)
    few = out.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k).drop("rank")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*by))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
