"""Approximate nearest neighbours by inner product: a robust-pruned directed graph in each shard.

Distinct vectors are dealt by hash to shards of bounded size. Inner products become distances by one
more coordinate, sqrt(M**2 - |x|**2). A shard's graph grows in batches: a greedy beam search from the
most central vector proposes the neighbours of each new vector, relaxed distance pruning keeps
diverse ones, and the edges are mirrored and pruned again where a node has too many. Every query
then searches every shard by beam search; searches advance step by step for many queries at once.
What is found is scored anew in double precision on the vectors as given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, release, stored

#: Distinct vectors of a shard, about.
SHARD = 8192
#: Edges of a node, and how much nearer a kept neighbour must be to another one to stand for it.
DEGREE, RELAX = 32, 1.2
#: Nodes that a search keeps while the graph is built, and for a query.
BUILD_BEAM, BEAM = 64, 96
#: Values of the query vectors in one pass (32 MB as doubles): more queries take more passes.
PASS_VALUES = 1 << 22
#: Nodes expanded in one step of a search, and searches that advance together.
WIDE, TOGETHER = 4, 256


def beam_search(points: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int, offset: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` best nodes that greedy searches find for each query, best first; -1 where fewer are reached.

    A node's score is its inner product with the query less ``offset``; higher is nearer. Returns
    (nodes, scores), each (queries, beam).
    """
    n, rows = len(points), len(queries)
    offset = np.zeros(n, points.dtype) if offset is None else offset
    nodes = np.full((rows, beam), -1, np.int64)
    scores = np.full((rows, beam), -np.inf, points.dtype)
    done = np.ones((rows, beam), bool)
    nodes[:, 0], scores[:, 0], done[:, 0] = entry, queries @ points[entry] - offset[entry], False
    seen = np.zeros((rows, n + 1), bool)  # the last column stands for no node
    seen[:, entry] = seen[:, n] = True
    active = np.arange(rows)
    while len(active):
        # the nearest nodes that are not expanded yet; nodes are kept in order of score
        rank = np.cumsum(~done[active], 1)
        r, c = np.nonzero(~done[active] & (rank <= WIDE))
        done[active[r], c] = True
        slot = rank[r, c] - 1
        wide = np.full((len(active), WIDE, graph.shape[1]), n)
        near = graph[nodes[active[r], c]]
        wide[r, slot] = np.where(near < 0, n, near)
        wide = np.sort(wide.reshape(len(active), -1), 1)
        wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = n
        fresh = ~seen[active[:, None], wide]
        r, c = np.nonzero(fresh)
        node = wide[r, c]
        seen[active[r], node] = True
        found = np.full(wide.shape, -np.inf, points.dtype)
        found[r, c] = np.einsum("ij,ij->i", points[node], queries[active[r]]) - offset[node]
        all_scores = np.concatenate((scores[active], found), 1)
        all_nodes = np.concatenate((nodes[active], np.where(fresh, wide, -1)), 1)
        all_done = np.concatenate((done[active], ~fresh), 1)
        order = np.argsort(-all_scores, 1, kind="stable")[:, :beam]
        pick = np.arange(len(active))[:, None], order
        scores[active], nodes[active], done[active] = all_scores[pick], all_nodes[pick], all_done[pick]
        active = active[~done[active].all(1)]
    return nodes, scores


def robust_prune(points: np.ndarray, own: np.ndarray, near: np.ndarray, degree: int = DEGREE, relax: float = RELAX) -> np.ndarray:
    """(rows, degree) neighbours of the nodes ``own`` out of ``near`` (rows, any; -1 for none), -1 where fewer.

    The nearest candidate is kept and all candidates go that are nearer to it, by the factor
    ``relax``, than to the node; then the nearest of the rest is kept, and so on.
    """
    rows = len(own)
    valid = (near >= 0) & (near != own[:, None])
    safe = np.where(valid, near, 0)
    at = points[safe]
    length = np.einsum("ijk,ijk->ij", at, at)
    mine = points[own]
    gap = np.maximum(length - 2 * np.einsum("ijk,ik->ij", at, mine) + np.einsum("ij,ij->i", mine, mine)[:, None], 0)
    gap[~valid] = np.inf
    out = np.full((rows, degree), -1, np.int64)
    line = np.arange(rows)
    for k in range(degree):
        pick = gap.argmin(1)
        live = np.isfinite(gap[line, pick])
        if not live.any():
            break
        out[live, k] = near[line[live], pick[live]]
        kept = at[line, pick]
        apart = length - 2 * np.einsum("ijk,ik->ij", at, kept) + length[line, pick][:, None]
        gap[live[:, None] & (relax**2 * np.maximum(apart, 0) <= gap)] = np.inf
        gap[line, pick] = np.inf
    return out


def _mirrored(points: np.ndarray, graph: np.ndarray, new: np.ndarray, degree: int) -> None:
    """Adds the edges of the ``new`` nodes in the other direction; a node whose row is full is pruned to ``degree``."""
    width = graph.shape[1]
    source, target = np.repeat(new, width), graph[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    for part in np.array_split(np.arange(len(nodes)), max(1, len(nodes) // TOGETHER)):
        widest = int(count[part].max(initial=0))
        more = np.full((len(part), widest), -1, np.int64)
        r = np.repeat(np.arange(len(part)), count[part])
        c = np.arange(len(r)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
        more[r, c] = source[np.repeat(first[part], count[part]) + c]
        old = graph[nodes[part]]
        more[(more[:, :, None] == old[:, None, :]).any(2)] = -1
        free = (old >= 0).sum(1) + (more >= 0).sum(1) <= width
        for i in np.flatnonzero(free):
            have, add = old[i][old[i] >= 0], more[i][more[i] >= 0]
            graph[nodes[part][i], : len(have) + len(add)] = np.concatenate((have, add))
        full = np.flatnonzero(~free)
        if len(full):
            graph[nodes[part][full]] = -1
            graph[nodes[part][full], :degree] = robust_prune(points, nodes[part][full], np.concatenate((old[full], more[full]), 1), degree)


def _connected(graph: np.ndarray, entry: int) -> np.ndarray:
    """The graph with an edge to each node that pruning cut off, from a node that it points to or else the entry."""
    reached = np.zeros(len(graph), bool)
    reached[entry] = True
    front = np.array([entry])
    while True:
        while len(front):
            near = np.unique(graph[front])
            front = near[(near >= 0) & ~reached[near]]
            reached[front] = True
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return graph
        node = int(lost[0])
        near = graph[node][graph[node] >= 0]
        near = near[reached[near]]
        source = int(near[0]) if len(near) else entry
        free = np.flatnonzero(graph[source] < 0)
        if not len(free):
            graph = np.concatenate((graph, np.full((len(graph), 1), -1, np.int64)), 1)
            free = [graph.shape[1] - 1]
        graph[source, free[0]] = node
        reached[node], front = True, np.array([node])


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 5) -> tuple[np.ndarray, int]:
    """(neighbours with -1 for none, about 3/2 * ``degree`` a node at most, entry node) over distinct points."""
    n = len(points)
    centre = points - points.mean(0)
    entry = int(np.einsum("ij,ij->i", centre, centre).argmin())
    half = np.einsum("ij,ij->i", points, points) / 2
    graph = np.full((n, degree + degree // 2), -1, np.int64)  # room for mirrored edges between two prunings
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    at = 1
    while at < n:
        new = order[at : at + min(TOGETHER, at)]
        found, _ = beam_search(points, graph, entry, points[new], beam, half)
        graph[new, :degree] = robust_prune(points, new, found, degree)
        _mirrored(points, graph, new, degree)
        at += len(new)
    return _connected(graph, entry), entry


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate that gives all the same length: distances order like inner products."""
    x = vectors / max(float(np.abs(vectors).max()), 1e-300)
    square = np.einsum("ij,ij->i", x, x)
    return np.concatenate((x, np.sqrt(np.maximum(square.max() - square, 0))[:, None]), 1).astype(np.float32)


_SHARD = "dim int, shard long, entry int, sizes array<int>, ids array<long>, vectors binary, graph binary"


def _packed(degree: int):
    """One row for a shard: its distinct vectors, their keys in order, and the graph."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        raw = table.column("raw").to_pylist()
        ids = np.array(table.column("vec_id"), np.int64)
        order = np.array(sorted(range(len(raw)), key=lambda i: (raw[i], ids[i])))
        first = np.array([True, *(raw[a] != raw[b] for a, b in zip(order[1:], order[:-1], strict=True))])
        vectors = np.frombuffer(b"".join(raw[i] for i in order[first]), "<f8").reshape(-1, dim)
        graph, entry = build_graph(_lifted(vectors), degree)
        sizes = np.diff(np.append(np.flatnonzero(first), len(order)))
        cells = [dim, key[1].as_py(), entry, sizes.tolist(), ids[order].tolist(), vectors.tobytes(), graph.astype("<i4").tobytes()]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        release()
        return pa.Table.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds, strict=True)], names=[f.split()[0] for f in _SHARD.split(", ")])

    return pack


def usable(vector: Column) -> Column:
    """The vector as doubles, -0.0 as 0.0; NULL if it is empty, zero or holds a NULL or non-finite component."""
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.transform(v, lambda x: x + F.lit(0.0)))


def _named(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), usable(F.col(vector_col)).alias("e"))
    return rows.where("vec_id is not null and e is not null").groupBy("vec_id").agg(F.min("e").alias("e"))


def _bytes(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, raw): vectors as little-endian doubles, which compare quickly and pack densely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.asarray(v.values, "<f8").tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(r) // 8 for r in raw], pa.int32()), pa.array(raw, pa.binary())], names=["vec_id", "dim", "raw"])

    return vectors.mapInArrow(run, "vec_id long, dim int, raw binary")


def build_index(vectors: DataFrame, copies: int, shard: int = SHARD, degree: int = DEGREE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One stored row for each shard of about ``shard`` distinct vectors of one dimension.

    Of equal vectors the ``copies`` least keys are held: no more can be among that many best, since ties
    go to the smaller key. That limit works before the shuffle, so a very common vector is no hot group.
    """
    named = _bytes(_named(vectors, id_col, vector_col))
    part = Window.partitionBy("raw").orderBy("vec_id")
    held = stored(named.withColumn("copy", F.row_number().over(part)).where(F.col("copy") <= copies), "distinct-vectors")
    sizes = held.where("copy = 1").groupBy("dim").agg(F.count("*").alias("n"))
    shards = F.ceil(F.col("n") / F.lit(shard))
    dealt = held.join(sizes, "dim").select("vec_id", "dim", "raw", F.pmod(F.xxhash64("raw"), shards).cast("long").alias("shard"))
    # little data but much work a shard: a number of partitions that is asked for is not coalesced
    tasks = 2 * int(sizes.agg(F.sum(shards)).first()[0] or 1)
    dealt = dealt.repartition(tasks, "dim", "shard")
    return stored(dealt.groupBy("dim", "shard").applyInArrow(_packed(degree), _SHARD), "graph-shards")


def _search_shards(index: DataFrame, ids: np.ndarray, dims: np.ndarray, raws: list[bytes], k: int, beam: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast((ids, dims, raws))

    def in_shard(row: dict) -> Iterator[pa.RecordBatch]:
        ids, dims, raws = shared.value
        dim = row["dim"]
        mine = np.flatnonzero(dims == dim)
        vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
        graph = np.frombuffer(row["graph"], "<i4").reshape(len(vectors), -1).astype(np.int64)
        points = _lifted(vectors)
        ends = np.cumsum(row["sizes"])
        keys = np.array(row["ids"], np.int64)
        for a in range(0, len(mine), TOGETHER):
            part = mine[a : a + TOGETHER]
            exact = np.frombuffer(b"".join(raws[i] for i in part), "<f8").reshape(-1, dim)
            scaled = exact / np.abs(exact).max(1, keepdims=True)
            flat = np.concatenate((scaled, np.zeros((len(part), 1))), 1).astype(np.float32)
            nodes, _ = beam_search(points, graph, row["entry"], flat, max(beam, k + 1))
            out: list[tuple] = []
            for q, near in zip(part, nodes, strict=True):
                near = near[near >= 0]
                score = (vectors[near] * np.frombuffer(raws[q], "<f8")).sum(1)
                low = np.sort(score)[-min(k + 1, len(score))]  # one of them may be the query itself
                near, score = near[score >= low], score[score >= low]
                size = np.array(row["sizes"])[near]
                at = np.repeat(ends[near] - np.cumsum(size), size) + np.arange(size.sum())
                key, score = keys[at], np.repeat(score, size)
                key, score = key[key != ids[q]], score[key != ids[q]]
                order = np.lexsort((key, -score))[:k]
                out.append((np.full(len(order), ids[q]), key[order], score[order]))
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from in_shard(batch.slice(i, 1).to_pylist()[0])
        release()

    return index.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, beam: int = BEAM, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors found with the largest inner product for each query.

    Nearest first, ties to the smaller vec_id. Vectors under the query's own key are no candidates,
    nor are those of another dimension. NULL, empty and zero vectors, vectors with NULL or
    non-finite components and NULL keys take no part. A key names one vector: of several rows with
    one key the least vector. Equal vectors are all found or none. Empty tables give no rows; other columns are ignored.
    Queries are broadcast in passes of at most ``PASS_VALUES`` values.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    index = build_index(vectors, k + 1, shard, id_col=id_col, vector_col=vector_col)
    asked = stored(_bytes(_named(queries, id_col, vector_col)), "queries")
    values = asked.agg(F.sum("dim")).first()[0] or 0
    passes = max(1, -(-values // PASS_VALUES))
    # a shard a task: rows are few and large, so they are dealt out before the search
    n = index.count()
    one = index.repartitionByRange(max(1, n), "dim", "shard")
    name, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(name, "1")
    try:
        found = None
        for p in range(passes):
            rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == p).toPandas()
            part = _search_shards(one, rows.vec_id.to_numpy(np.int64), rows.dim.to_numpy(np.int64), [bytes(r) for r in rows.raw], k, beam)
            part = stored(part, "neighbours")
            found = part if found is None else found.unionByName(part)
    finally:
        spark.conf.set(name, before)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
