"""Near-duplicate embeddings: int8 tile products with rigorous error bounds.

Equal vectors are one row first (a group of copies is never paired up). Distinct vectors go to
cells around a bounded number of pivots, and cells are cut into tiles; two tiles are compared
unless their centres and radii prove that no pair reaches the threshold. A unit vector is
``scale * q + e`` with int8 ``q`` and a known length of ``e``, so an integer product gives the
cosine within a bound: pairs surely above count, pairs that may be above are recomputed in double
precision, the others are proven below. A task emits counts per vector and a spanning set of
links only, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, stored
from strata.llm.components import components

TILE = 4096
BLOCK = 1024
PIVOTS = 64
#: More than the rounding of single-precision products of int8 values and scales.
SLACK = 1e-5


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the exact lengths of what quantisation left out (rounded up)."""
    scale = np.maximum(np.abs(unit).max(1), 1e-300) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(1)) * (1 + 1e-9) + 1e-15
    return q, scale, error


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; huge and tiny values are scaled first."""
    x = vectors / np.abs(vectors).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1))[:, None]


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), block by block, of unit rows with cosine >= threshold in double precision."""
    qx, sx, ex = quantise(x)
    qy, sy, ey = quantise(y)
    for a in range(0, len(x), BLOCK):
        left = qx[a : a + BLOCK].astype(np.float32)
        for b in range(0, len(y), BLOCK):
            dots = left @ qy[b : b + BLOCK].astype(np.float32).T  # integers below 2**24: exact
            dots *= sy[b : b + BLOCK].astype(np.float32)
            ei, ej = ex[a : a + BLOCK], ey[b : b + BLOCK]
            widest = ej.max()
            floor = (threshold - SLACK - ei - widest * (1 + ei)) / sx[a : a + BLOCK]
            i, j = np.nonzero(dots >= floor[:, None].astype(np.float32))
            if not len(i):
                continue
            near = dots[i, j].astype(float) * sx[a + i]
            bound = ei[i] + ej[j] * (1 + ei[i]) + SLACK
            sure = near - bound >= threshold
            maybe = np.flatnonzero(~sure & (near + bound >= threshold))
            for part in np.array_split(maybe, len(maybe) // 65536 + 1):
                sure[part] = np.einsum("ij,ij->i", x[a + i[part]], y[b + j[part]]) >= threshold
            yield a + i[sure], b + j[sure]


class Forest:
    """Union-find over local indices, fed with arrays of links."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        i, j = self.up[i], self.up[j]
        far = i != j
        for a, b in np.unique(np.stack((i[far], j[far]), 1), axis=0).tolist():
            while self.up[a] != a:
                a = self.up[a]
            while self.up[b] != b:
                b = self.up[b]
            self.up[max(a, b)] = min(a, b)
        while (self.up != (flat := self.up[self.up])).any():
            self.up = flat


def _compare(threshold: float):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                same = r.left == r.right
                ids, weights = np.array(r.ids_l, np.int64), np.array(r.n_l, np.int64)
                x = unit_rows(np.frombuffer(r.data_l, "<f4").astype(float).reshape(len(ids), -1))
                n, y = len(ids), x
                if not same:
                    ids, weights = np.append(ids, np.array(r.ids_r, np.int64)), np.append(weights, np.array(r.n_r, np.int64))
                    y = unit_rows(np.frombuffer(r.data_r, "<f4").astype(float).reshape(len(ids) - n, -1))
                links, forest, at = np.zeros(len(ids), np.int64), Forest(len(ids)), 0 if same else n
                for i, j in linked_pairs(x, y, threshold):
                    if same:
                        i, j = i[i != j], j[i != j]
                    links += np.bincount(i, weights[at + j], len(ids)).astype(np.int64)
                    if not same:
                        links += np.bincount(at + j, weights[i], len(ids)).astype(np.int64)
                    forest.add(i, at + j)
                hit = np.flatnonzero((links > 0) | (forest.up != np.arange(len(ids))))
                yield pd.DataFrame({"rep": ids[hit], "links": links[hit], "root": ids[forest.up[hit]]})

    return compare


def _tiles(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("rep")
    x = np.stack(frame.v.to_numpy()).astype("<f4")
    unit = unit_rows(x.astype(float))
    centre = unit.sum(0)
    centre /= max(np.sqrt((centre * centre).sum()), 1e-300)
    radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
    return pd.DataFrame({"tile": [frame.tile.iloc[0]], "dim": [x.shape[1]], "centre": [centre.tolist()], "radius": [radius],
                         "ids": [frame.rep.tolist()], "n": [frame.n.tolist()], "data": [x.tobytes()]})


def embedding_groups(vectors: DataFrame, threshold: float = 0.95, tile: int = TILE, pivots: int = PIVOTS,
                     id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of each row; ``threshold`` must be above 0.

    Rows link if their cosine in double precision is ``threshold`` or more. Vectors that are NULL,
    empty, zero, or hold NULL or non-finite components, link with nothing, nor do vectors of
    different sizes. Repeated rows and equal vectors link with each other. A component is named by
    its smallest id; a row without links is its own, and ``kept`` is whether the id names the
    component (NULL ids: component of the others, kept false). Other columns are ignored.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("raw"))
    good = F.coalesce((F.size("raw") > 0) & F.forall("raw", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("raw", lambda c: c != 0), F.lit(False))
    rows = rows.select("vec_id", F.when(good, F.transform("raw", lambda c: c + F.lit(0.0).cast("float"))).alias("v"))
    # `+ 0` makes negative zeros positive, so that equal vectors are equal keys
    copies = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    groups = stored(copies.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    chosen = [np.array(r.v) for r in groups.orderBy(F.xxhash64("v"), "rep").limit(pivots).select("v").collect()]

    @F.pandas_udf("int")
    def nearest(vs: pd.Series) -> pd.Series:
        out = np.zeros(len(vs), np.int64)
        for dim in {len(v) for v in vs}:
            at = np.flatnonzero([len(v) == dim for v in vs])
            own = [k for k, p in enumerate(chosen) if len(p) == dim]
            if own:
                x = unit_rows(np.stack([vs.iloc[i] for i in at]).astype(float))
                out[at] = np.array(own)[(x @ unit_rows(np.stack([chosen[k] for k in own]).astype(float)).T).argmax(1)]
        return pd.Series(out, dtype="int32")

    cells = stored(groups.select("rep", "v", "n", F.size("v").alias("dim"), nearest("v").alias("cell")), "cells")
    # a cell of any size is cut into slices by hash, small cells of one size share a tile
    sizes = cells.groupBy("dim", "cell").agg(F.count("*").alias("m")).collect()  # at most `pivots` rows for each vector size
    plan, room, current = [], {}, {}
    for r in sorted(sizes, key=lambda r: (r.dim, r.cell)):
        if r.m >= tile // 2 or room.get(r.dim, 0) < r.m:
            parts = max(1, -(-r.m // tile))
            first = len(plan) and plan[-1][4]
            plan.append((r.dim, r.cell, first, parts, first + parts))
            if r.m < tile // 2:
                room[r.dim], current[r.dim] = tile - r.m, first
        else:
            plan.append((r.dim, r.cell, current[r.dim], 1, plan[-1][4]))
            room[r.dim] -= r.m
    where = spark.createDataFrame([p[:4] for p in plan], "dim int, cell int, first long, parts long")
    dealt = cells.join(F.broadcast(where), ["dim", "cell"]).withColumn("tile", F.col("first") + F.pmod(F.xxhash64("v"), F.col("parts")))
    tiles = stored(dealt.select("tile", "rep", "v", "n").groupBy("tile").applyInPandas(
        _tiles, "tile long, dim int, centre array<double>, radius double, ids array<long>, n array<long>, data binary"), "tiles")
    reach = float(np.arccos(threshold)) + 1e-6
    side = lambda s: tiles.select(F.col("tile").alias("left" if s == "l" else "right"), *[F.col(c).alias(f"{c}_{s}") for c in ("dim", "centre", "radius")])
    cosine = F.aggregate(F.zip_with("centre_l", "centre_r", lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    apart = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))
    pairs = side("l").join(side("r"), (F.col("dim_l") == F.col("dim_r")) & (F.col("left") <= F.col("right")))
    pairs = pairs.where((F.col("left") == F.col("right")) | (apart <= F.col("radius_l") + F.col("radius_r") + reach)).select("left", "right")
    load = lambda s: tiles.select(F.col("tile").alias("left" if s == "l" else "right"), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "n", "data")])
    work = pairs.repartition(F.col("left"), F.col("right")).join(load("l"), "left").join(load("r"), "right")
    found = stored(work.mapInPandas(_compare(threshold), "rep long, links long, root long"), "links")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.where("rep <> root"), "rep", "root")
    named = groups.select("rep", "v", "least", "n").join(linked, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = named.join(least, "component").select("v", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.where("v is not null").join(facts, "v").unionByName(rows.where("v is null").select("v", "vec_id", F.col("vec_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
