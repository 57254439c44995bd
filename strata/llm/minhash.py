"""Near-duplicate documents by ProbMinHash signatures of weighted word shingles.

Every distinct shingle of a text sends out a Poisson process whose rate is its number of
occurrences; each arrival falls on a random register, and a register keeps the shingle that came
first. An element stops once its next arrival is later than all registers hold. Two texts agree in
a register with probability equal to their probability Jaccard similarity, so banded registers
find candidates, and candidates are verified exactly on the shingles of the whole texts.

Equal texts are one node. In a bucket, all nodes are first compared with its least node; only
where that leaves a bucket in several components are further pairs looked for, tile by tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Words, bounded_batches, byte_slices, free_name, mix64, release, shingles, stored
from strata.llm.components import components

WIDTH = 5
THRESHOLD = 0.8
#: Candidates of similarity 0.8 share a band with probability 1 - (1 - 0.8**4)**20 = 0.99997.
BANDS, ROWS = 20, 4
#: Members of a tile when a bucket needs more than one comparison a node.
TILE = 128
#: Up to so many dropped rows (key and hash, 16 bytes each) are broadcast to the texts; more are joined by a shuffle.
BROADCAST_KEYS = 500_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, shingle hash, occurrences) sorted by text and hash, and a hash of each text's words.

    A text of fewer than ``width`` words is one shingle of its own; without a word it has none,
    and its hash is 0.
    """
    words = Words(texts)
    hashed, doc = shingles(words, width)
    count = np.bincount(words.doc, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    place = np.arange(len(words.doc)) - first[words.doc]
    whole = np.zeros(len(texts), np.uint64)
    np.add.at(whole, words.doc, mix64(words.hash ^ mix64(place.astype(np.uint64) + _GOLD)))
    whole[count > 0] = mix64(whole[count > 0] + count[count > 0].astype(np.uint64)) | np.uint64(1)
    short = np.flatnonzero((count > 0) & (count < width))
    hashed, doc = np.concatenate((hashed, whole[short])), np.concatenate((doc, short))
    order = np.lexsort((hashed, doc))
    doc, hashed = doc[order], hashed[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashed[at], np.diff(np.append(at, len(doc))), whole


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """(n, registers) hashes of the elements whose process arrives first in each register; 0 without elements."""
    first = np.full(n * registers, np.inf)
    kept = np.zeros(n * registers, np.uint64)
    latest = np.full(n, np.inf)
    time, step = np.zeros(len(doc)), 0
    while len(doc):
        step += 1
        draw = mix64(element + np.uint64(step * int(_GOLD) & (2**64 - 1)))
        time = time - np.log(_uniform(draw)) / weight
        live = time < latest[doc]  # later than every register: this element and its later arrivals cannot matter
        doc, element, weight, time, draw = doc[live], element[live], weight[live], time[live], draw[live]
        slot = doc * registers + (mix64(draw) % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(time < first[slot])
        np.minimum.at(first, slot[better], time[better])
        won = better[first[slot[better]] == time[better]]
        kept[slot[won]] = element[won]
        latest = first.reshape(n, registers).max(1)
    return kept.reshape(n, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two sorted weighted sets (hashes, weights)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    ratio = np.divide(x, y, out=np.full(len(keys), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    above = np.append(np.cumsum(x[::-1])[::-1], 0.0)  # weights of the first set from each place on
    below = np.append(0.0, np.cumsum(y))
    both = (x > 0) & (y > 0)
    at = np.searchsorted(ratio, ratio[both], side="left")
    return float((1 / (above[at] / x[both] + below[at] / y[both])).sum())


def signatures(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(d, h, c1, c2, sig): key, hash of the text, hashes of its words, 32-bit registers; c1 is 0 without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            for a, b in byte_slices(sizes, 1 << 20):
                doc, element, weight, whole = weighted_shingles(texts[a:b], width)
                sums = np.zeros(b - a, np.uint64)
                np.add.at(sums, doc, mix64(element) * weight.astype(np.uint64))  # a second view of the same words
                sig = (prob_minhash(doc, element, weight, b - a) >> np.uint64(32)).astype("<u4")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(whole.view(np.int64)), pa.array(sums.view(np.int64)),
                                                  pa.array([r.tobytes() for r in sig], pa.binary())], names=["d", "h", "c1", "c2", "sig"])
            release()

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64(text).alias("h"), text.alias("t")).mapInArrow(run, "d long, h long, c1 long, c2 long, sig binary")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
            sizes = np.fromiter((len(x) + len(y) for x, y in zip(left, right, strict=True)), np.int64, len(left))
            for a, b in byte_slices(sizes, 1 << 20):
                names = sorted(set(left[a:b]) | set(right[a:b]))
                place = {t: k for k, t in enumerate(names)}
                doc, element, weight, _ = weighted_shingles(names, width)
                cut = np.searchsorted(doc, np.arange(len(names) + 1))
                side = lambda t: slice(cut[place[t]], cut[place[t] + 1])
                like = [probability_jaccard((element[side(x)], weight[side(x)]), (element[side(y)], weight[side(y)])) >= threshold - 1e-12 for x, y in zip(left[a:b], right[a:b], strict=True)]
                rows = pa.array(np.flatnonzero(like) + a)
                yield pa.RecordBatch.from_arrays([batch.column("a").take(rows), batch.column("b").take(rows)], names=["a", "b"])
            release()

    sized = pairs.join(texts.select(F.col("rep").alias("b"), F.col("t").alias("tb")), "b").join(texts.select(F.col("rep").alias("a"), F.col("t").alias("ta")), "a")
    return sized.select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def _packed(width: int):
    """One row for a tile: its members' nodes, components, registers and weighted shingles."""

    def pack(table: pa.Table) -> pa.Table:
        doc, element, weight, _ = weighted_shingles(table.column("t").to_pylist(), width)
        size = np.bincount(doc, minlength=table.num_rows)
        cells = [table.column("bucket")[0], table.column("chunk")[0], table.column("rep").to_pylist(), table.column("comp").to_pylist(),
                 b"".join(table.column("sig").to_pylist()), size.tolist(), element.astype("<u8").tobytes(), weight.astype("<u4").tobytes()]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array([c.as_py() if isinstance(c, pa.Scalar) else c], k) for c, k in zip(cells, kinds, strict=True)], names=_TILE_NAMES)

    return pack


_TILE_NAMES = ["bucket", "chunk", "reps", "comps", "sigs", "sizes", "elements", "weights"]
_TILE_SCHEMA = "bucket long, chunk int, reps array<long>, comps array<long>, sigs binary, sizes array<int>, elements binary, weights binary"


class _Tile:
    def __init__(self, row: dict, side: str):
        self.reps, self.comps = row[f"reps_{side}"], row[f"comps_{side}"]
        self.sigs = np.frombuffer(row[f"sigs_{side}"], "<u4").reshape(len(self.reps), -1)
        cuts = np.cumsum(row[f"sizes_{side}"])[:-1]
        self.sets = list(zip(np.split(np.frombuffer(row[f"elements_{side}"], "<u8"), cuts), np.split(np.frombuffer(row[f"weights_{side}"], "<u4"), cuts), strict=True))


def _linked_tiles(threshold: float):
    """Verified links between two tiles' members of different components, no more than join them up.

    A pair is looked at in the first band only in which it meets, and if its registers do not rule
    out the threshold by six standard deviations; a pair that is joined up already is left out.
    """
    least = threshold - 6 * (threshold * (1 - threshold) / (BANDS * ROWS)) ** 0.5

    def links(row: dict) -> Iterator[tuple[int, int]]:
        x = _Tile(row, "l")
        y = _Tile(row, "r") if row["i"] != row["j"] else x
        same = x.sigs[:, None, :] == y.sigs[None, :, :]
        meets = same.reshape(*same.shape[:2], BANDS, ROWS).all(3)
        here = (meets.argmax(2) == row["band"]) & meets.any(2) & (same.mean(2) >= least)
        up: dict[int, int] = {}

        def top(c: int) -> int:
            while c in up:
                c = up[c]
            return c

        for i, j in zip(*np.nonzero(here), strict=True):
            a, b = top(x.comps[i]), top(y.comps[j])
            if a != b and probability_jaccard(x.sets[i], y.sets[j]) >= threshold - 1e-12:
                up[max(a, b)] = min(a, b)
                yield max(x.reps[i], y.reps[j]), min(x.reps[i], y.reps[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [e for k in range(batch.num_rows) for e in links(batch.slice(k, 1).to_pylist()[0])]
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _more_links(members: DataFrame, reps: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """Links inside buckets (bucket, band, rep, comp, main, size) that join up several components.

    A bucket's members are dealt by hash to tiles of bounded size, those in its centre's component
    (``main``) apart. Two tiles of main members have nothing to join; all other pairs of tiles are compared,
    each in a row of its own, and no pair of members leaves its task unless it is a link.
    """
    spark = members.sparkSession
    dealt = members.withColumn("chunk", (2 * F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / TILE)) + F.col("main").cast("int")).cast("int"))
    full = dealt.join(reps.select("rep", "sig"), "rep").join(texts, "rep").select("bucket", "chunk", "rep", "comp", "sig", "t")
    tiles = stored(full.groupBy("bucket", "chunk").applyInArrow(_packed(width), _TILE_SCHEMA), "tiles")
    index = dealt.select("bucket", "band", "chunk").distinct()
    other = F.col("chunk") % 2 == 0
    work = index.where(other).withColumnRenamed("chunk", "i").join(index.select("bucket", F.col("chunk").alias("j")), "bucket").where("j % 2 = 1 or i <= j")
    side = lambda k, at: tiles.select("bucket", F.col("chunk").alias(at), *[F.col(c).alias(f"{c}_{k}") for c in _TILE_NAMES[2:]])
    rows = work.join(side("l", "i"), ["bucket", "i"]).join(side("r", "j"), ["bucket", "j"])
    name, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(name, "4")  # a row holds two tiles of texts
    try:
        return stored(rows.mapInArrow(_linked_tiles(threshold), "a long, b long").distinct(), "more-links")
    finally:
        spark.conf.set(name, before)


def near_duplicates(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, h, component, origin): for each row its key and hash of its text, its class and the row that stands for it.

    Texts are linked if the probability Jaccard similarity of their weighted ``width``-word
    shingles (words: runs of letters and digits, lower case) is ``threshold`` or more, classes are
    the connected components. ``component`` is NULL for texts without a word, which are in no class.
    ``origin`` is the least (key, hash) of the class.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    sigs = stored(signatures(docs, width, id_col, text_col), "signatures")
    n = 8 * sigs.count()  # for files, a row with its registers counts as several
    key = F.struct("d", "h")
    reps = sigs.where("c1 <> 0").groupBy("c1", "c2").agg(F.min(key).alias("least"), F.first("sig").alias("sig"))
    reps = stored(reps.withColumn("rep", F.monotonically_increasing_id()), "texts", n)
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(F.col("sig"), k * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    members = reps.select("rep", F.posexplode(bands).alias("band", "bucket"))
    buckets = members.groupBy("bucket").agg(F.min("rep").alias("centre"), F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(buckets, "bucket"), "buckets", BANDS * reps.count())
    size = members.count()
    stars = stored(members.where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct(), "stars", size)
    used = members.select("rep").distinct().join(reps.select("rep", "least"), "rep").select("rep", F.col("least.d").alias("d2"), F.col("least.h").alias("h2"))
    text = F.col(text_col).cast("string")
    whole = docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64(text).alias("h"), text.alias("t")).join(used, F.expr("d <=> d2 and h = h2"))
    texts = stored(whole.select("rep", "t").dropDuplicates(["rep"]), "candidates")
    edges = stored(_verified(stars, texts, width, threshold), "edges")
    classes = components(edges)
    # buckets of three or more that are still in several components
    named = members.where("size > 2").join(classes, F.col("rep") == F.col("node"), "left").select("bucket", "band", "rep", "centre", "size", F.coalesce("component", "rep").alias("comp"))
    split = named.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max(F.when(F.col("rep") == F.col("centre"), F.col("comp"))).alias("of_centre"))
    rest = stored(named.join(split.where("x <> y"), "bucket").withColumn("main", F.col("comp") == F.col("of_centre")).select("bucket", "band", "rep", "comp", "main", "size"), "unresolved", size)
    if not rest.isEmpty():
        more = _more_links(rest, reps, texts, width, threshold)
        if not more.isEmpty():  # the classes so far are stars already, which leaves few rounds
            known = classes.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            classes = components(known.unionByName(more))
    named = reps.join(classes, F.col("rep") == F.col("node"), "left").select("c1", "c2", "least", F.coalesce("component", "rep").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("origin"))
    facts = stored(named.join(least, "component").select("c1", "c2", "component", "origin"), "classes", n)
    return sigs.select("d", "h", "c1", "c2").join(facts, ["c1", "c2"], "left").select("d", "h", "component", "origin")


def duplicate_classes(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, kept for each row; class_id is the smallest key of the row's class.

    One row of a class is kept, the one with the least (key, hash of the text), NULL keys first;
    rows with equal key and text are all marked alike. NULL texts and texts without a word are in
    a class of their own and kept. Other columns are ignored; an empty table gives no rows.
    """
    rows = near_duplicates(docs, width, threshold, id_col, text_col)
    kept = F.col("component").isNull() | F.struct("d", "h").eqNullSafe(F.col("origin"))
    return rows.select(F.col("d").alias("doc_id"), F.when(F.col("component").isNull(), F.col("d")).otherwise(F.col("origin.d")).alias("class_id"), kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class; texts without a word all stay.

    The row that stays has the least (key, hash of the text); of several such rows, equal in both, one.
    What goes is decided on keys and hashes; texts move only where equal rows must be found.
    NULL, empty and very long texts are treated as in ``near_duplicates``.
    """
    rows = near_duplicates(docs, width, threshold, id_col, text_col)
    key, hashed = (free_name(docs, x) for x in ("_d", "_h"))
    classed = rows.where("component is not null")
    gone = classed.where(~F.struct("d", "h").eqNullSafe(F.col("origin"))).select(F.col("d").alias(key), F.col("h").alias(hashed)).distinct()
    gone = stored(gone, "dropped")
    if gone.count() <= BROADCAST_KEYS:  # texts are then filtered where they are read
        gone = F.broadcast(gone)
    text = docs[text_col].cast("string")
    stay = docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone[key]) & (F.xxhash64(text) == gone[hashed]), "left_anti")
    unique = classed.groupBy("d", "h").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    if unique:
        return stay
    words = F.coalesce(F.col(text_col).cast("string").rlike(r"[\p{L}\p{N}]"), F.lit(False))
    once = stay.where(words).withColumns({key: F.col(id_col).cast("long"), hashed: F.xxhash64(F.col(text_col).cast("string"))}).dropDuplicates([key, hashed]).drop(key, hashed)
    return once.unionByName(stay.where(~words))
