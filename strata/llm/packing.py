"""Packing documents into training windows: best-fit decreasing over open windows.

Each task packs its own input split in blocks of bounded size, so no row is shuffled and a lost
task is simply run again. In a block, overlong documents are first cut into
full windows; the rest, longest first, go each to the tightest open window that has room, found
by a segment tree indexed by remaining capacity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, release
from strata.llm.tokens import Encoder

SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, ids binary")
#: Ids that one block holds (8 MB); a block is packed and emitted before the next is read.
BLOCK_IDS = 2_000_000


class CapacityTree:
    """Open windows by remaining capacity; ``tightest(need)`` is the least capacity >= need."""

    def __init__(self, width: int):
        self.size = 1 << width.bit_length()
        self.windows: list[list[int]] = [[] for _ in range(width + 1)]
        self.filled = [0] * (2 * self.size)  # open windows below each node

    def _count(self, capacity: int, by: int) -> None:
        node = self.size + capacity
        while node:
            self.filled[node] += by
            node >>= 1

    def put(self, window: int, capacity: int) -> None:
        if capacity:
            self.windows[capacity].append(window)
            self._count(capacity, 1)

    def tightest(self, need: int) -> int | None:
        """The least remaining capacity of an open window that is ``need`` or more."""
        node = self.size + need
        if not self.filled[node]:
            while node > 1 and (node & 1 or not self.filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not self.filled[node]:
                    node += 1
        return node - self.size

    def take(self, capacity: int) -> int:
        self._count(capacity, -1)
        return self.windows[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, width: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, window, offset) that hold each token of each document once.

    Ties between documents of one length go by position, so the result depends on input order only.
    """
    out, rest, window = [], [], 0
    for d, n in enumerate(lengths.tolist()):
        for k in range(n // width):
            out.append((d, k * width, width, window, 0))
            window += 1
        if n % width:
            rest.append((-(n % width), d, n - n % width))
    tree = CapacityTree(width)
    for minus, d, start in sorted(rest):
        n = -minus
        if (capacity := tree.tightest(n)) is None:
            at, capacity, window = window, width, window + 1
        else:
            at = tree.take(capacity)
        out.append((d, start, n, at, width - capacity))
        tree.put(at, capacity - n)
    return out


def _emit(docs: list, ids: list[np.ndarray], width: int, first: int) -> tuple[pa.RecordBatch, int]:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    pieces = best_fit_decreasing(lengths, width)
    total: dict[int, int] = {}
    for _, _, n, w, _ in pieces:
        total[w] = total.get(w, 0) + n
    cols = list(zip(*pieces, strict=True)) or [()] * 5
    d, start, n, w, at = cols
    long = lambda x: pa.array(x, pa.int64())
    batch = pa.RecordBatch.from_arrays(
        [long([docs[i] for i in d]), long(start), long(n), long([lengths[i] for i in d]), long([first + x for x in w]),
         long(at), long([total[x] for x in w]), pa.array([ids[i][s : s + m].tobytes() for i, s, m in zip(d, start, n, strict=True)], pa.binary())],
        names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "ids"])
    return batch, first + len(total)


def pack(docs: DataFrame, tokenizer: str, width: int = 2048, end_id: int = 1, block_ids: int = BLOCK_IDS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in windows of ``width`` ids; one row per piece, with its ids.

    ``ids`` are little-endian unsigned 32-bit integers; a document's ids end with ``end_id``.
    ``sequence_id`` is unique over the table (split number and count within it) and
    ``sequence_tokens`` is how much of that window is used; the rest is padding.
    NULL and empty texts are one piece with ``end_id`` alone. Each row is a document of its own,
    also when ids repeat or are NULL. An empty table gives no rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder.get(tokenizer)
        first, names, held, size = TaskContext.get().partitionId() << 36, [], [], 0
        for batch in batches:
            flat, n = encoder.encode(batch.column(1).to_pylist())
            for key, ids in zip(batch.column(0).to_pylist(), np.split(flat, np.cumsum(n)[:-1]) if len(n) else [], strict=True):
                names.append(key)
                held.append(np.append(ids, np.uint32(end_id)).astype("<u4"))
                size += len(held[-1])
                if size >= block_ids:
                    out, first = _emit(names, held, width, first)
                    yield out
                    names, held, size = [], [], 0
        if held:
            yield _emit(names, held, width, first)[0]
        del held, names
        release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The contract's columns, with a crc32 in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
