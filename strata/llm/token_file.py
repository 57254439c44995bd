"""Token files: independent zstandard frames, a trailing seek table, a checksum per frame.

Layout of a shard: magic, frames, table, footer. A frame is the zstd-compressed ids of some
documents; the table (zstd too) lists per frame its place, crc32 and ids, and per document its
key, frame, first id in the frame and number of ids. The footer has the table's size and crc32,
the id width and the magic again. A reader takes the table from the end and decompresses only the
frames that hold documents it wants.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, release, stored
from strata.llm.tokens import Encoder

MAGIC = b"STRTOKZ1"
#: Ids in a frame before it is closed; a document is never split over frames.
FRAME_IDS = 1 << 18
FOOTER = struct.Struct("<QIB8s")  # bytes of the table, its crc32, bytes of an id, magic
FRAMES = np.dtype([("offset", "<u8"), ("bytes", "<u4"), ("crc", "<u4"), ("ids", "<u8")])
DOCS = np.dtype([("key", "<i8"), ("known", "u1"), ("frame", "<u4"), ("first", "<u8"), ("ids", "<u8")])
MANIFEST = "shard long, path string, docs long, tokens long"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a folder in Spark's spelling (file:, hdfs:, s3a:, gs:)."""
    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class ShardWriter:
    """Appends documents to one shard; the file appears under its name only when closed."""

    def __init__(self, store: fs.FileSystem, path: str, attempt: str, id_bytes: int = 4, frame_ids: int = FRAME_IDS, level: int = 3):
        import zstandard

        self.store, self.path, self.part = store, path, f"{path}.{attempt}.part"
        self.out = store.open_output_stream(self.part)
        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.kind, self.id_bytes, self.frame_ids = np.dtype(f"<u{id_bytes}"), id_bytes, frame_ids
        self.at, self.frames, self.docs, self.held, self.size, self.tokens = len(MAGIC), [], [], [], 0, 0
        self.out.write(MAGIC)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.docs.append((key or 0, key is not None, len(self.frames), self.size, len(ids)))
        self.held.append(ids.astype(self.kind))
        self.size += len(ids)
        self.tokens += len(ids)
        if self.size >= self.frame_ids:
            self._frame()

    def _frame(self) -> None:
        if self.held:
            raw = self.zip.compress(np.concatenate(self.held).tobytes())
            self.frames.append((self.at, len(raw), zlib.crc32(raw), self.size))
            self.out.write(raw)
            self.at, self.held, self.size = self.at + len(raw), [], 0

    def close(self) -> None:
        self._frame()
        frames, docs = np.array(self.frames, FRAMES), np.array(self.docs, DOCS)
        table = self.zip.compress(struct.pack("<QQ", len(frames), len(docs)) + frames.tobytes() + docs.tobytes())
        self.out.write(table + FOOTER.pack(len(table), zlib.crc32(table), self.id_bytes, MAGIC))
        self.out.close()
        self.store.move(self.part, self.path)


class ShardReader:
    """Reads a shard's table, then single frames on request; bad checksums raise ValueError."""

    def __init__(self, store: fs.FileSystem, path: str):
        import zstandard

        self.path, self.file, self.unzip = path, store.open_input_file(path), zstandard.ZstdDecompressor()
        size = self.file.size()
        if size < FOOTER.size + len(MAGIC):
            raise ValueError(f"{path}: not a token file")
        length, crc, id_bytes, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        table = self.file.read_at(length, size - FOOTER.size - length) if magic == MAGIC else b""
        if magic != MAGIC or zlib.crc32(table) != crc:
            raise ValueError(f"{path}: damaged seek table")
        raw = self.unzip.decompress(table)
        n, m = struct.unpack_from("<QQ", raw)
        self.frames = np.frombuffer(raw, FRAMES, n, 16)
        self.docs = np.frombuffer(raw, DOCS, m, 16 + n * FRAMES.itemsize)
        self.kind = np.dtype(f"<u{id_bytes}")

    def frame(self, k: int) -> np.ndarray:
        f = self.frames[k]
        raw = self.file.read_at(int(f["bytes"]), int(f["offset"]))
        if zlib.crc32(raw) != f["crc"]:
            raise ValueError(f"{self.path}: frame {k} is damaged")
        return np.frombuffer(self.unzip.decompress(raw), self.kind)

    def read(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(key, ids before it in the shard, ids) of the wanted documents, or of all."""
        before = np.concatenate(([0], np.cumsum(self.docs["ids"])[:-1])).astype(np.int64) if len(self.docs) else []
        rows = np.arange(len(self.docs))
        if wanted is not None:
            rows = rows[np.isin(self.docs["key"], list(wanted)) & (self.docs["known"] == 1)]
        last, ids = -1, None
        for r in rows:
            d = self.docs[r]
            if d["frame"] != last:
                last, ids = int(d["frame"]), self.frame(int(d["frame"]))
            yield int(d["key"]) if d["known"] else None, int(before[r]), ids[int(d["first"]) : int(d["first"] + d["ids"])]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_bytes: int | None = None,
                      frame_ids: int = FRAME_IDS, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes all documents in ascending key order, one shard per range of keys; returns the manifest.

    Rows are range-partitioned by (key, hash of the text, row), so one key with very many rows is
    spread too; NULL keys come first. NULL and empty texts hold ``end_id`` alone. A task writes to
    a file of its own attempt and renames it, so a lost or repeated task leaves one whole shard.
    An empty table gives an empty manifest or empty shards; other columns are ignored. Very long
    texts are one document in one frame. Ids are stored in ``id_bytes`` bytes, by default in 2 if
    the vocabulary is small enough, else in 4.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    if id_bytes is None:
        from tokenizers import Tokenizer

        id_bytes = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else 4
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encoder, out = TaskContext.get(), Encoder.get(tokenizer), None
        store, root = open_store(folder)
        shard = task.partitionId()
        path = f"{root}/shard-{shard:06d}.tokz"
        for batch in batches:
            flat, n = encoder.encode(batch.column(1).to_pylist())
            out = out or ShardWriter(store, path, f"{task.taskAttemptId()}", id_bytes, frame_ids)
            for key, ids in zip(batch.column(0).to_pylist(), np.split(flat, np.cumsum(n)[:-1]) if len(n) else [], strict=True):
                out.add(key, np.append(ids, end_id))
        release()
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((shard, pa.int64()), (path, pa.string()), (len(out.docs), pa.int64()), (out.tokens, pa.int64()))], names=["shard", "path", "docs", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("r", F.monotonically_increasing_id())
    keys = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("r")]
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    return stored(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, wanted: Iterable[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids of the stored documents.

    A shard is a task of its own, read frame by frame. ``wanted`` restricts the frames that are
    decompressed. The window that adds up the shards' ids has one row a shard.
    """
    bounded_batches(spark)
    n = max(1, manifest.count())  # a number that is asked for stays: else so few rows would all go to one task
    keys = None if wanted is None else set(wanted)
    base = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("shard", "path", F.coalesce(base, F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, _ = open_store(folder)
                held: list[tuple] = []
                for key, before, ids in ShardReader(store, path).read(keys):
                    held.append((key, base + before, len(ids), ids.astype("<u4").tobytes()))
                    if len(held) == 512:
                        yield _rows(held)
                        held = []
                if held:
                    yield _rows(held)

    return shards.repartitionByRange(n, "shard").select("path", "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), kinds, strict=True)], names=["doc_id", "start", "n_tokens", "ids"])


def token_digests(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
