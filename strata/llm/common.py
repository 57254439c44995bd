"""Helpers shared by the operators: shared scratch tables, batch sizes, word hashing."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import suppress
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
#: Rows of keys, numbers and hashes for which a scratch table gets a file.
FILE_ROWS = 50_000


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: texts can be long, and a batch is held whole by a worker.

    Workers on this machine also find this package where the driver has it; on a cluster it is
    shipped with ``--py-files`` or installed.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release() -> None:
    """Give memory that this worker no longer uses back to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset, a private folder is made for a
    local master; on a cluster that would lose rows, so it raises there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        root = tempfile.mkdtemp(prefix="strata-llm-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}" if spark.sparkContext.master.startswith("local") else root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written to a new shared table and read back: lineage ends here.

    ``rows``: so many narrow rows at most. The table then has files in step with them, where each
    partition of the last shuffle would otherwise write a file of its own, however few rows it has.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(1 + rows // FILE_ROWS)
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder_is(key: Column, modulus: int, rest: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``, equals ``rest``; false for a NULL key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def byte_slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive [a, b) ranges of rows whose lengths sum to about ``most`` (one row at least)."""
    a, n = 0, len(lengths)
    ends = np.cumsum(lengths)
    while a < n:
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right"))
        b = max(b, a + 1)
        yield a, b
        a = b


_STEP = 0x9E3779B97F4A7C15
_TABLES: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambling of unsigned integers (splitmix64's output function)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant and of its inverse modulo 2**64, at least ``n`` of them."""
    if len(_TABLES.get("pow", ())) < n:
        n = max(n, 1 << 20)
        for name, base in (("pow", _STEP), ("inv", pow(_STEP, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.cumprod(steps)
    return _TABLES["pow"], _TABLES["inv"]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of codes[start:end] for each span; equal content, equal hash."""
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix64(codes.astype(np.uint64) + np.uint64(_STEP)) * up[: len(codes)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _alnum() -> np.ndarray:
    if "alnum" not in _TABLES:
        _TABLES["alnum"] = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
        _TABLES["alpha"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _TABLES["alnum"]


def is_alpha(codes: np.ndarray) -> np.ndarray:
    _alnum()
    return _TABLES["alpha"][codes]


class Words:
    """Words (runs of letters and digits, lower case) of a batch of texts as numpy arrays.

    ``hash``: 64-bit hash of each word; ``doc``: index of its text; ``starts`` and ``ends``:
    its place in ``codes``, the code points of all texts joined by line breaks.
    """

    def __init__(self, texts: list[str]):
        joined = "\n".join(t.lower() for t in texts)
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = np.zeros(len(self.codes) + 2, np.int8)
        inside[1:-1] = _alnum()[self.codes]
        edge = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sizes = np.fromiter((len(t.lower()) + 1 for t in texts), np.int64, len(texts))
        self.text_ends = np.cumsum(sizes)
        self.doc = np.searchsorted(self.text_ends, self.starts, side="right")
        self.hash = span_hashes(self.codes, self.starts, self.ends)
        self.n_docs = len(texts)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of each run of ``width`` words that lies in one text, in text order."""
    n = len(words.hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mix64(out * np.uint64(_STEP) + words.hash[i : i + n] + np.uint64(i + 1))
    whole = words.doc[:n] == words.doc[width - 1 :]
    return out[whole], words.doc[:n][whole]
