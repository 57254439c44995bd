"""Names, markers and folders on the file system that Spark's paths are on (shared on a cluster)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    """Hadoop's Path class and the file system of ``path``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop, hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = filesystem(spark, path)
    return fs.exists(hadoop(path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out; none if there is no such folder."""
    hadoop, fs = filesystem(spark, path)
    if not fs.exists(hadoop(path)):
        return []
    return sorted(n for s in fs.listStatus(hadoop(path)) if not (n := s.getPath().getName()).startswith((".", "_")))


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file, wherever Spark can read it."""
    rows = spark.read.text(path, wholetext=True).head(1)
    return rows[0][0] if rows else ""


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole, by a rename; one that is there already is replaced."""
    hadoop, fs = filesystem(spark, path)
    folder, _, name = path.rpartition("/")
    part = hadoop(f"{folder}/.{name}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(hadoop(path), False)
    if not fs.rename(part, hadoop(path)):
        raise OSError(f"cannot write {path}")


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path; 0 if it does not exist."""
    hadoop, fs = filesystem(spark, path)
    return fs.getContentSummary(hadoop(path)).getLength() if fs.exists(hadoop(path)) else 0


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a folder; the parent of its new name is made."""
    hadoop, fs = filesystem(spark, path)
    fs.mkdirs(hadoop(to).getParent())
    if not fs.rename(hadoop(path), hadoop(to)):
        raise OSError(f"cannot move {path} to {to}")


def delete(spark: SparkSession, path: str) -> None:
    hadoop, fs = filesystem(spark, path)
    fs.delete(hadoop(path), True)
