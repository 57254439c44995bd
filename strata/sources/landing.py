"""Landing-file readers (CSV ',' / CSV '|' / multiline JSON) and writers.

Readers honour the manifest options the way the original loader does: a delimiter is
set only when truthy, header/multiline only when not None. With an explicit schema
Spark maps CSV columns by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources.manifest import SourceSpec


def _options(spec: SourceSpec) -> dict[str, str]:
    opts: dict[str, str] = {}
    if spec.delimiter:
        opts["delimiter"] = spec.delimiter
    if spec.header is not None:
        opts["header"] = str(spec.header).lower()
    if spec.multiline is not None:
        opts["multiLine"] = str(spec.multiline).lower()
    return opts


def read_landing(spark: SparkSession, spec: SourceSpec, schema: StructType,
                 stream: bool = False, **extra) -> DataFrame:
    """Batch or incremental (``readStream``) scan of a landing folder with a fixed schema."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format(spec.file_format).schema(schema).options(**_options(spec))
    if extra:
        reader = reader.options(**{k: str(v) for k, v in extra.items()})
    return reader.load(spec.source_path)


def write_csv(df: DataFrame, path: str, delimiter: str = ",", header: bool = True,
              mode: str = "overwrite", compression: str | None = None) -> None:
    """Landing CSV exactly as given: no whitespace trimming, NULL as an empty field."""
    (df.write.mode(mode)
       .option("compression", compression or "none")
       .option("delimiter", delimiter).option("header", str(header).lower())
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .csv(path))


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Multiline-JSON landing files: each output file is one JSON array of records.

    Records are encoded JVM-side (``to_json``); a per-partition Pandas pass only adds
    the brackets and commas, so every partition becomes one array file; repartition
    ``df`` to size the files.
    """
    def json_array_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Defined here so it is shipped to the workers by value (workers need not
        # import this package). Streams batch by batch, holding back only the last
        # record, so memory stays at one Arrow batch whatever the partition size.
        import pandas as pd

        pending, first = None, True
        for pdf in batches:
            out = []
            for rec in pdf["j"]:
                if pending is not None:
                    out.append(("[" if first else "") + pending + ",")
                    first = False
                pending = rec
            if out:
                yield pd.DataFrame({"value": out})
        if pending is not None:
            yield pd.DataFrame({"value": [("[" if first else "") + pending + "]"]})

    records = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("j"))
    records.mapInPandas(json_array_lines, "value string").write.mode(mode).text(path)


def publish_files(spark: SparkSession, staged_dir: str, landing_dir: str, prefix: str = "") -> int:
    """Move the data files of a staged write into a watched landing folder.

    A rename is atomic per file, so an incremental scan never sees a half-written file.
    Driver-side metadata operation only; returns the number of files moved.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(staged_dir)
    dst = jvm.org.apache.hadoop.fs.Path(landing_dir)
    fs = src.getFileSystem(conf)
    fs.mkdirs(dst)
    moved = 0
    for st in fs.listStatus(src):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith((".", "_")):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(dst, prefix + name))
            moved += 1
    return moved
