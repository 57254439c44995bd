"""Ingestion manifest: one entry per landing source; a small file on any storage that Spark reads."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources.files import read_text


@dataclass(frozen=True)
class SourceSpec:
    source_name: str
    source_path: str
    file_format: str                  # csv | json
    schema_location: str | None = None
    delimiter: str | None = None
    header: bool | None = None
    multiline: bool | None = None
    checkpoint_path: str | None = None
    partition_by: str | None = None   # declared; applied only when asked (see ingest)
    target_table: str = ""
    active: bool = True

    @property
    def table_name(self) -> str:
        """Last dotted part of ``target_table`` (the bronze table name)."""
        return (self.target_table or self.source_name).split(".")[-1]

    @classmethod
    def from_dict(cls, d: Mapping) -> SourceSpec:
        known = {f for f in cls.__dataclass_fields__}
        return cls(**{k: v for k, v in d.items() if k in known})

    def at(self, **paths) -> SourceSpec:
        return replace(self, **paths)


def _json(path: str):
    """A JSON file through Spark's file systems; without a session yet, one on this machine."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        with open(path) as f:
            return json.load(f)
    return json.loads(read_text(spark, path))


def load_manifest(path: str) -> list[SourceSpec]:
    return [SourceSpec.from_dict(d) for d in _json(path)]


def active_specs(specs) -> list[SourceSpec]:
    return [s for s in specs if s.active]


def schema_from_mapping(columns: Mapping[str, str] | list[str]) -> StructType:
    """Landing schema: the declared column names, every one a nullable string."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def load_schema(path: str) -> StructType:
    """Schema file = JSON object column -> type name; types are ignored (all strings)."""
    return schema_from_mapping(_json(path))
