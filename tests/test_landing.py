"""Landing-file edge cases: positional CSV mapping, short/extra fields, JSON arrays, empty folders."""

import os

import pytest

from strata import vocab
from strata.sources.landing import read_landing
from strata.sources.manifest import SourceSpec, active_specs, load_manifest, load_schema

SCHEMA = vocab.string_schema(("a", "b", "c"))


def spec(path, fmt="csv", **kw):
    return SourceSpec("s", path, fmt, **kw)


def put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def local(scratch):
    assert scratch.startswith("file:")
    return scratch[len("file:"):]


def test_csv_maps_by_position_and_pads(spark, scratch):
    d = local(scratch) + "/csv"
    put(d, "x.csv", "c,b,a\n1,2,3\n4,5\n6,7,8,9\n")
    rows = read_landing(spark, spec(d, delimiter=",", header=True), SCHEMA).collect()
    got = sorted(tuple(r) for r in rows)
    # header names are ignored with an explicit schema: first field -> first column
    assert got == [("1", "2", "3"), ("4", "5", None), ("6", "7", "8")]


def test_csv_header_check_can_be_enforced(spark, scratch):
    d = local(scratch) + "/csv_strict"
    put(d, "x.csv", "c,b,a\n1,2,3\n")
    with pytest.raises(Exception):
        read_landing(spark, spec(d, delimiter=",", header=True), SCHEMA, enforceSchema=False).collect()


def test_pipe_delimited_txt(spark, scratch):
    d = local(scratch) + "/pipe"
    put(d, "users.txt", "a|b|c\nPerez, Ana|x|\n")
    assert [tuple(r) for r in read_landing(spark, spec(d, delimiter="|", header=True), SCHEMA).collect()] \
        == [("Perez, Ana", "x", None)]


def test_json_array_is_one_row_per_element(spark, scratch):
    d = local(scratch) + "/json"
    put(d, "m.json", '[\n {"a": "1", "b": "  "},\n {"a": "2", "c": "z"}\n]\n')
    rows = read_landing(spark, spec(d, "json", multiline=True), SCHEMA).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "  ", None), ("2", None, "z")]


def test_empty_folder_reads_nothing(spark, scratch):
    d = local(scratch) + "/empty"
    os.makedirs(d)
    assert read_landing(spark, spec(d, delimiter=",", header=True), SCHEMA).count() == 0


def test_manifest_and_schema_files(scratch):
    d = local(scratch) + "/meta"
    put(d, "schema.json", '{"a": "STRING", "b" : "STRING", "c": "INT"}')
    put(d, "manifest.json", f'''[
      {{"source_name": "s", "source_path": "{d}/in", "file_format": "csv", "delimiter": ",",
        "header": true, "multiline": false, "schema_location": "{d}/schema.json",
        "checkpoint_path": "{d}/ck", "partition_by": "a", "target_table": "cat.bronze.s_tbl",
        "active": true}},
      {{"source_name": "t", "source_path": "{d}/in2", "file_format": "json", "delimiter": null,
        "header": null, "multiline": true, "schema_location": "{d}/schema.json",
        "target_table": "cat.bronze.t_tbl", "active": false}}]''')
    specs = load_manifest(f"{d}/manifest.json")
    assert [s.table_name for s in active_specs(specs)] == ["s_tbl"]
    schema = load_schema(f"{d}/schema.json")
    assert [f.name for f in schema.fields] == ["a", "b", "c"]
    assert all(f.dataType.simpleString() == "string" and f.nullable for f in schema.fields)


def test_ingest_partitioned_by_declared_column(spark, scratch):
    """The manifest's partition column, applied on request, gives one folder per value."""
    from strata.sources.bronze import read_bronze
    from strata.sources.testdata import fixture_manifest, raw_frame, write_fixture_landing
    from strata.streaming.ingest import start_ingest
    from tests.conftest import SF_SMALL
    from tests.helpers import multiset

    write_fixture_landing(spark, SF_SMALL, f"{scratch}/src")
    users = [s for s in fixture_manifest(f"{scratch}/src") if s.source_name == "users"][0]
    q = start_ingest(spark, users, f"{scratch}/bronze_users", vocab.USERS_SCHEMA,
                     f"{scratch}/ckpt", partition_by=True)
    q.awaitTermination()
    assert q.exception() is None
    folders = {p.split("=")[0] for p in os.listdir(local(scratch) + "/bronze_users") if "=" in p}
    assert folders == {"_part_country"}
    got = read_bronze(spark, f"{scratch}/bronze_users").select(*vocab.USER_COLUMNS)
    want = raw_frame(spark, SF_SMALL, "users")
    assert multiset(got.columns, got.collect()) == multiset(want.columns, want.collect())


def test_bronze_row_ids_unique_flat_and_partitioned(spark, scratch):
    from pyspark.sql import functions as F

    from strata.sources.bronze import read_bronze

    df = spark.range(0, 500).select(F.col("id").cast("string").alias("k"),
                                    (F.col("id") % 3).cast("string").alias("p"))
    for _ in range(2):                       # two appends: same file row indexes, new names
        df.repartition(4).write.mode("append").parquet(f"{scratch}/flat")
        df.repartition(4).write.mode("append").partitionBy("p").parquet(f"{scratch}/parted")
    for name in ("flat", "parted"):
        b = read_bronze(spark, f"{scratch}/{name}")
        assert b.select(vocab.ROW_ID).distinct().count() == b.count() == 1000


def test_partitioned_bronze_reads_like_a_flat_one(spark, scratch):
    """Empty texts stay apart from NULL and dates stay texts, so verdicts do not change."""
    from strata.operators.entities import MERCHANTS
    from strata.operators.quarantine import parse_record, rejected
    from strata.operators.silver import silver
    from strata.sources.bronze import partitioned, read_bronze
    from tests.helpers import multiset

    rows = [(f"M{i}", "Shop", "retail", ["", None, "PE", "co", "US"][i % 5], f"2024-01-{i + 1:02d}", "activo", "bajo") for i in range(20)]
    df = spark.createDataFrame(rows, vocab.MERCHANTS_SCHEMA)
    df.write.parquet(f"{scratch}/flat")
    for column in ("country", "affiliation_date"):
        parted, folder = partitioned(df, column)
        parted.write.partitionBy(folder).parquet(f"{scratch}/{column}")
        flat, read = (read_bronze(spark, f"{scratch}/{n}") for n in ("flat", column))
        assert read.columns == flat.columns and read.dtypes[:-1] == flat.dtypes[:-1]
        for build in (lambda b: silver(b, MERCHANTS, "2024-12-31"), lambda b: parse_record(rejected(b, MERCHANTS), MERCHANTS)):
            got, want = build(read), build(flat)
            assert multiset(got.columns, got.collect()) == multiset(want.columns, want.collect())


def test_manifest_settings_are_honoured(spark, scratch):
    """The declared checkpoint folder and partition column are used end to end."""
    from dataclasses import replace

    from strata.sources.bronze import read_bronze
    from strata.sources.testdata import fixture_manifest, write_fixture_landing
    from strata.streaming.ingest import ingest_manifest
    from tests.conftest import SF_SMALL

    write_fixture_landing(spark, SF_SMALL, f"{scratch}/src")
    specs = [replace(s, checkpoint_path=f"{scratch}/declared/{s.source_name}") for s in fixture_manifest(f"{scratch}/src") if s.source_name != "transactions"]
    schemas = {"users": vocab.USERS_SCHEMA, "merchants": vocab.MERCHANTS_SCHEMA}
    for _ in range(2):
        paths = ingest_manifest(spark, specs, f"{scratch}/b", schemas, declared=True, files_per_batch=1)
    for s in specs:
        assert os.path.isdir(f"{local(scratch)}/declared/{s.source_name}/offsets")
        assert any(n.startswith("_part_") for n in os.listdir(local(paths[s.table_name])))
        landed = read_bronze(spark, paths[s.table_name])
        assert landed.count() == landed.select(vocab.ROW_ID).distinct().count() > 0


def test_a_source_is_ingested_without_the_others(spark, tmp_path):
    from strata.plans.queries import REGISTRY
    from strata.sources.files import names
    from strata.sources.testdata import landing_root
    from tests.conftest import SF_SMALL

    for name in os.listdir(SF_SMALL):
        (tmp_path / name).symlink_to(f"{SF_SMALL}/{name}")
    sf = str(tmp_path)
    assert REGISTRY["ingest_json"](spark, sf).count() > 0
    assert names(spark, f"{landing_root(spark, sf)}/landing") == names(spark, f"{landing_root(spark, sf)}/bronze") == ["merchants"]
    assert REGISTRY["ingest_manifest"](spark, sf).count() == REGISTRY["ingest_manifest"](spark, SF_SMALL).count()
    landed = names(spark, f"{landing_root(spark, sf)}/landing/transactions")
    assert landed and all(n.endswith(".csv.gz") for n in landed)
