import re
from pathlib import Path

import corpus_pipeline
from strata.llm import queries
from strata.llm.common import scratch, stored
from strata.llm.components import components

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_their_own_input(spark):
    docs = queries.table(spark, FOLDER, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "s", 0), (9002, "a", "en", None, 1)], docs.schema)
    docs = stored(docs.unionByName(odd), "docs")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, FOLDER), name)
        assert out.columns == COLUMNS
        before, after = ({r.doc_id: r for r in x.collect()} for x in (docs, out))
        assert set(after) <= set(before) and len(after) >= 0.8 * len(before)
        if name != "line_dedup":
            assert all(after[k] == before[k] for k in after)
        else:
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text is not None and r.text != before[r.doc_id].text)
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}


def test_empty_tables(spark):
    docs = queries.table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).count() == 0


def test_registered_names():
    assert sorted({int(re.match(r"op(\d+)_", q)[1]) for q in queries.REGISTRY}) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_components_of_paths_rings_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(500, 200 + i) for i in range(30)] + [(3, 3), (None, 5), (1, 0), (700, 701)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(7)}, **{200 + i: 200 for i in range(30)}, 500: 200, 700: 700, 701: 700}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_queries_match_their_sql(spark):
    from tests.helpers import duck, same_as_oracle

    con = duck("/root/testdata/sf0.01")
    for name, sql in queries.ORACLE.items():
        same_as_oracle(queries.REGISTRY[name](spark, "/root/testdata/sf0.01"), con, sql)


def test_scratch_files_follow_the_rows(spark):
    from strata.llm.line_dedup import later_lines
    from strata.llm.minhash import near_duplicates

    docs = queries.table(spark, FOLDER, "documents").limit(200)
    docs = stored(docs.unionByName(docs.withColumn("doc_id", docs.doc_id + 100_000)), "docs")
    root = Path(scratch(spark, "x").removeprefix("file:").rpartition("/")[0].replace("//", "/"))
    before, own = set(root.iterdir()), {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        assert later_lines(docs).count() and near_duplicates(docs).where("d >= 100000 and origin.d < 100000").count()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    files = {}
    for folder in set(root.iterdir()) - before:
        files.setdefault(folder.name.rpartition("-")[0], []).append(len(list(folder.glob("part-*.parquet"))))
    assert len(files["ranks"]) > 2 and len(files["suffixes"]) > 1 and min(files["components"]) <= 1
    for name in ("ranks", "suffixes", "sequences", "runs", "found", "texts", "buckets", "stars", "classes"):
        assert max(files[name]) <= 1, (name, files[name])
