import zlib

import numpy as np
import public_tokenizers
import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.token_file import ShardReader, ShardWriter, read_token_files, token_digests, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_round_trip_in_ascending_order(spark, scratch):
    rows = [(5, "five Five"), (1, None), (None, "no key"), (3, ""), (2, "x " * 700), (5, "five Five"), (5, "other"), (-4, "minus")]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, start string")
    manifest = write_token_files(docs, scratch, PATH, frame_ids=64, shards=3)
    out = read_token_files(spark, scratch, manifest).orderBy("start").collect()
    plain = Tokenizer.from_file(PATH)
    assert [r.doc_id for r in out] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in out if r.doc_id is not None) == sorted((d, [*plain.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows if d is not None)
    assert [r.start for r in out] == [sum(x.n_tokens for x in out[:k]) for k in range(len(out))]
    for r, c in zip(out, token_digests(read_token_files(spark, scratch, manifest)).orderBy("start").collect(), strict=True):
        assert (c.doc_id, c.n_tokens, c.ids_crc32) == (r.doc_id, r.n_tokens, zlib.crc32(r.ids))
    some = read_token_files(spark, scratch, manifest, wanted=[2, 3]).collect()
    assert {(r.doc_id, r.start) for r in some} == {(r.doc_id, r.start) for r in out if r.doc_id in (2, 3)}


def test_empty_table(spark, scratch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert read_token_files(spark, scratch, write_token_files(docs, scratch, PATH)).count() == 0


def test_reads_only_wanted_frames_and_finds_damage(tmp_path):
    store, path = fs.LocalFileSystem(), str(tmp_path / "a.tokz")
    writer = ShardWriter(store, path, "0", frame_ids=10)
    for k in range(40):
        writer.add(k, np.arange(k, k + 4, dtype=np.uint32))
    assert not (tmp_path / "a.tokz").exists()
    writer.close()
    reader = ShardReader(store, path)
    seen, plain = [], reader.frame
    reader.frame = lambda k: seen.append(k) or plain(k)
    assert [(k, ids.tolist()) for k, _, ids in reader.read({3, 30})] == [(3, [3, 4, 5, 6]), (30, [30, 31, 32, 33])]
    assert len(seen) == 2 < len(reader.frames)
    raw = bytearray((tmp_path / "a.tokz").read_bytes())
    raw[int(reader.frames[1]["offset"]) + 3] ^= 255
    (tmp_path / "a.tokz").write_bytes(raw)
    with pytest.raises(ValueError, match="frame 1"):
        list(ShardReader(store, path).read())
    assert next(ShardReader(store, path).read({0}))[0] == 0
    raw[-30] ^= 255
    (tmp_path / "a.tokz").write_bytes(raw)
    with pytest.raises(ValueError):
        ShardReader(store, path)


def test_each_shard_is_read_by_a_task_of_its_own(spark, scratch):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('text ', id) as text")
    manifest = write_token_files(docs, scratch, PATH, shards=9)
    rows = read_token_files(spark, scratch, manifest)
    tasks = [r[0] for r in rows.select(F.spark_partition_id().alias("p")).distinct().collect()]
    assert len(tasks) == manifest.count() == 9
    assert rows.count() == 400 and manifest.agg(F.sum("tokens")).first()[0] == rows.agg(F.sum("n_tokens")).first()[0]
