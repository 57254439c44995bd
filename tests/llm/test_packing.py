import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.packing import best_fit_decreasing, pack, piece_digests
from strata.llm.tokens import Encoder

VOCABULARIES = ("byte_bpe_50k.json", "word_bpe_49k.json")


def test_best_fit_decreasing_equals_a_plain_search():
    r = random.Random(1)
    for _ in range(150):
        width = r.choice([8, 13, 64])
        lengths = np.array([r.randint(0, 3 * width) for _ in range(r.randint(0, 50))], dtype=np.int64)
        pieces, windows = {}, {}
        for d, start, n, w, at in best_fit_decreasing(lengths, width):
            pieces.setdefault(d, []).append((start, n))
            windows.setdefault(w, []).append((at, n))
        for d, n in enumerate(lengths.tolist()):
            end = 0
            for start, m in sorted(pieces.get(d, [])):
                assert start == end
                end += m
            assert end == n
        for parts in windows.values():
            end = 0
            for at, n in sorted(parts):
                assert at == end
                end += n
            assert end <= width
        room = []
        for n in sorted((int(n) % width for n in lengths if n % width), reverse=True):
            fits = [c for c in room if c >= n]
            if fits:
                room.remove(min(fits))
            room.append((min(fits) if fits else width) - n)
        assert sorted(width - sum(n for _, n in p) for p in windows.values()) == sorted(room + [0] * sum(int(n) // width for n in lengths))


@pytest.mark.parametrize("name", VOCABULARIES)
def test_encoder_equals_the_library_on_odd_white_space(name):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    r = random.Random(2)
    signs = list("ab  \n\t'sé  Σσ́.,1\x1c\x85")
    texts = ["", None, "a  b", "a   b", " x", "x ", "x\n y", "x \ny", "a\n \nb", "it's  don't", "<|endoftext|> hi<|endoftext|>", "hi <|endoftext|> there", "<|EndOfText|>", "a <| b <|startoftext|>", "<|", "日本 語", "a b"]
    texts += ["".join(r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    for most, bits in ((64, 22), (1 << 20, 22), (512, 7)):  # the last keeps 64 words only
        ids, n = Encoder(path, bits).encode(texts, most)
        for t, got in zip(texts, np.split(ids, np.cumsum(n)[:-1]), strict=True):
            assert got.tolist() == plain.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_full_cache_keeps_its_words_and_results_stay():
    path = public_tokenizers.path(VOCABULARIES[0])
    texts = [f"w{i} x{i * 7} common" for i in range(300)]
    small, large = Encoder(path, bits=6), Encoder(path)
    for i in range(0, 300, 10):
        assert np.array_equal(small.encode(texts[i : i + 10])[0], large.encode(texts[i : i + 10])[0])
    assert small.table.size == 32 and large.table.size > 600


def test_pieces_hold_every_id_once(spark):
    docs = spark.createDataFrame([(1, "a b c " * 900, "x"), (2, None, "y"), (3, "", None), (None, "hello", "z"), (1, "hello", "z"), (1, "hello", "z")], "doc_id long, text string, length string")
    plain = Tokenizer.from_file(public_tokenizers.path(VOCABULARIES[0]))
    expected = sorted(((d, [*plain.encode(t or "", add_special_tokens=False).ids, 1]) for d, t, _ in docs.collect()), key=str)
    pieces = pack(docs.coalesce(1), public_tokenizers.path(VOCABULARIES[0]), width=256)
    rows = pieces.collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.start):
        got.setdefault((r.doc_id, r.doc_tokens, r.sequence_id if r.start == 0 and r.length == r.doc_tokens else -1, r.offset if r.length == r.doc_tokens else -1), []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert sorted(((k[0], v) for k, v in got.items()), key=str) == expected
    for r, c in zip(rows, piece_digests(pieces).collect(), strict=True):
        assert c.ids_crc32 == zlib.crc32(r.ids) and r.length * 4 == len(r.ids)
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert sum(x.length for x in rows if x.sequence_id == r.sequence_id) == r.sequence_tokens <= 256
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
    assert pack(docs.limit(0), public_tokenizers.path(VOCABULARIES[0])).count() == 0


def test_little_padding(spark):
    pieces = pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), public_tokenizers.path(VOCABULARIES[0]))
    total = pieces.agg(F.sum("length").alias("n"), F.countDistinct("sequence_id").alias("s")).first()
    assert total.n >= 0.97 * 2048 * total.s
