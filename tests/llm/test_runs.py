import hashlib
import zlib

import numpy as np
import pytest

from strata.llm.runs import collapse_runs, periodic_runs, planted, split_words


def brute_runs(words):
    """All (start, length, period) by trying each period at each place."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            if length >= max(6, 4 * q) and not any(all(part[x] == part[x + r] for x in range(length - r)) for r in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(key, text):
    import re

    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(key).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (key, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def some_texts():
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(400):
        words = []
        while len(words) < rng.integers(1, 90):
            part = [f"w{x}" for x in rng.integers(0, rng.choice([1, 2, 3, 50]) + 1, rng.integers(1, 9))]
            words += part * int(rng.choice([1, 1, 2, 4, 5, 9])) + part[: int(rng.integers(0, len(part) + 1))]
        texts.append(" ".join(words))
    return texts


def test_equals_brute_force(spark):
    rows = list(enumerate(some_texts())) + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a\x0ba a  a\x1ca"), (7, "x " * 9), (1004, "ein " * 6), (1005, "ein " * 5)]
    df = spark.createDataFrame([(k, t, k) for k, t in rows], "doc_id long, text string, start long").repartition(5)
    out = collapse_runs(df, plant=True).drop("n_words", "collapsed")
    assert sorted(map(tuple, out.collect())) == sorted((brute(k, t) for k, t in rows))
    assert collapse_runs(df.limit(0)).count() == 0


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b " * 4), (None, "a b " * 4), (3, None), (4, "one two")], "doc_id long, text string")
    got = sorted(map(tuple, collapse_runs(df).select("doc_id", "n_runs", "start", "length", "period", "collapsed").collect()), key=str)
    assert got == sorted([(None, 1, 0, 8, 2, "a b"), (None, 1, 0, 8, 2, "a b"), (3, 0, None, None, None, ""), (4, 0, None, None, None, "one two")], key=str)


@pytest.mark.parametrize("text", [["a"] * 300_000, ["a", "b"] * 100_000 + ["c"] * 100_000, [f"w{i % 5000}" for i in range(250_000)]])
def test_long_texts_are_linear(text):
    codes = np.unique(np.array(text), return_inverse=True)[1]
    runs = periodic_runs(codes, np.array([0]))
    assert runs == {1: [(0, 300_000, 1)], 3: [(0, 200_000, 2), (200_000, 100_000, 1)], 5000: [(0, 250_000, 5000)]}[len(set(text))]


def test_runs_do_not_cross_texts():
    codes = np.array([0] * 5 + [1] * 6 + [2, 3] * 3)
    assert periodic_runs(codes, np.array([0, 5, 11])) == [(5, 6, 1)]
    assert split_words("a b c".encode()) == ["a b".encode(), b"c"] and planted(5, 3) is None


def test_single_texts_of_any_length():
    rng = np.random.default_rng(2)
    for _ in range(300):
        q = int(rng.integers(1, 12))
        n = int(rng.integers(1, 60))
        word = rng.integers(0, 3, q)
        codes = np.concatenate((rng.integers(0, 3, rng.integers(0, 5)), np.resize(word, n), rng.integers(0, 3, rng.integers(0, 5))))
        assert periodic_runs(codes, np.array([0])) == brute_runs(codes.tolist())
