import math
import re
from collections import Counter

import numpy as np

from strata.llm.lexical import lexical_search, search_block

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    tf = [(d, Counter(words(t))) for d, t in docs]
    tf = [(d, c) for d, c in tf if c]
    n_docs, total = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(words(t))
    out = []
    for i, ts in queries.items():
        scored = []
        for d, c in tf:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_brute_force_in_one_pass_and_in_many(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(200)] + ["Ñandú", "ab9", "THE"]
    draw = lambda n: " ".join(vocabulary[min(int(x), 202)] for x in rng.zipf(1.4, n) - 1)
    docs = [(i, draw(rng.integers(1, 60))) for i in range(400)]
    docs += [(1000 + i, docs[5][1]) for i in range(50)]  # ties by key
    docs += [(900, None), (901, ""), (902, " -- _ "), (None, draw(20)), (7, docs[7][1]), (903, "w1 \x00w2\x7fw3 " * 20_000)]
    items = [(i, draw(15)) for i in range(12)] + [(50, docs[5][1]), (51, None), (52, ""), (53, "unseen"), (3, "w150 w151"), (None, "ñandú ÑANDÚ")]
    left = spark.createDataFrame([(d, t, d) for d, t in docs], "doc_id long, text string, score long").repartition(7)
    right = spark.createDataFrame([(d, t, 1) for d, t in items], "item_id long, text string, rank int")
    want = brute(docs, items)
    assert found(lexical_search(left, right)) == want
    assert found(lexical_search(left, right, pass_terms=40)) == want
    assert found(lexical_search(left, right, k=3)) == [r for r in want if r[1] <= 3]


def test_empty_tables_and_single_documents(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    assert found(lexical_search(docs, items)) == brute([(1, "one two")], [(1, "two three")])
    assert lexical_search(docs.limit(0), items).count() == 0
    assert lexical_search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    nothing = spark.createDataFrame([(1, None), (2, "...")], "doc_id long, text string")
    assert lexical_search(nothing, items).count() == 0


def test_limited_accumulators_lose_no_result():
    rng = np.random.default_rng(9)
    for _ in range(200):
        size, k = int(rng.integers(1, 300)), int(rng.integers(1, 6))
        lists = []
        for share in sorted(rng.random(int(rng.integers(1, 8)))):
            docs = np.flatnonzero(rng.random(size) < share)
            if len(docs):
                lists.append((docs, rng.integers(1, int(40 / (share + 0.1)), len(docs))))
        if not lists:
            continue
        full = np.zeros(size, np.int64)
        for docs, add in lists:
            full[docs] += add
        floor = int(rng.choice([0, full.max() // 2]))
        live, scores = search_block(lists, size, k, floor)
        assert (full[live] == scores).all()
        wanted = {d for d in range(size) if full[d] > 0 and full[d] >= max(floor, np.sort(full)[-min(k, size)])}
        assert wanted <= set(live.tolist())
