import random
import re
from collections import Counter, defaultdict

import numpy as np

from strata.llm.common import mix64
from strata.llm.minhash import drop_near_duplicates, duplicate_classes, prob_minhash, probability_jaccard


def similarity(a, b):
    """The definition: each common element's share, over all elements."""
    every = set(a) | set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in every) for d in set(a) & set(b))


def weighted(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def test_signature_estimates_the_exact_similarity():
    r = random.Random(1)
    a = {i: r.randint(1, 5) for i in range(200)}
    b = {**{i: a[i] for i in range(30, 200)}, **{i: 2 for i in range(200, 230)}}
    assert abs(similarity(a, a) - 1) < 1e-12
    found = []
    for salt in range(60):
        sides = []
        for s in (a, b):
            h = mix64(np.array([k * 1000 + salt for k in s], np.uint64))
            order = np.argsort(h)
            sides.append((h[order], np.array(list(s.values()), float)[order]))
        assert abs(probability_jaccard(*sides) - similarity(a, b)) < 1e-9
        doc = np.repeat([0, 1], [len(sides[0][0]), len(sides[1][0])])
        sig = prob_minhash(doc, *(np.concatenate(x) for x in zip(*sides, strict=True)), 2)
        found.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(found) - similarity(a, b)) < 0.02


def test_classes_equal_brute_force(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    base = [" ".join(word() for _ in range(r.choice([3, 12, 60, 120]))) for _ in range(25)]
    rows = list(enumerate(base))
    for k in range(160):
        words = r.choice(base).split(" ")
        for _ in range(int(len(words) * r.choice([0, 0.005, 0.02, 0.04, 0.08]) + 0.5)):
            words[r.randrange(len(words))] = word()
        rows.append((1000 + k, (r.choice([" ", ", "])).join(words).title()))
    rows += [(None, base[0]), (5, base[5]), (5, base[5]), (2000, None), (2001, ""), (2002, "?!"), (2003, "A b!"), (2004, "a, B")]
    sets = [weighted(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a.keys() & b.keys() and similarity(a, b) >= 0.8:
                group[max(top(i), top(j))] = min(top(i), top(j))
    expected = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        expected[top(i)].append(d)
    docs = spark.createDataFrame([(*x, "e") for x in rows], "doc_id long, text string, class_id string")
    got = defaultdict(list)
    out = duplicate_classes(docs).collect()
    for x in out:
        got[x.class_id].append(x.doc_id)
    key = lambda g: sorted(sorted(v, key=str) for v in g.values())
    assert sorted(map(str, key(got))) == sorted(map(str, key(expected)))
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(expected)
    assert duplicate_classes(docs.limit(0)).count() == drop_near_duplicates(docs.limit(0)).count() == 0


def test_chain_of_near_copies_is_one_class(spark):
    words = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(12):
        rows.append((k, " ".join(words)))
        words = words[3:] + [f"n{k}x{i}" for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in duplicate_classes(docs).collect()} == {0}
