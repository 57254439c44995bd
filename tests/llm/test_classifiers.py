import re
import random

import numpy as np
import pytest

from strata.llm import queries
from strata.llm.langid import BUCKETS, fit_languages, grams, identify_language
from strata.llm.quality import STATS, Discriminant, document_stats, fit_quality, score_quality
from strata.llm.toxicity import FactorizationMachine, Trainer, bucket_of, fit_toxicity, score_toxicity, text_terms

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, column", [("op3_quality", "quality"), ("op9_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, column):
    out = queries.REGISTRY[name](spark, FOLDER)
    labels = queries.table(spark, FOLDER, "labels")
    held = out.join(labels, "doc_id").where("held_out").toPandas()
    assert (held.predicted == held[column]).mean() >= 0.9
    assert out.where("score < 0 or score > 1 or score is null").count() == 0 and out.count() == 1000


def test_language_of_held_out_documents(spark):
    out = queries.REGISTRY["op5_language"](spark, FOLDER).toPandas().set_index("doc_id")
    docs = queries.table(spark, FOLDER, "documents").toPandas().set_index("doc_id")
    held = out[out.held_out]
    assert (held.lang_pred == docs.lang[held.index]).mean() >= 0.98


def test_discriminant_equals_the_densities():
    rng = np.random.default_rng(1)
    x = [rng.normal(size=(300, 3)) @ rng.normal(size=(3, 3)) + k for k in range(2)]
    n = np.array([300.0, 300.0])
    model = Discriminant.fit(n, np.stack([z.sum(0) for z in x]), np.stack([z.T @ z for z in x]), 0.1, 1.0)
    points, logs = rng.normal(size=(20, 3)), []
    for k in range(2):
        cov = np.linalg.inv(model.roots[k]) @ np.linalg.inv(model.roots[k]).T
        gap = points - model.means[k]
        logs.append(np.log(0.5) - 0.5 * np.log(np.linalg.det(cov)) - 0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap))
    assert np.allclose(model.score(points), 1 / (1 + np.exp(logs[0] - logs[1])))


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "x", "!" * 50, "é" * 1000, "a b\n" * 30000])
def test_statistics_are_finite(text):
    assert len(document_stats(text)) == len(STATS) and np.isfinite(document_stats(text)).all()


def test_machine_equals_all_pairs():
    rng = np.random.default_rng(2)
    fm = FactorizationMachine(3, 0.3, rng.normal(size=8), rng.normal(size=(8, 3)))
    rows, at = np.array([0, 0, 0, 1]), np.array([0, 2, 4, 1])
    margin, _ = fm.margin(rows, at, 3)
    pairs = sum(fm.factors[a] @ fm.factors[b] for a, b in ((0, 2), (0, 4), (2, 4)))
    assert np.allclose(margin, [0.3 + fm.weights[[0, 2, 4]].sum() + pairs, 0.3 + fm.weights[1], 0.3])
    texts = ["one two two", None, "three one"]
    single = [1 / (1 + np.exp(-fm.margin(np.zeros(len(b), int), b, 1)[0][0])) for t in texts for b in [np.unique(bucket_of(text_terms([t])[1], 3)).astype(int)]]
    assert np.allclose(fm.score(texts), single)


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    rows, at, y = np.array([0, 0, 1, 1, 1]), np.array([1, 2, 0, 1, 3]), np.array([1.0, 0.0])

    def loss(fm):
        margin, _ = fm.margin(rows, at, 2)
        return (np.log1p(np.exp(margin)) - y * margin).sum()

    start = FactorizationMachine(2, 0.1, rng.normal(size=4), rng.normal(size=(4, 2)))
    moved = FactorizationMachine(2, 0.1, start.weights.copy(), start.factors.copy())
    Trainer(moved, np.full(4, 1e12), rate=1.0, calm=1e8, sparse=0, sparse_pairs=0).step(rows, at, y, np.ones(2))  # a step of 1e-4 slopes
    for name in ("weights", "factors"):
        slope, table = (getattr(start, name) - getattr(moved, name)) * 1e4, getattr(start, name)
        for i in np.ndindex(table.shape):
            bump = np.zeros(table.shape)
            bump[i] = 1e-5
            up, down = (loss(FactorizationMachine(**{**vars(start), name: table + h * bump})) for h in (1, -1))
            assert slope[i] == pytest.approx((up - down) / 2e-5, abs=1e-3)


def test_fit_learns_a_pair_of_words_that_are_neutral_by_themselves(spark):
    rng = np.random.default_rng(5)
    n = 8000
    a, b = rng.random(n) < 0.5, rng.random(n) < 0.5
    docs = [(i, " ".join([*["alpha"] * p, *["omega"] * q, *[f"w{z}" for z in rng.integers(0, 500, 20)]])) for i, (p, q) in enumerate(zip(a.tolist(), b.tolist(), strict=True))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(a[i] != b[i])) for i in range(6000)], "doc_id long, toxic int")
    out = score_toxicity(frame, fit_toxicity(frame, labels)).where("doc_id >= 6000").toPandas()
    assert ((out.score >= 0.5) == (a != b)[out.doc_id]).mean() >= 0.95


def test_grams_stay_inside_their_text():
    both = [np.concatenate([b[d == k] for d, b in grams(["Ab c1!", "", "xyz"])]) for k in range(3)]
    alone = [np.concatenate([b for _, b in grams([t])]) if t else [] for t in ("Ab c1!", "", "xyz")]
    assert sorted(both[0]) == sorted(alone[0]) and sorted(both[2]) == sorted(alone[2]) and max(both[0]) < BUCKETS


def test_odd_tables(spark):
    r = random.Random(1)
    docs = [(i, " ".join(r.choice(("the", "and", "of") if i % 2 else ("der", "und", "von")) for _ in range(20)), "en" if i % 2 else "de", "s") for i in range(40)]
    docs += [(None, None, "en", "t"), (100, "", None, "t"), (101, "12 34 !", "de", None), (3, "the " * 50000, "en", "u"), (3, "the the", None, "u")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, score string")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(40)] + [(None, 1, 1), (3, None, 0), (5, 7, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for model, score in ((fit_quality, score_quality), (fit_toxicity, score_toxicity)):
        for known in (labels, none):
            out = score(frame, model(frame, known))
            assert out.columns == [*frame.columns, "_score"] and out.where("_score between 0 and 1").count() == len(docs)
        assert score(frame.limit(0), model(frame, none)).count() == 0
    out = identify_language(frame, fit_languages(frame))
    got = {(r.doc_id, r.text): r.found for r in out.collect()}
    assert got[None, None].lang_pred == got[100, ""].lang_pred == got[101, "12 34 !"].lang_pred == "und"
    assert all(got[i, t].lang_pred == lang for i, t, lang, _ in docs[:40])
    assert identify_language(frame, fit_languages(frame.limit(0))).where("found.lang_pred <> 'und'").count() == 0


def test_class_sums_take_one_python_worker_a_task(spark):
    from strata.llm.quality import class_sums

    texts = [f"Text {k}: some words | here! " * (k % 5) for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 3) for k in range(40)], "doc_id long, quality int")
    sums = class_sums(docs, labels, "quality", "doc_id", "text")
    assert len(re.findall("ArrowEvalPython|BatchEvalPython|MapInArrow|InPandas", sums._jdf.queryExecution().optimizedPlan().toString())) == 1
    got = {r.y: r for r in sums.collect()}
    assert set(got) == {0, 1}
    for y, r in got.items():
        x = np.array([document_stats(t) for k, t in enumerate(texts) if k % 3 == y])
        assert r.n == len(x) and np.allclose(r.s, x.sum(0)) and np.allclose(r.o, (x.T @ x)[np.triu_indices(len(STATS))])
