import re
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from strata.llm.decontaminate import mark_contaminated

ITEMS = [
    (1, "Yesterday Tom bought 12 apples for 5 dollars and gave Anna 3 of them before Tom went home"),
    (2, "short item here"),
    (3, None),
    (4, ""),
    (5, "the train travels 120 km in 2 hours how fast does the train go if Bob drives 120 km"),
]
DOCS = [
    (1, "Well. yesterday Jim bought 40 apples for 9 dollars and gave Sue 7 of them before Jim went home, ok", [1]),
    (2, "Well. yesterday Jim bought 40 apples for 9 dollars and gave Sue 7 of them before Max went home, ok", []),
    (3, "a short item here.", [2]),
    (4, None, []),
    (5, "", []),
    (6, "the train travels 80 km in 3 hours how fast does the train go if Eve drives 80 km", [5]),
    (7, "the train travels 80 km in 3 hours how fast does the train go if Eve drives 90 km", []),
    (None, "text that has nothing to do with anything at all, really nothing whatsoever", []),
    (8, "it said: the train travels 120 km in 2 hours how fast does the train go if Bob drives 120 km! yesterday Tom bought 12 apples for 5 dollars and gave Anna", [1, 5]),
    (8, "the train travels slowly", []),
]


def test_slots_must_be_consistent(spark):
    docs = spark.createDataFrame([(d, t, i) for d, t, i in DOCS], "doc_id long, text string, items array<long>")
    bench = spark.createDataFrame([(*x, "z") for x in ITEMS], "item_id long, text string, d string")
    out = mark_contaminated(docs, bench)
    assert out.columns == ["doc_id", "text", "items", "contaminated", "_items"]
    for r in out.collect():
        assert r["_items"] == r["items"] and r.contaminated == bool(r["items"]), r
    assert mark_contaminated(docs.limit(0), bench).count() == 0
    assert not mark_contaminated(docs, bench.limit(0)).where("contaminated").count()


def test_literal_passages_equal_a_search_by_words(spark):
    folder = "/root/testdata/sf0.01"
    read = lambda t: duckdb.sql(f"select * from '{folder}/{t}.parquet'").fetchall()
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    places = defaultdict(set)
    bench = {i: words(t) for i, t in read("benchmark")}
    for i, w in bench.items():
        for k in range(len(w) - 7):
            places[tuple(w[k : k + 8])].add((i, k))
    expected = {}
    for d, t, *_ in read("documents"):
        w, hits = words(t), defaultdict(set)
        for k in range(len(w) - 7):
            for i, j in places.get(tuple(w[k : k + 8]), ()):
                hits[i, k - j].update(range(j, j + 8))
        if found := {i for (i, _), v in hits.items() if len(v) >= 0.5 * len(bench[i])}:
            expected[d] = sorted(found)
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {r.doc_id: r["items"] for r in mark_contaminated(docs, items).where("contaminated").collect()}
    assert got == expected and expected


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j")], "doc_id long, text string")
    plan = mark_contaminated(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


NAMES = "gave them to Anna and then Bob and later Carl before they met Dave in Rome on Monday"


def flagged(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["items"] for r in mark_contaminated(docs, bench).orderBy("doc_id").collect()]


def test_names_do_not_depend_on_case_breaks_or_sentences(spark):
    start = "Anna sold 12 pears. Bob paid for them (Carl did not) and \"Dave\" went away."
    texts = [NAMES.lower(), NAMES.upper(), NAMES.replace(" and ", "\n and  "), start.lower(), start.replace("Anna", "Sue").replace("Bob", "Jim").replace("Carl", "Max").replace("Dave", "Ian"),
             "gave them to one man but never told others before they left on a Monday in Rome"]
    assert flagged(spark, [NAMES, start], texts) == [[0], [0], [0], [1], [1], []]


def test_alignments_count_together_and_long_runs_alone(spark):
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(59)]
    item, short = " ".join(words), " ".join(words[:42])
    edited = " ".join([*words[:14], "extra", *words[14:28], "more", *words[28:42]])
    city = "they walked slowly from the old bridge to Paris where nobody had seen any snow since the winter of that very long war"
    texts = [" ".join(words[20:45]), edited, " ".join(words[20:32]), city.replace("Paris", "New York")]
    assert flagged(spark, [item], texts[:1] + texts[2:3]) == [[0], []]
    assert flagged(spark, [short, city], [edited, texts[3]]) == [[0], [1]]


def test_one_conflict_leaves_literal_windows_and_other_quantities(spark):
    apples = "every market stall sold 2 apples to each visitor while the fair went on for 2 days in the small town"
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(53)]
    equal = " ".join([*words[:12], "31", words[12], *words[13:40], "31", words[12], *words[40:]])
    texts = [apples.replace("2 apples", "3 apples").replace("2 days", "5 days"), equal.replace("31", "44", 1), equal.replace("31", "44")]
    assert flagged(spark, [apples, equal], texts) == [[0], [1], [1]]
    conflict = "the train travels 120 km in 2 hours how fast is it if Bob drives 120 km to Anna and Bob sees her"
    assert flagged(spark, [conflict], [conflict.replace("120", "80", 1).replace("120", "90").replace("Bob", "Max", 1)]) == [[]]


def test_lists_of_numbers_or_names_match_only_as_they_stand(spark):
    series = "Continue the series 1 2 3 4 5 6 7 8 9 10 11 12"
    names = "Sort these names: Anna, Bob, Carl, Dave, Eve, Fred, Gina, Hugo, Ida, Jane"
    table = "Table of rainfall by station 412 87 93 21 65 74 38 99 150 233 47 61 was printed"
    guests = "On the list: Karl, Lena, Max, Nora, Otto, Paul, Rita, Sam, Tina, Ute"
    many = " ".join(str(k * 7919 % 1000) for k in range(3000))
    texts = [table, guests, many, "look: continue the series 1 2 3 4 5 6 7 8 9 10 11 12 please", names.lower(), "12km 5 kg " * 40, many + " " + series]
    assert flagged(spark, [series, names], texts) == [[], [], [], [0], [1], [], [0]]


def test_parts_lose_no_match(spark):
    import strata.llm.decontaminate as module

    folder = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    odd = spark.createDataFrame([(-1, "before x9ab12 " + NAMES), (-2, "Xyz. " + NAMES.title()), (-3, "5km " + NAMES), (-4, NAMES + " " + NAMES.replace("Anna", "Zoe"))], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(odd)
    items = items.select("item_id", "text").unionByName(spark.createDataFrame([(-1, NAMES)], "item_id long, text string"))
    cut = {(r.doc_id, tuple(r["items"])) for r in mark_contaminated(docs, items).where("contaminated").collect()}
    before, module.VOCABULARY = module.VOCABULARY, 0
    try:
        whole = {(r.doc_id, tuple(r["items"])) for r in mark_contaminated(docs, items).where("contaminated").collect()}
    finally:
        module.VOCABULARY = before
    assert cut == whole and {-1, -3, -4} <= {d for d, _ in cut}


def test_equal_rows_are_judged_alike(spark):
    docs = spark.createDataFrame([(1, NAMES), (1, NAMES), (None, NAMES), (2, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(3, NAMES)], "item_id long, text string")
    out = mark_contaminated(docs, bench)
    assert out.count() == 4 and out.where("contaminated").count() == 3


def test_words_are_taken_from_a_text_once(spark):
    import strata.llm.decontaminate as module

    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", module.cleaned(F.col("text")).alias("x"))
    parts = module.matchable(texts, ["the", "of", "and"], 3).select("doc_id", "part", module.slots(F.col("x")).alias("s"))
    windows = module._windows(module._with_templates(parts).drop("s"), 3, "i")
    plan = windows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 2  # of the whole text and of its parts
    assert not re.search(r"Filter [^\n]*regexp", plan)
