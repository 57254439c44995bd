import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm.line_dedup import dedup_lines


def words(line):
    return len(re.findall(r"[^\W_]+", line))


def brute(rows, order, least):
    """Deletes every line of a run with enough words that began earlier, by trying all runs."""
    seen, gone = set(), {}
    for key in order:
        lines = [(i, s) for i, s in enumerate(key[1].split("\n")) if words(s)]
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += words(lines[b][1])
                run = tuple(s for _, s in lines[a : b + 1])
                if total >= least and run in seen:
                    gone.setdefault(key, set()).update(i for i, _ in lines[a : b + 1])
                elif total >= least:
                    seen.add(run)
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        lines, lost = t.split("\n"), gone.get((d, t), set())
        rest = [s for i, s in enumerate(lines) if i not in lost]
        out.append((d, t if not lost else "\n".join(rest) if any(map(words, rest)) else "", len(lines), len(lost)))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [1, 5, 12])
def test_equals_brute_force(spark, least):
    r = random.Random(least)
    lines = ["a", "b c", "d e f", "", "x y z w", "q  q", "!!", "c"]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 25)))) for i in range(120)]
    rows += [(None, rows[3][1]), (7, None), (5, rows[5][1]), (5, rows[5][1]), (None, ""), (200, rows[9][1] + "\n" + rows[11][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {x.text: x.h for x in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted({(d, t) for d, t in rows if t is not None}, key=lambda k: (k[0] is not None, k[0] or 0, hashes[k[1]]))
    assert sorted(map(tuple, dedup_lines(docs, least).collect()), key=str) == brute(rows, order, least)


def test_clashing_names_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "one two", "p", 9)], "doc_id long, text string, n_deleted string, _h long")
    out = dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "n_deleted", "_h", "n_lines", "_n_deleted"] and tuple(out.first()) == (1, "one two", "p", 9, 1, 0)
    assert dedup_lines(docs.limit(0)).count() == 0


def test_long_passages_go_and_short_lines_stay(spark):
    passage = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) for i in range(3))
    docs = spark.createDataFrame([(1, f"head\n{passage}\ntail"), (2, f"other\n{passage}\ntail"), (3, f"third\n{passage[:200]}\ntail")], "doc_id long, text string")
    out = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert out[1].text == f"head\n{passage}\ntail" and out[2].text == "other" and out[3].n_deleted == 0
