"""Line dedup: a suffix array over line-ID sequences, by distributed prefix doubling.

Only DataFrame operations. A document is the sequence of its lines that hold a word. Lines that
occur once cannot lie in a repeat, so only repeated lines get IDs. Prefix doubling sorts the
suffixes by their first 1, 2, 4, ... lines: the rank of a suffix at one level comes from its rank
and the rank of the suffix half a level later. Suffixes with equal rank form an interval of the
suffix array whose longest common prefix reaches that level; a prefix of any length in between
is named by two overlapping ranks. A repeated run with enough words is a union of shortest such
runs, read from its lines forwards or backwards, so the intervals of those reveal every maximal
run. The first occurrence in document order stays, later ones are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import free_name, stored

#: A run of fewer words than this may repeat: headings, licence lines and greetings stay.
MIN_WORDS = 50


def line_words(line: Column) -> Column:
    return F.regexp_count(line, F.lit(r"[\p{L}\p{N}]+"))


def _ranks(pairs: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """``pairs``, ``rows`` at most, with ``name``: numbers in the sorted order of the distinct keys, equal for equal keys.

    Sorted by ranges over all tasks; a row's number is its task and place there, so it ascends.
    """
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pairs.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return stored(ordered.withColumn("name", F.monotonically_increasing_id()), "ranks", rows)


def _occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, h, line, p, w, before, k1, k2): all lines with a word, each document once.

    ``p`` counts these lines from 0 and ``before`` the words in front. One document's lines are one
    text in one row of the input, so ordering them in one task asks for no more than that.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n", -1)).alias("line", "s"))
    rows = rows.select("d", "h", "line", line_words(F.col("s")).alias("w"), F.xxhash64("s").alias("k1"), F.hash("s").alias("k2")).where("w > 0").distinct()
    order = Window.partitionBy("d", "h").orderBy("line")
    return rows.withColumn("p", F.row_number().over(order) - 1).withColumn("before", F.sum("w").over(order).cast("int") - F.col("w"))


def _stretches(known: DataFrame, min_words: int) -> DataFrame:
    """``known`` with ``z``, the number of its stretch of consecutive lines, where that has enough words."""
    z = F.col("p") - F.row_number().over(Window.partitionBy("d", "h").orderBy("p"))
    stretch = Window.partitionBy("d", "h", "z")
    return known.withColumn("z", z).withColumn("in_z", F.sum("w").over(stretch)).where(F.col("in_z") >= min_words).drop("in_z")


def _shortest_runs(at: DataFrame, min_words: int) -> DataFrame:
    """(d, h, p, m): the shortest runs of repeated lines with enough words, from each line on and up to each line.

    Lines whose first word is among the ``min_words`` from a line's first make up its run, and
    likewise backwards; so a run has at most ``min_words`` lines.
    """
    after = F.col("before") + F.col("w")
    whole = Window.partitionBy("d", "h", "z")
    ahead = whole.orderBy("before").rangeBetween(0, min_words - 1)
    back = whole.orderBy("after").rangeBetween(1 - min_words, 0)
    at = at.withColumn("after", after)
    forwards = at.select("d", "h", "p", F.count("*").over(ahead).alias("m"), (F.max("after").over(ahead) - F.col("before")).alias("words"))
    backwards = at.select("d", "h", F.col("p").alias("e"), F.count("*").over(back).alias("m"), (F.col("after") - F.min("before").over(back)).alias("words"))
    backwards = backwards.select("d", "h", (F.col("e") - F.col("m") + 1).cast("int").alias("p"), "m", "words")
    return forwards.unionByName(backwards).where(F.col("words") >= min_words).select("d", "h", "p", F.col("m").cast("int").alias("m")).distinct()


def _on(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on document and place; documents without a key are joined too."""
    right = right.withColumnsRenamed({"d": "d2", "h": "h2", "p": "p2"})
    return left.join(right, F.expr("d <=> d2 and h = h2 and p = p2"), how).drop("d2", "h2", "p2")


def later_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, h, line) of all lines in later copies of repeated runs of ``min_words`` words or more.

    ``d`` is the key, ``h`` the hash of the text, ``line`` counts all lines from 0. Documents are
    ordered by (key, hash), NULL keys first.
    """
    held = stored(_occurrences(docs, id_col, text_col), "lines")
    n = held.count()
    again = held.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2")
    known = held.join(_ranks(again, ["k1", "k2"], n // 2), ["k1", "k2"]).select("d", "h", "p", "w", "before", "name")
    at = stored(_stretches(known, min_words), "sequences", n)
    n = at.count()
    runs = stored(_shortest_runs(at, min_words).withColumn("level", F.floor(F.log2("m") + 1e-9).cast("int")), "runs", 2 * n)
    names, level, found = at.select("d", "h", "p", "name"), 0, None
    while True:
        size = 1 << level
        here = _on(runs.where(F.col("level") == level), names.withColumnRenamed("name", "first"))
        ends = names.select("d", "h", (F.col("p") - size).alias("q"), F.col("name").alias("last"))
        here = here.withColumn("q", F.col("p") + F.col("m") - 2 * size)
        here = here.join(ends.withColumnsRenamed({"d": "d2", "h": "h2", "q": "q2"}), F.expr("d <=> d2 and h = h2 and q = q2")).select("d", "h", "p", "m", "first", "last")
        found = here if found is None else found.unionByName(here)
        if 2 * size > min_words:
            break
        ahead = names.select("d", "h", (F.col("p") - size).alias("p"), F.col("name").alias("last"))
        pairs = _on(names.withColumnRenamed("name", "first"), ahead)
        twice = pairs.groupBy("first", "last").agg(F.count("*").alias("n")).where("n > 1").select("first", "last")
        names = stored(pairs.join(_ranks(twice, ["first", "last"], n // 2), ["first", "last"]).select("d", "h", "p", "name"), "suffixes", n)
        level += 1
    found = stored(found, "found", 2 * n)
    first = found.groupBy("m", "first", "last").agg(F.min(F.struct("d", "h", "p")).alias("origin"), F.count("*").alias("n")).where("n > 1")
    later = found.join(first, ["m", "first", "last"]).where(~F.struct("d", "h", "p").eqNullSafe(F.col("origin")))
    gone = later.select("d", "h", F.explode(F.sequence("p", F.col("p") + F.col("m") - 1)).alias("p")).distinct()
    return _on(held.select("d", "h", "line", "p"), gone).select("d", "h", "line")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the later copies of line runs that repeat, in one text or across texts.

    A run is of consecutive lines (lines without a word are passed over and stay) and has
    ``min_words`` words or more in all; its first occurrence by (key, hash of the text, place)
    stays whole. Columns added: n_lines and n_deleted (longs; underscores go in front where a name
    is taken). A text of which no line with a word is left becomes empty. NULL texts stay NULL with
    0 lines. Rows with equal key and text are one document and are all changed alike; NULL keys
    come first. An empty table stays empty.
    """
    gone = later_lines(docs, min_words, id_col, text_col).groupBy("d", "h").agg(F.collect_list("line").alias("gone"))
    total, deleted, key, hashed, lost, lines = (free_name(docs, x) for x in ("n_lines", "n_deleted", "_d", "_h", "_gone", "_lines"))
    gone = gone.withColumnsRenamed({"d": key, "h": hashed, "gone": lost})
    text = docs[text_col].cast("string")
    out = docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone[key]) & (F.xxhash64(text) == gone[hashed]), "left")
    out = out.withColumn(lines, F.when(F.col(lost).isNotNull(), F.split(text, "\n", -1)))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost), lambda i: F.col(lines)[i])
    rest = F.when(F.exists(kept, lambda s: line_words(s) > 0), F.array_join(kept, "\n")).otherwise("")
    n_lines = F.when(text.isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    out = out.withColumn(total, F.coalesce(n_lines, F.lit(0)).cast("long")).withColumn(deleted, F.coalesce(F.size(lost), F.lit(0)).cast("long"))
    out = out.withColumn(text_col, F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(rest))
    return out.select(*docs.columns, total, deleted)
