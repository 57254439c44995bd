"""Benchmark decontamination by template canonicalisation, with DataFrame operations only.

Numbers, names and units become typed placeholders; windows of the resulting templates are joined
by hash with those of the benchmark, with names as words too, so that the case of a copy does not
matter. Where a window of an item lies in a document, all words of the item are compared with those
beside them (a name on either side is one), and the values in the slots: a question that was
re-parameterised replaces each value consistently, so one benchmark value must stand for one value
of the document, wherever the matched text holds it. Where values conflict, literal windows count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name, stored

#: Words of a template window.
WINDOW = 8
#: Share of an item's words that matched windows must cover, over all alignments.
COVERAGE = 0.5
#: So many equal words in a row are contaminated whatever share of the item they are.
RUN = 13
#: A benchmark of more windows than this is not broadcast but joined by shuffled hashes.
BROADCAST_WINDOWS = 1_000_000
#: Units of measure after a number: fixed values.
UNITS = ("km", "m", "cm", "mm", "mi", "ft", "in", "kg", "g", "mg", "lb", "oz", "l", "ml", "s", "ms", "min", "h", "hours", "minutes",
         "seconds", "days", "weeks", "months", "years", "miles", "meters", "metres", "feet", "inches", "dollars", "euros", "cents",
         "percent", "degrees", "usd", "eur", "hz", "khz", "mhz", "ghz", "kb", "mb", "gb", "tb", "w", "kw", "v", "mph", "kmh")
#: Marks in front of slot values: private-use characters, which no word holds after cleaning. START
#: marks a capitalised word where a sentence, line, quote or bracket may begin: a name or not.
NUMBER, NAME, UNIT, START, END = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004"
#: Stands where words were left out that no item can match.
BREAK = "\ue005"
#: A benchmark of more distinct words than this is compared with whole texts: the words become part of the plan.
VOCABULARY = 20_000
WORD = r"[\p{L}\p{N}]+"


def cleaned(text: Column) -> Column:
    """Single spaces, no marks, and a space between a digit and the letter behind it."""
    odd = rf"[\s\p{{Z}}{NUMBER}-{BREAK}]"
    single = F.regexp_replace(text, rf"{odd}{{2,}}|[{odd}&&[^ ]]", " ")  # plain single spaces, which are most, stay
    return F.when(single.rlike(r"\p{N}\p{L}"), F.regexp_replace(single, r"(?<=\p{N})(?=\p{L})", " ")).otherwise(single)


def slots(clean: Column) -> Column:
    """Words of a cleaned text in order, lower case, with a mark in front of numbers, units and capitalised words.

    A capitalised word that follows another word or a comma is a name, elsewhere it has the mark START.
    """
    counted = F.regexp_replace(clean, r"(?<![\p{L}\p{N}.,])(\p{N}+(?:[.,]\p{N}+)*)", NUMBER + "$1")
    measured = F.regexp_replace(counted, rf"(?<=\p{{N}} ?)((?i:{'|'.join(sorted(UNITS, key=len, reverse=True))}))(?![\p{{L}}\p{{N}}])", " " + UNIT + "$1")
    named = F.regexp_replace(measured, r"(?<=[\p{L}\p{N},;:] )(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])", NAME + "$1")
    named = F.regexp_replace(named, rf"(?<![\p{{L}}\p{{N}}{NAME}{UNIT}])(\p{{Lu}}\p{{Ll}}+)(?![\p{{L}}\p{{N}}])", START + "$1")
    return F.regexp_extract_all(F.lower(named), F.lit(rf"{NUMBER}[\p{{N}}.,]*\p{{N}}|[{NAME}-{START}]?[\p{{L}}\p{{N}}]+"), F.lit(0))


def _marked(w: Column) -> Column:
    return (w >= NUMBER) & (w < END)


def _plain(w: Column) -> Column:
    return F.when(_marked(w), F.substring(w, 2, 1 << 30)).otherwise(w)


FORMS = ("t0", "t1", "t2", "t3")


def _with_templates(frame: DataFrame) -> DataFrame:
    """``frame`` with word hashes of the words ``s`` in four forms; of a slot not the value counts but its type.

    Numbers and units are slots in the first three, names in ``t1``, and all capitalised words in
    ``t2``: ``t0`` matches copies whatever their case, ``t2`` names at the beginning of a sentence.
    ``t3`` has the words and values themselves.
    """
    name, mark = F.xxhash64(F.lit(NAME)), lambda w: F.substring(w, 1, 1)
    out = frame.withColumn("t0", F.transform("s", lambda w: F.xxhash64(F.when(w < NUMBER, w).when(mark(w).isin(NUMBER, UNIT), mark(w)).otherwise(_plain(w)))))
    out = out.withColumn("t1", F.zip_with("s", "t0", lambda w, x: F.when((w < NAME) | (w >= UNIT), x).otherwise(name)))
    out = out.withColumn("t2", F.zip_with("s", "t0", lambda w, x: F.when((w < NAME) | (w >= END) | (mark(w) == UNIT), x).otherwise(name)))
    return out.withColumn("t3", F.transform("s", lambda w: F.xxhash64(_plain(w))))


def _windows(frame: DataFrame, width: int, place: str, item: bool = False) -> DataFrame:
    """The hashes ``window`` of each window in all forms, which may be equal, with its ``place``.

    A text shorter than ``width`` words has no window. Of an ``item``, windows with slots count in the
    first three forms only if half of their words or more are no slots; those with more slots count as they stand (``t3``).
    """
    rest, every = [c for c in frame.columns if c not in ("s", *FORMS)], F.lit(1 << 30)
    out = frame.withColumn("n", F.size("t0") - width + 1)
    if item:
        types = [F.xxhash64(F.lit(x)) for x in (NAME, NUMBER, UNIT)]
        many = lambda t: lambda i: 2 * F.size(F.filter(F.slice(t, i, width), lambda x: x.isin(*types))) > width
        for t in FORMS[:3]:
            out = out.withColumn(f"many_{t}", F.transform(F.sequence(F.lit(1), "n"), many(t)))
    size = 1
    while size < width:  # a window's hash is that of two shorter ones, which overlap in the last step
        step = min(size, width - size)
        for t in FORMS:
            out = out.withColumn(t, F.zip_with(t, F.slice(t, F.lit(step + 1), every), lambda a, b: F.xxhash64(a, b)))
        size += step
    parts = [F.slice(t, F.lit(1), F.col("n")) for t in FORMS]
    if item:
        parts[:3] = [F.zip_with(x, f"many_{t}", lambda h, many: F.when(~many, h)) for x, t in zip(parts[:3], FORMS, strict=False)]
        parts[3] = F.zip_with(parts[3], "many_t0", lambda h, many: F.when(many, h))
    # decided in the generator: a filter would be moved below the projections and compute the words and hashes once more
    out = out.select(*rest, "n", F.posexplode(F.when(F.col("n") > 0, F.concat(*parts))).alias("at", "window"))
    return out.select(*rest, (F.col("at") % F.col("n")).alias(place), "window").where("window is not null")


def matchable(texts: DataFrame, vocabulary: list[str], least: int) -> DataFrame:
    """Rows of the parts ``x`` of the cleaned texts ``x`` in which an item can match, numbered by ``part``.

    Each word of a match is a word of the benchmark, a unit, a number or capitalised, so stretches
    of fewer than ``least`` such words match nothing. One word in front of a stretch is kept, since it
    tells names from beginnings.
    """
    # numbers and capitalised words: signs before "a" in ASCII, beyond it by a pattern
    known = lambda w: (w < "a") | F.lower(w).isin(*vocabulary) | ((w > "~") & w.rlike(r"^[\p{N}\p{Lu}\p{Lt}]"))
    out = texts.withColumn("w", F.regexp_extract_all("x", F.lit(WORD), F.lit(0)))
    out = out.withColumn("f", F.array_join(F.transform("w", lambda w: F.when(known(w), "1").otherwise("0")), ""))
    flags = F.col("f")
    for k in range(1, least):
        flags = F.regexp_replace(flags, f"(?<!1){'1' * k}(?!1)", "0" * k)
    flags = F.regexp_replace(flags, "01", "11")
    pieces = F.zip_with(F.split("x", WORD), "w", lambda gap, w: F.concat(gap, w))  # the gap behind the last word pairs with none
    held = F.zip_with(pieces, F.split(flags, ""), lambda p, f: F.when(f == "1", p).otherwise(BREAK))
    rest = [c for c in texts.columns if c != "x"]
    # texts without a stretch are passed over in the generator: a filter would be moved below the projections and compute them once more
    parts = F.when(F.contains("f", F.lit("1" * least)), F.split(F.array_join(held, ""), f"{BREAK}+"))
    return out.select(*rest, F.posexplode(parts).alias("part", "x")).where("x <> ''")


#: How the words of an item and a document at one place compare: by a name on one side only or one that
#: may begin a sentence, by slots of one type, as equal numbers or units, or as equal words.
LOOSE, TYPED, EQUAL, LITERAL = 1, 2, 3, 4


def _compared(a: Column, b: Column) -> Column:
    mark = lambda w: F.substring(w, 1, 1)
    name, fixed = (lambda w: mark(w).isin(NAME, START)), (lambda w: mark(w).isin(NUMBER, UNIT))
    typed = F.when(mark(a).isin(NUMBER, NAME, UNIT) & (mark(a) == mark(b)), TYPED).when((name(a) | name(b)) & ~fixed(a) & ~fixed(b), LOOSE)
    equal = F.when(mark(a).isin(NUMBER, UNIT), EQUAL).otherwise(LITERAL)
    return F.when(b.isNull(), 0).when(_plain(a) == _plain(b), equal).otherwise(F.coalesce(typed, F.lit(0)))


def _matched(least: int) -> Column:
    """Places of the item in windows of which each word compares ``least`` at least, and half of them as equal words or all as equal."""
    part = lambda i: F.slice("c", i, F.col("width"))
    sure = lambda i: (F.array_min(part(i)) >= EQUAL) | (2 * F.size(F.filter(part(i), lambda x: x == LITERAL)) >= F.col("width"))
    good = lambda i: (F.array_min(part(i)) >= least) & sure(i)
    starts = F.filter(F.sequence(F.lit(1), F.col("size") - F.col("width") + 1), good)
    return F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i - 1, i + F.col("width") - 2))))


def _literal_run() -> Column:
    """Words of the longest run of equal words."""
    def step(s: Column, x: Column) -> Column:
        now = F.when(x >= EQUAL, s.now + 1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(s.most, now).alias("most"))

    return F.aggregate("c", F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda s: s.most)


def _consistent(places: Column) -> Column:
    """Whether one slot value of the item stands for one value of the document at the ``places``.

    Equal numbers before different words or units are different quantities: 2 apples, 2 days.
    """
    pairs = F.transform(places, lambda k: F.struct(F.get("theirs", k).alias("a"), F.get("b", k).alias("b"), F.get("theirs", k + 1).alias("next")))
    pairs = F.filter(pairs, lambda p: _marked(p.a) | _marked(p.b))
    of = lambda p: F.when(F.substring(p.a, 1, 1) == NUMBER, _plain(F.coalesce(p.next, F.lit(""))))
    pairs = F.array_distinct(F.transform(pairs, lambda p: F.struct(_plain(p.a).alias("a"), of(p).alias("of"), _plain(p.b).alias("b"))))
    return F.size(pairs) == F.size(F.array_distinct(F.transform(pairs, lambda p: F.struct(p.a, p.of))))


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", run: int = RUN) -> DataFrame:
    """(d, h, item, words, covered): documents that hold an item, with the item's size and matched words.

    ``d`` is the key and ``h`` the hash of the text. Items of fewer than ``width`` words are matched
    as a whole, as one window of their own size.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), cleaned(F.col(item_text).cast("string")).alias("x"))
    items = items.withColumn("s", slots(F.col("x"))).where(F.size("s") > 0).withColumn("size", F.size("s"))
    vocabulary = items.select(F.explode(F.regexp_extract_all(F.lower("x"), F.lit(WORD), F.lit(0))).alias("w")).distinct().limit(VOCABULARY + 1).collect()
    items = stored(_with_templates(items.drop("x")).distinct().withColumn("row", F.monotonically_increasing_id()), "items")
    short = [r.size for r in items.where(F.col("size") < width).select("size").distinct().collect()]  # at most width - 1 numbers
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64(text).alias("h"), text.alias("x")).where("x is not null")

    def parts(texts: DataFrame) -> DataFrame:
        clean = texts.withColumn("x", cleaned(F.col("x")))
        if len(vocabulary) > VOCABULARY:
            return clean.withColumn("part", F.lit(0))
        return matchable(clean, sorted({r.w for r in vocabulary} | set(UNITS)), min([*short, width]))

    words = _with_templates(parts(base).select("d", "h", "part", slots(F.col("x")).alias("s"))).drop("s")
    found = None
    for n in sorted({*short, width}):
        keys = _windows(items.where(F.col("size") >= width if n == width else F.col("size") == n).select("row", *FORMS), n, "j", item=True)
        keys = stored(keys.distinct(), "item-windows")
        if keys.count() <= BROADCAST_WINDOWS:  # rows of 20 bytes
            keys = F.broadcast(keys)
        hits = _windows(words, n, "i").join(keys, "window").groupBy("d", "h", "part", "row").agg(F.collect_set(F.col("i") - F.col("j")).alias("shifts"))
        hits = hits.withColumn("width", F.lit(n))
        found = hits if found is None else found.unionByName(hits)
    found = stored(found, "matches")
    # the words of both sides, only for documents with a match: one row for each alignment, ``b`` beside the item's words
    held = found.select("d", "h").distinct().withColumnsRenamed({"d": "d2", "h": "h2"})
    texts = parts(base.join(held, F.expr("d <=> d2 and h = h2"), "left_semi").dropDuplicates(["d", "h"]))
    texts = texts.select(F.col("d").alias("d2"), F.col("h").alias("h2"), F.col("part").alias("part2"), slots(F.col("x")).alias("own"))
    both = found.join(texts, F.expr("d <=> d2 and h = h2 and part = part2")).join(items.select("row", "item", "size", F.col("s").alias("theirs")), "row")
    beside = F.transform("shifts", lambda s: F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda k: F.get("own", (k + s).cast("int"))))
    rows = both.select("d", "h", "row", "item", "size", "width", "theirs", F.explode(beside).alias("b")).withColumn("c", F.zip_with("theirs", "b", _compared))
    rows = rows.withColumn("loose", _matched(LOOSE)).withColumn("typed", _matched(TYPED)).withColumn("equal", _matched(EQUAL))
    # where slots conflict, literal windows still count
    places = F.when(_consistent(F.col("loose")), F.col("loose")).when(_consistent(F.col("typed")), F.col("typed")).otherwise(F.col("equal"))
    rows = rows.withColumn("places", places)
    rows = rows.withColumn("run", _literal_run() >= run).select("d", "h", "row", "item", "size", "run", "places")
    # each alignment adds its places: an inserted or deleted word shifts what follows
    whole = rows.select("d", "h", "row", "item", "size", "run", F.explode_outer("places").alias("place")).groupBy("d", "h", "row", "item", "size").agg(F.count_distinct("place").alias("covered"), F.max("run").alias("run"))
    good = whole.where(F.col("run") | (F.col("covered") >= coverage * F.col("size")))
    return good.groupBy("d", "h", "item", F.col("size").alias("words")).agg(F.max("covered").alias("covered"))


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with contaminated (boolean) and items (sorted ids of the benchmark items it holds).

    All rows and columns stay; where a name is taken, underscores go in front of the new one.
    NULL and empty texts, and texts shorter than any item's window, are clean. Very long texts are compared whole. NULL and empty
    benchmark texts match nothing; without a benchmark all rows are clean. Rows with equal key
    and text are judged alike, NULL keys too; all consistent alignments of an item count together.
    """
    flag, found, key, hashed = (free_name(docs, x) for x in ("contaminated", "items", "_d", "_h"))
    held = leaks(docs, benchmark, width, coverage, id_col, text_col).groupBy("d", "h").agg(F.array_sort(F.collect_set("item")).alias(found))
    held = held.withColumnsRenamed({"d": key, "h": hashed})
    out = docs.join(held, docs[id_col].cast("long").eqNullSafe(held[key]) & (F.xxhash64(docs[text_col].cast("string")) == held[hashed]), "left")
    out = out.withColumn(flag, F.col(hashed).isNotNull()).withColumn(found, F.coalesce(F.col(found), F.array().cast("array<long>")))
    return out.select(*docs.columns, flag, found)
