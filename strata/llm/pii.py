"""Personal data: fixed patterns, and bootstrapped contextual extraction of further identifiers.

The base finds e-mail, IP, card and phone spans by fixed patterns. They are the seeds: words left
of them, or the quoting around them, are lexical patterns, and every identifier-like token of the
corpus is an instance that its patterns may vouch for. Spark keeps the pattern-instance graph as a
table of counts and scores patterns and instances in turn; instances next to patterns of high
confidence are new identifiers and become spans of the kind ``found``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, free_name, stored

KINDS = ("email", "ip", "card", "phone", "found")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CLUSTER = re.compile(r"[0-9][\x20().0-9-]*")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
#: Identifier-like tokens hold a digit and nothing but these signs, four characters at least.
_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_@#+./:-")
_TAIL = re.compile(r"[0-9A-Za-z_@#+./:-]*")
_DIGIT = re.compile(r"[0-9]")
#: Digit groups joined by space, bracket, dot or dash, in the shape of cards and phones.
_GROUPED = re.compile(r"(?<![\w@#+./:(-])\(?[0-9]+(?:(?:[\x20.-]|\)[\x20.-]?|\x20\()[0-9]+)+(?![\w@])")
_BEFORE = re.compile(r"(?:([^\W\d_]+)[^\w\n]{0,3}[\x20\t]+)?([^\W\d_]+)[\"']?[\x20\t]*([=:#]?)[\x20\t]*([\"'(\[<]?)$")
#: How much text before a token its patterns may take up.
REACH = 60


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, from one at sign to the next, so long words cost no more than their length."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted; kinds by their place in ``KINDS``."""
    out = [(a, 0, b) for a, b in emails(text)]
    for cluster in _CLUSTER.finditer(text):  # all digit patterns lie inside one run of these signs
        a, b = cluster.span()
        if b - a < 3:
            continue
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text, a, b) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text, a, b):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if a and text[a - 1] == "+":
            end = a + len(cluster[0].rstrip(" ().-"))
            if end - a >= 3 and 9 <= sum(map(str.isdigit, text[a:end])) <= 15:
                out.append((a - 1, 3, end))
    return sorted(out)


def tokens(text: str) -> Iterator[tuple[int, int]]:
    """Identifier-like tokens, found from their digits: texts without digits cost one search."""
    last, digit = 0, _DIGIT.search(text)
    while digit:
        a = digit.start()
        while a > last and text[a - 1] in _SIGNS:
            a -= 1
        end = last = _TAIL.match(text, digit.start()).end()
        while text[a] in "./:-":
            a += 1
        while text[end - 1] in "./:-":
            end -= 1
        if end - a >= 4:
            yield a, end
        digit = _DIGIT.search(text, last)


def contexts(text: str, start: int) -> list[str]:
    """Lexical patterns left of a place: the word before with its sign and quote, and the two words before."""
    m = _BEFORE.search(text, max(0, start - REACH), start)
    if not m or not (m[3] or m[4] or m[2]):
        return []
    sign = m[3] + m[4]
    near = f"{m[2].lower()} {sign}"
    return [near, f"{m[1].lower()} {near}"] if m[1] else [near]


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str, bool, list[str]]]:
    """(start, end, value, whether it is a base span, its patterns) of identifier-like tokens and base spans."""
    for a, _, b in base:
        if found := contexts(text, a):
            yield a, b, text[a:b], True, found
    single = list(tokens(text))
    grouped = [m.span() for m in _GROUPED.finditer(text) if m.end() - m.start() >= 4] if single or _DIGIT.search(text) else []
    k = 0
    for a, b in sorted({*single, *grouped}):
        while k < len(base) and base[k][2] <= a:
            k += 1
        if not (k < len(base) and base[k][0] < b) and (found := contexts(text, a)):
            yield a, b, text[a:b], False, found


_SPAN = "struct<start:long,kind:int,end:long>"
_FOUND = "struct<start:long,end:long,value:string,known:boolean,patterns:array<string>>"


def extract(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, h, base, cands) of each row: key, hash of the text, base spans, candidates with patterns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
        found = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("known", pa.bool_()), ("patterns", pa.list_(pa.string()))]))
        for batch in batches:
            base, cands = [], []
            for text in batch.column(2).to_pylist():
                spans = base_spans(text or "")
                base.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans])
                cands.append([dict(zip(("start", "end", "value", "known", "patterns"), c, strict=True)) for c in candidates(text or "", spans)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base, span), pa.array(cands, found)], names=["d", "h", "base", "cands"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64(text).alias("h"), text.alias("t")).mapInArrow(run, f"d long, h long, base array<{_SPAN}>, cands array<{_FOUND}>")


def confident_patterns(mentions: DataFrame, rounds: int, least: float, support: int) -> DataFrame:
    """Patterns of which enough instances are known or vouched for, after ``rounds`` of scoring and until it stands still.

    ``mentions`` has pattern, value, known. A pattern's confidence is the mean score of its distinct
    instances, with one more counted as 0; an instance's score is 1 if a base span has its value,
    else the chance that one of its confident patterns is right. Repeated mentions count once.
    """
    edges = stored(mentions.groupBy("pattern", "value").agg(F.max("known").alias("known")), "pattern-graph")
    score = edges.groupBy("value").agg(F.max(F.col("known").cast("double")).alias("score"))
    before, n = None, 0
    while True:
        by = edges.join(score, "value").groupBy("pattern").agg(F.sum("score").alias("right"), F.count("*").alias("all"))
        patterns = stored(by.where((F.col("right") >= support) & (F.col("right") / (F.col("all") + 1) >= least)).select("pattern", (F.col("right") / (F.col("all") + 1)).alias("confidence")), "patterns")
        n, now = n + 1, patterns.agg(F.count("*"), F.coalesce(F.sum("confidence"), F.lit(0.0))).first()
        # scores only rise, so equal counts are equal sets
        if n >= rounds and before is not None and now[0] == before[0] and now[1] - before[1] < 1e-3:
            return patterns
        before = now
        doubt = F.exp(F.sum(F.log(1 - F.coalesce("confidence", F.lit(0.0)))))
        score = stored(edges.join(patterns, "pattern", "left").groupBy("value").agg(F.greatest(F.max(F.col("known").cast("double")), 1 - doubt).alias("score")), "instances")


def personal_spans(docs: DataFrame, rounds: int = 3, least: float = 0.5, support: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of each row; spans are sorted structs of start, kind (place in ``KINDS``) and end.

    Places count code points, ends are exclusive. Base spans always stay; tokens next to confident
    patterns are added as ``found``. NULL and empty texts have no spans. Rows with equal key and text
    get the same spans, NULL keys too; other columns are ignored and an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = stored(extract(docs, id_col, text_col), "mentions")
    cands = rows.select("d", "h", F.explode("cands").alias("c")).select("d", "h", "c.*")
    cands = cands.select("d", "h", "start", "end", F.xxhash64(F.lower("value")).alias("value"), "known", F.explode("patterns").alias("pattern"))
    good = confident_patterns(cands.select("pattern", "value", "known"), rounds, least, support)
    new = cands.where(~F.col("known")).join(good, "pattern").select("d", "h", "start", "end").groupBy("d", "h", "start").agg(F.max("end").alias("end"))  # a run of groups, not its first
    new = new.groupBy("d", "h").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("found")).alias("kind"), "end")).alias("new"))
    new = new.withColumnsRenamed({"d": "d2", "h": "h2"})
    out = rows.select("d", "h", "base").join(new, F.expr("d <=> d2 and h = h2"), "left")
    return out.select(F.col("d").alias("doc_id"), F.array_sort(F.concat("base", F.coalesce("new", F.array().cast(f"array<{_SPAN}>")))).alias("spans"))


def _count(kind: int) -> Column:
    """Spans of a kind; Spark takes a second parameter of the function, even one with a default, as the place in the array."""
    return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")


def span_digests(rows: DataFrame) -> DataFrame:
    """The contract's columns: counts of base spans, the digest of their list, and the list of all spans."""
    names = F.array(*[F.lit(k) for k in KINDS])
    base = F.filter("spans", lambda s: s.kind < KINDS.index("found"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")
    counts = [_count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])]
    return rows.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def mask_spans(docs: DataFrame, out: str = "masked", text_col: str = "text") -> DataFrame:
    """``docs`` with a column in which every base span of the text is replaced by its kind in brackets.

    Overlapping spans are replaced as one, by the kind of the first. NULL texts stay NULL.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        done = []
        for text in texts:
            parts, last = [], 0
            for a, kind, b in base_spans(text or ""):
                if a >= last:
                    parts += [text[last:a], f"[{KINDS[kind]}]"]
                last = max(last, b)
            done.append(None if text is None else "".join(parts) + text[last:])
        return pd.Series(done, dtype=object)

    return docs.withColumn(free_name(docs, out), mask(F.col(text_col).cast("string")))
