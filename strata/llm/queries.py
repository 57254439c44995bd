"""Registered queries of the operators: thin calls with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import remainder_is

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.packing import pack, piece_digests

    return piece_digests(pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import scratch
    from strata.llm.token_file import read_token_files, token_digests, write_token_files

    folder = scratch(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"))
    return token_digests(read_token_files(spark, folder, manifest))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.quality import fit_quality, learnable, score_quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, learnable(table(spark, sf_dir, "labels"), 4, 2))
    scored = score_quality(docs, model)
    return scored.select("doc_id", remainder_is(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.langid import fit_languages, identify_language
    from strata.llm.quality import learnable

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(learnable(docs, 5, 0))
    return identify_language(docs.drop("lang"), model).select("doc_id", remainder_is(F.col("doc_id"), 5, 0).alias("held_out"), "found.lang_pred", "found.score")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.quality import learnable
    from strata.llm.toxicity import fit_toxicity, score_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, learnable(table(spark, sf_dir, "labels"), 3, 1))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", remainder_is(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.embed_dedup import embedding_groups

    return embedding_groups(table(spark, sf_dir, "embeddings"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.decontaminate import mark_contaminated

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mark_contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "contaminated", "items")


@query
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.minhash import duplicate_classes

    return duplicate_classes(table(spark, sf_dir, "documents"))


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.pii import personal_spans, span_digests

    return span_digests(personal_spans(table(spark, sf_dir, "documents")))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.lexical import lexical_search

    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.graph_search import nearest_neighbours

    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.runs import collapse_runs

    found = collapse_runs(table(spark, sf_dir, "documents"), plant=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


ORACLE["op2_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.a AS vec_id, coalesce(any_value(d.n), 0) AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r LEFT JOIN degree d ON d.a = r.a GROUP BY r.a
"""

#: Every run of lines with 50 words or more that is shortest from its first or to its last line, by its text.
ORACLE["op10_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
filled AS (SELECT *, len(regexp_extract_all(s, '[\p{L}\p{N}]+')) AS w FROM lines),
placed AS (
  SELECT *, row_number() OVER place AS p, sum(w) OVER place AS upto FROM filled WHERE w > 0
  WINDOW place AS (PARTITION BY doc_id ORDER BY line)),
ends AS (
  SELECT a.doc_id, a.p AS first, min(b.p) AS last FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.p BETWEEN a.p AND a.p + 49
  WHERE b.upto - a.upto + a.w >= 50 GROUP BY ALL
  UNION
  SELECT a.doc_id, max(b.p), a.p FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.p BETWEEN a.p - 49 AND a.p
  WHERE a.upto - b.upto + b.w >= 50 GROUP BY a.doc_id, a.p),
runs AS (
  SELECT e.doc_id, e.first, e.last, string_agg(p.s, chr(10) ORDER BY p.p) AS content
  FROM ends e JOIN placed p ON p.doc_id = e.doc_id AND p.p BETWEEN e.first AND e.last GROUP BY e.doc_id, e.first, e.last),
later AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, first) AS copy FROM runs),
gone AS (
  SELECT DISTINCT p.doc_id, p.line FROM later l JOIN placed p ON p.doc_id = l.doc_id AND p.p BETWEEN l.first AND l.last WHERE l.copy > 1),
rest AS (
  SELECT f.doc_id, count(*) AS n_lines, count(g.line) AS n_deleted, sum(CASE WHEN g.line IS NULL THEN f.w END) AS words,
    string_agg(CASE WHEN g.line IS NULL THEN f.s END, chr(10) ORDER BY f.line) AS kept
  FROM filled f LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.line = g.line GROUP BY f.doc_id)
SELECT d.doc_id, CASE WHEN r.n_deleted > 0 AND coalesce(r.words, 0) = 0 THEN '' WHEN r.n_deleted > 0 THEN r.kept ELSE d.text END AS text,
  coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_deleted, 0) AS n_deleted
FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id
"""

#: All documents scored for all items; integers as in the operator.
ORACLE["op11_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
size AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM words WHERE len(ts) > 0),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS t FROM words) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf WHERE t IN (SELECT t FROM items) GROUP BY t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, size),
scored AS (
  SELECT i.item_id, f.doc_id, CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 8 * (100 - 90 + (90 * f.n * s.docs) // s.total)))) AS BIGINT) AS score
  FROM items i JOIN tf f ON f.t = i.t JOIN w ON w.t = i.t, size s GROUP BY i.item_id, f.doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""
