"""Observability: expectations, per-layer record counts and dashboard metrics.

A metric is a set of named measures evaluated at a chosen set of dimensions, i.e. one
``groupBy(*dims).agg(*measures)`` over a dataset; filter widgets become ``filter``
before the grouping so Catalyst can push them to the scans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata import vocab
from strata.operators.entities import VALID

LAYER_ORDER = ("Bronze", "Silver", "Gold")


# ---------------------------------------------------------------- expectations
def expectations() -> dict[str, list[tuple[str, Column]]]:
    """Warn-only expectations per silver table (rows are kept, failures counted)."""
    return {
        "transactions_silver": [
            ("valid_amount", F.col("amount").isNotNull() & (F.col("amount") > 0)),
            ("date_parsed", F.col("transaction_date").isNotNull()),
        ],
        "users_silver": [("valid_email", F.col("email").rlike(vocab.EMAIL))],
        "merchants_silver": [("valid_affiliation_date", F.col("affiliation_date").isNotNull())],
    }


def expectation_counts(df: DataFrame, table: str, checks: Sequence[tuple[str, Column]],
                       scopes: Mapping[str, Column]) -> DataFrame:
    """Passed and failed rows per expectation and scope (a condition on the row), in one aggregate.

    A NULL expectation counts as failed.
    """
    cells, names = [], []
    for scope, inside in scopes.items():
        for name, cond in checks:
            ok, at = F.coalesce(cond, F.lit(False)), len(names)
            cells += [F.count_if(inside & ok).alias(f"p{at}"), F.count_if(inside & ~ok).alias(f"f{at}")]
            names.append((name, scope))
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("expectation"), F.lit(scope).alias("scope"),
                     F.col(f"p{k}").alias("passed"), F.col(f"f{k}").alias("failed")) for k, (name, scope) in enumerate(names)]
    return df.agg(*cells).select(F.inline(F.array(*rows)))


def expectation_metrics(judged: Mapping[str, DataFrame]) -> DataFrame:
    """Expectation counts of each silver table: on its rows (output) and on all winners before the
    validity filter (input), where failures carry information.

    ``judged`` holds the winners with their ``_valid`` flag, so both scopes share one pass.
    """
    checks, scopes = expectations(), {"output": F.col(VALID), "input": F.lit(True)}
    return reduce(DataFrame.unionByName, [expectation_counts(df, t, checks[t], scopes) for t, df in judged.items()])


def observed(df: DataFrame, name: str, checks: Sequence[tuple[str, Column]] = ()) -> tuple[DataFrame, Observation]:
    """Attach row count and expectation counters to a frame that is about to be written.

    The counters are computed in the same pass as the write (``DataFrame.observe``) and
    read from the returned ``Observation`` after the action; works for streams too.
    """
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for check, cond in checks:
        ok = F.coalesce(cond, F.lit(False))
        aggs += [F.count_if(ok).alias(f"{check}__passed"), F.count_if(~ok).alias(f"{check}__failed")]
    return df.observe(obs, *aggs), obs


def run_log(spark, run_id: str, entries: Iterable[tuple[str, str, Mapping[str, int]]]) -> DataFrame:
    """One row per (table, metric) of a run: run_id, layer, table_name, metric, value.

    Built from the observed counters of each write (one small row per metric), so its
    size is bounded by tables x expectations, not by the data.
    """
    rows = [(run_id, layer, table, metric, int(value))
            for layer, table, metrics in entries for metric, value in sorted(metrics.items())]
    return spark.createDataFrame(
        rows, "run_id string, layer string, table_name string, metric string, value long")


# ---------------------------------------------------------------- layer counts
def records_by_layer(tables: Iterable[tuple[str, str, DataFrame]]) -> DataFrame:
    """(layer, table_name, ingested_at, record_count) for every table, UNION ALL.

    ``_ingested_at`` is a timestamp in bronze and a date afterwards; it is cast to DATE
    explicitly so the union has one type. ``count(*)`` per table reads only that column.
    """
    parts = [df.groupBy(F.to_date(F.col("_ingested_at")).alias("ingested_at"))
               .agg(F.count(F.lit(1)).alias("record_count"))
               .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"),
                       "ingested_at", "record_count")
             for layer, name, df in tables]
    return reduce(DataFrame.unionAll, parts)


MEASURES: dict[str, Callable[[], Column]] = {
    "total_records": lambda: F.sum("record_count"),
    "count": lambda: F.count(F.lit(1)),
}


def metric(df: DataFrame, dims: Sequence[str] = (), measures: Sequence[str] = ("total_records",),
           where: Column | None = None,
           definitions: Mapping[str, Callable[[], Column]] = MEASURES) -> DataFrame:
    """Evaluate named measures at ``dims`` (empty = grand total), after ``where``."""
    if where is not None:
        df = df.filter(where)
    aggs = [definitions[m]().alias(m) for m in measures]
    return df.groupBy(*dims).agg(*aggs) if dims else df.agg(*aggs)


def filter_counts(df: DataFrame, field: str, predicate: Column) -> DataFrame:
    """Filter-widget query: per value of ``field``, how many rows pass ``predicate``."""
    return df.groupBy(field).agg(F.count_if(F.coalesce(predicate, F.lit(False)))
                                 .alias(f"{field}_associativity"))


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First page of a table under a total order (the limit is the feature)."""
    return df.orderBy(*order).limit(n)


def rollup_count(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """COUNT(*) by dimensions (event-log style dataset)."""
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("count"))
