"""Reader policies kept as rows: which columns are masked, which rows a group may see, who is in a group.

A table's policies decide which columns of a reader's plan are masks and which filters it holds; whether
the reader is exempt, and which values the filter lets through, is looked up in the membership rows when the
plan runs, so a view follows later changes of membership. Those look-ups are uncorrelated scalar
subqueries: each gives one value, computed once and before the scan, and none joins the data.

Rows of ``POLICIES``: (table_name, column_name, rule, group_name, priority, allowed).

* ``rule`` is the name of a mask, and ``group_name`` a group that reads the column in clear; or
* ``rule`` is ``row_filter``, and ``allowed`` the column's values that the group may see, NULL for
  every row. Of the reader's groups with a filter on the column the one with the least ``priority``
  counts; a reader in none of them sees no row. NULL in the column is seen only where all rows are.

Filters read stored values, masks are applied above them. An unknown mask name is an error, a table
without policies is read as it is, and a policy on a column that the table lacks is an error too.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import vocab
from strata.functions.masks import mask_document_id, mask_email, mask_full_name, mask_phone

ROW_FILTER = "row_filter"
POLICY_SCHEMA = "table_name string, column_name string, rule string, group_name string, priority int, allowed array<string>"
MEMBER_SCHEMA = "reader string, group_name string"

#: Masks by the name that policy rows use: what a reader sees who is not exempt.
MASKS: Mapping[str, Callable[[str], Column]] = {
    "mask_full_name": mask_full_name, "mask_document_id": mask_document_id,
    "mask_email": mask_email, "mask_phone": mask_phone,
}

#: Policies of the silver users.
USER_POLICIES = (
    *(("users_silver", c, f"mask_{c}", vocab.GROUP_ENGINEERING, 0, None) for c in ("full_name", "document_id", "email", "phone")),
    ("users_silver", "segment", ROW_FILTER, vocab.GROUP_ENGINEERING, 1, None),
    ("users_silver", "segment", ROW_FILTER, vocab.GROUP_RISK, 2, list(vocab.RISK_VISIBLE_SEGMENTS)),
    ("users_silver", "segment", ROW_FILTER, vocab.GROUP_AUDIT, 3, list(vocab.AUDIT_VISIBLE_SEGMENTS)),
)


def policy_rows(spark: SparkSession, rows=USER_POLICIES) -> DataFrame:
    return spark.createDataFrame(list(rows), POLICY_SCHEMA)


def member_rows(spark: SparkSession, rows=()) -> DataFrame:
    """Group memberships, one row for each reader and group."""
    return spark.createDataFrame(list(rows), MEMBER_SCHEMA)


def _exempt(rules: DataFrame, groups: DataFrame, column: str) -> Column:
    """Whether the reader is in a group that reads the column in clear: one value for the plan."""
    clear = rules.where((F.col("column_name") == column) & (F.col("rule") != ROW_FILTER))
    return clear.join(groups, "group_name", "left_semi").agg((F.count(F.lit(1)) > 0).alias("exempt")).scalar()


def _visible(rules: DataFrame, groups: DataFrame, column: str) -> Column:
    """Whether the row's value is let through by the first of the reader's groups."""
    grants = rules.where((F.col("column_name") == column) & (F.col("rule") == ROW_FILTER)).join(groups, "group_name", "left_semi")
    first = grants.agg(F.min_by(F.struct(F.col("allowed").isNull().alias("every"), "allowed"), "priority").alias("grant"))
    every = F.coalesce(first.select(F.col("grant.every")).scalar(), F.lit(False))
    allowed = first.select(F.col("grant.allowed")).scalar()
    return every | F.coalesce(F.array_contains(allowed, F.col(column).cast("string")), F.lit(False))


def secure_table(df: DataFrame, name: str, policies: DataFrame, members: DataFrame, reader: str | None) -> DataFrame:
    """What ``reader`` sees of table ``name``; None, or a reader without groups, sees what nobody is exempt from.

    The policies that concern the table are read here (their number follows the columns, not the
    rows); memberships stay in the plan. Columns keep their names and order.
    """
    rules = policies.where(F.col("table_name") == name)
    stated = sorted({(r.column_name, r.rule) for r in rules.select("column_name", "rule").distinct().collect()})
    unknown = {rule for _, rule in stated} - {ROW_FILTER, *MASKS}
    lacking = {c for c, _ in stated} - set(df.columns)
    masked = [c for c, rule in stated if rule != ROW_FILTER]
    if unknown or lacking or len(masked) != len(set(masked)):
        raise ValueError(f"policies of {name}: unknown rules {sorted(unknown)}, columns not there {sorted(lacking)}, masks {masked}")
    groups = members.where(F.col("reader").eqNullSafe(F.lit(reader))).select("group_name")
    for column, rule in stated:
        if rule == ROW_FILTER:
            df = df.where(_visible(rules, groups, column))
    shown = {c: F.when(_exempt(rules, groups, c), F.col(c)).otherwise(MASKS[rule](c)) for c, rule in stated if rule != ROW_FILTER}
    return df.select(*[shown[c].alias(c) if c in shown else F.col(c) for c in df.columns])
