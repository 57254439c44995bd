"""Repair of days that a watermarked stream has closed: what came late is put right by corrections.

The stream appends the groups of a day once the watermark passes its end and then forgets them, so
its state is bounded by the days in between and rows that come later are lost to it. A repair
compares, day by day, how many rows silver and the repaired fact hold, regroups only the days that
differ, and appends those of their groups that changed as corrections: whole groups, of which the
newest counts; a group that is gone has no rows in its correction. The cheap comparison is one count
per day on either side, and days that agree are not read further.

Rows without a date never enter a window; they are a "day" of their own that only repairs fill.
A day that is still open is read from silver itself. A count cannot see a winner replaced by
another of the same day in a day of unchanged size: ``days`` names such days to a repair (the
dates of silver's change rows, see ``streaming.incremental``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.gold import FACT_KEYS
from strata.sources.files import delete, names, write_marker
from strata.streaming.fact import _with_risk, daily_groups

CLOSED, CORRECTIONS = "closed", "corrections"
DAY = "transaction_date"
MEASURES = ("total_amount", "transaction_count", "reversal_rate")


def run_closed_groups(tx_stream: DataFrame, path: str, checkpoint: str, lateness: str, channels: DataFrame | None = None) -> None:
    """One ``availableNow`` run that appends the groups of days ``lateness`` old; merchants are joined when it is read."""
    q = (daily_groups(tx_stream, channels, lateness).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _corrections(spark: SparkSession, root: str) -> list[str]:
    """Folders of finished repairs, oldest first; folders without a marker are left by failed ones."""
    return [n.removesuffix(".json") for n in names(spark, f"{root}/{CORRECTIONS}/done")]


def _repaired(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """Groups of closed days as corrected so far: the newest of each group, gone ones left out."""
    closed = f"{root}/{CLOSED}"
    parts = [spark.read.parquet(closed) if names(spark, closed) else like.limit(0)]
    parts += [spark.read.parquet(f"{root}/{CORRECTIONS}/{n}") for n in _corrections(spark, root)]
    rows = reduce(DataFrame.unionByName, [p.select(*FACT_KEYS, *MEASURES).withColumn("_version", F.lit(v)) for v, p in enumerate(parts)])
    newest = rows.groupBy(*FACT_KEYS).agg(F.max(F.struct("_version", *MEASURES)).alias("v"))
    return newest.where(F.col("v.transaction_count") > 0).select(*FACT_KEYS, *[F.col("v")[c].alias(c) for c in MEASURES])


def _last_closed(spark: SparkSession, root: str):
    closed = f"{root}/{CLOSED}"
    return spark.read.parquet(closed).agg(F.max(DAY)).first()[0] if names(spark, closed) else None


def _closed(last) -> Column:
    """Whether a row's day is closed; rows without a date count as closed."""
    return F.col(DAY).isNull() | (F.col(DAY) <= F.lit(last).cast("date"))


def repair_closed_days(spark: SparkSession, root: str, tx_silver: DataFrame, channels: DataFrame | None = None,
                       days: Iterable = ()) -> bool:
    """Append corrections for closed days whose rows differ from ``tx_silver``; False if none do.

    A repair becomes visible by its marker, written last; one that fails leaves a folder that no
    reader sees, and running it again gives the same rows.
    """
    last = _last_closed(spark, root)
    rows = tx_silver.where(_closed(last))
    groups = daily_groups(rows, channels)
    held = _repaired(spark, root, groups)
    seen = rows.groupBy(DAY).agg(F.count(F.lit(1)).alias("n"))
    known = held.groupBy(F.col(DAY).alias("_day")).agg(F.sum("transaction_count").alias("_n"))
    differ = (seen.join(known, F.col(DAY).eqNullSafe(F.col("_day")), "full_outer")
              .where(~F.col("n").eqNullSafe(F.col("_n")) | F.coalesce(F.col(DAY), F.col("_day")).isin(*days))
              .select(F.coalesce(DAY, "_day").alias("_day")))

    def of_days(df: DataFrame) -> DataFrame:
        return df.join(differ, F.col(DAY).eqNullSafe(F.col("_day")), "left_semi")

    now = daily_groups(of_days(rows), channels).select(*FACT_KEYS, F.struct(*MEASURES).alias("now"))
    before = of_days(held).select(*[F.col(c).alias(f"_{c}") for c in FACT_KEYS], F.struct(*MEASURES).alias("before"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FACT_KEYS])
    measures = [F.coalesce(F.col("now")[c], F.lit(0)).alias(c) for c in MEASURES]
    changed = (now.join(before, same, "full_outer").where(~F.col("now").eqNullSafe(F.col("before")))
               .select(*[F.when(F.col("now").isNotNull(), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in FACT_KEYS], *measures))
    number = len(_corrections(spark, root))
    name = f"{number:012d}-{uuid.uuid4().hex}"
    changed.write.parquet(f"{root}/{CORRECTIONS}/{name}")
    if spark.read.parquet(f"{root}/{CORRECTIONS}/{name}").isEmpty():
        delete(spark, f"{root}/{CORRECTIONS}/{name}")
        return False
    write_marker(spark, f"{root}/{CORRECTIONS}/done/{name}.json", "{}")
    return True


def read_repaired_fact(spark: SparkSession, root: str, tx_silver: DataFrame, merchants_silver: DataFrame,
                       channels: DataFrame | None = None) -> DataFrame:
    """The whole fact: closed days with their corrections, and the days still open from silver."""
    last = _last_closed(spark, root)
    open_days = daily_groups(tx_silver.where(~_closed(last)) if last is not None else tx_silver.where(F.col(DAY).isNotNull()), channels)
    groups = _repaired(spark, root, open_days)
    return _with_risk(groups.unionByName(open_days.select(*FACT_KEYS, *MEASURES)), merchants_silver)
