"""Keep-best deduplication and duplicate flagging without windows.

One total order per entity: (priority desc, raw date desc, every other column desc,
row id), NULL lowest everywhere. ``max`` over a struct of exactly those fields picks
the winner, so the winner and the duplicates are exact complements and ties can
only occur between byte-identical rows, where the row id decides.

Scale notes
* ``keep_best`` is a plain grouped ``max``: partial aggregation runs map-side, so a
  key holding a third of all rows collapses to one struct per map task before the
  shuffle. No task ever holds a whole group.
* ``rank_rows`` marks duplicates with an anti join on the *row id* of the winners,
  not on the business key. Row ids are unique, so that shuffle is uniform whatever
  the key distribution; a hot key never lands in one task. NULL-key rows (the usual
  hot group) cannot match a winner and skip that shuffle altogether. The join is a merge join by
  its hint: ids with file paths take little room in Parquet, so Spark's estimate of a stored
  winners table would broadcast all of them through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import vocab
from strata.operators.entities import DUP, Entity

BEST = "_best"
PRIORITY = "_priority"


def _order_fields(df: DataFrame, entity: Entity) -> list[str]:
    """Columns of the order struct after the priority, in comparison order."""
    rest = [c for c in df.columns if c not in (entity.key, entity.date, vocab.ROW_ID)]
    tail = [vocab.ROW_ID] if vocab.ROW_ID in df.columns else []
    return [entity.date, *rest, *tail]


def order_key(df: DataFrame, entity: Entity) -> Column:
    """The entity's total order as one comparable struct (greater = better)."""
    return F.struct(entity.priority().alias(PRIORITY), *[F.col(c) for c in _order_fields(df, entity)])


def keep_best(df: DataFrame, entity: Entity) -> DataFrame:
    """One row per non-NULL key: the greatest row under the entity's total order.

    Output has exactly the columns of ``df`` (the winner's raw values, unmixed).
    """
    key = entity.key
    best = (df.filter(F.col(key).isNotNull())
              .groupBy(key)
              .agg(F.max(order_key(df, entity)).alias(BEST)))
    return best.select(*[F.col(key) if c == key else F.col(BEST).getField(c).alias(c)
                         for c in df.columns])


def rank_rows(df: DataFrame, entity: Entity, winners: DataFrame | None = None) -> DataFrame:
    """Every input row plus ``_dup``: NULL for a NULL key, False for its key's winner,
    True for every other row of the key (``row_number() > 1`` in window terms).

    Needs a unique, stable ``_row_id`` column (see ``strata.sources.bronze``).
    """
    if vocab.ROW_ID not in df.columns:
        raise ValueError(f"rank_rows needs a unique {vocab.ROW_ID} column; "
                         "read bronze with strata.sources.bronze.read_bronze or with_row_id")
    key = entity.key
    winners = keep_best(df, entity) if winners is None else winners
    # NULL keys never match a winner: they bypass the shuffle (IS NULL is pushed to the scan)
    null_keys = df.filter(F.col(key).isNull()).withColumn(DUP, F.lit(None).cast("boolean"))
    duplicates = (df.filter(F.col(key).isNotNull())
                    .join(winners.select(vocab.ROW_ID).hint("merge"), vocab.ROW_ID, "left_anti")
                    .withColumn(DUP, F.lit(True)))
    return null_keys.unionByName(duplicates).unionByName(winners.withColumn(DUP, F.lit(False)))
