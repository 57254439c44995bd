"""DataFrame -> DataFrame operators of the medallion pipeline."""

from strata.operators.dedup import keep_best, order_key, rank_rows
from strata.operators.entities import ENTITIES, MERCHANTS, TRANSACTIONS, USERS, Entity
from strata.operators.gold import (
    dim_channel, dim_date, dim_merchant, dim_user, enrich_channel, enrich_risk,
    fact_transactions, merchant_risk, reversal_rate,
)
from strata.operators.governance import apply_masks, row_filter, secure_view
from strata.operators.observe import (
    expectation_metrics, filter_counts, metric, records_by_layer, rollup_count, top_n,
)
from strata.operators.quarantine import (
    parse_record, quarantine, rejected, rejected_merchants, rejected_transactions,
    rejected_users, unaccounted,
)
from strata.operators.rules import Rule, first_match
from strata.operators.silver import silver, silver_merchants, silver_transactions, silver_users

__all__ = [
    "ENTITIES", "MERCHANTS", "TRANSACTIONS", "USERS", "Entity", "Rule", "apply_masks",
    "dim_channel", "dim_date", "dim_merchant", "dim_user", "enrich_channel", "enrich_risk",
    "expectation_metrics", "fact_transactions", "filter_counts", "first_match", "keep_best",
    "merchant_risk", "metric", "order_key", "parse_record", "quarantine", "rank_rows",
    "records_by_layer", "rejected", "rejected_merchants", "rejected_transactions",
    "rejected_users", "reversal_rate", "rollup_count", "row_filter", "secure_view", "silver",
    "silver_merchants", "silver_transactions", "silver_users",
    "top_n", "unaccounted",
]
