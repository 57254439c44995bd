"""Column-level building blocks: all built-in Spark expressions (codegen, no UDFs)."""

from strata.functions.codes import (
    channel_id, doc_priority, name_priority, present, risk_score, status_priority,
)
from strata.functions.masks import (
    mask_document_id, mask_email, mask_full_name, mask_phone, register_sql_functions,
    users_rls,
)
from strata.functions.parse import amount_value, clean_amount, parse_date
from strata.functions.stamps import load_date, load_timestamp

__all__ = [
    "amount_value", "channel_id", "clean_amount", "doc_priority", "load_date",
    "load_timestamp", "mask_document_id", "mask_email", "mask_full_name", "mask_phone",
    "name_priority", "parse_date", "present", "register_sql_functions", "risk_score",
    "status_priority", "users_rls",
]
