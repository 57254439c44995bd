"""Column masks and row filters applied at read time, per reader."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.masks import (
    mask_document_id, mask_email, mask_full_name, mask_phone, users_rls,
)

USER_MASKS: Mapping[str, Callable[..., Column]] = {
    "full_name": mask_full_name,
    "document_id": mask_document_id,
    "email": mask_email,
    "phone": mask_phone,
}


def apply_masks(df: DataFrame, groups: Iterable[str] = (),
                masks: Mapping[str, Callable[..., Column]] = USER_MASKS) -> DataFrame:
    """Replace each masked column in place (column order kept)."""
    groups = tuple(groups or ())
    return df.select(*[masks[c](c, groups).alias(c) if c in masks else F.col(c)
                       for c in df.columns])


def row_filter(df: DataFrame, groups: Iterable[str] = (), column: str = "segment",
               predicate: Callable[..., Column] = users_rls) -> DataFrame:
    """Keep rows the reader may see; the predicate is pushed to the scan when possible."""
    return df.filter(predicate(column, tuple(groups or ())))


def secure_view(df: DataFrame, groups: Iterable[str] = (),
                masks: Mapping[str, Callable[..., Column]] = USER_MASKS,
                filter_column: str = "segment",
                predicate: Callable[..., Column] = users_rls) -> DataFrame:
    """What a reader in ``groups`` sees of users_silver: row filter, then masks.

    The filter runs on the unmasked value (policies see real data), then masks apply.
    """
    return apply_masks(row_filter(df, groups, filter_column, predicate), groups, masks)
