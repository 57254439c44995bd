"""The three landing entities, each declared once: key, dedup order, and its fields.

A field states how it is stored and a list of checks. A check is one three-valued condition on the
raw row with its reject message: TRUE passes, FALSE rejects, NULL does neither (the row is
reported as unaccounted). The silver predicate (all checks TRUE) and the ordered reject rules
(first check FALSE) both come from this declaration, so they cannot drift apart. All conditions
are Column expressions of one row and can be evaluated anywhere in a plan, batch or stream.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import vocab
from strata.functions.codes import doc_priority, name_priority, present, status_priority
from strata.functions.parse import amount_value, clean_amount, parse_date
from strata.functions.stamps import load_date
from strata.operators.rules import Rule

VALID = "_valid"
DUP = "_dup"  # NULL: key is NULL; False: the one winner of its key; True: a duplicate

Condition = Callable[[Column], Column]


@dataclass(frozen=True)
class Field:
    """A landing column: the form it is stored in and its (message, condition) checks, in order."""

    name: str
    stored: Condition = lambda c: c
    checks: tuple[tuple[str, Condition], ...] = ()

    def rules(self) -> list[Rule]:
        return [Rule(~holds(F.col(self.name)), message, self.name) for message, holds in self.checks]


@dataclass(frozen=True)
class Entity:
    name: str                        # source_name in quarantine
    key: str
    key_messages: tuple[str, str]    # key is NULL, key is a duplicate
    columns: tuple[str, ...]         # raw data columns, landing order
    date: str                        # raw date column, second sort key
    priority: Callable[[], Column]   # first sort key (higher wins)
    fields: tuple[Field, ...]        # all columns but the key, in silver and rule order

    @property
    def silver_columns(self) -> tuple[str, ...]:
        return (self.key, *(f.name for f in self.fields), "_ingested_at")

    def rules(self) -> list[Rule]:
        """Reject rules in precedence order: the key's, then each field's failed checks."""
        missing, repeated = self.key_messages
        of_key = [Rule(F.col(self.key).isNull(), missing, self.key), Rule(F.col(DUP), repeated, self.key)]
        return of_key + [r for f in self.fields for r in f.rules()]

    def valid(self) -> Column:
        """Silver predicate on a winner: every check holds (winners have a key already)."""
        return reduce(and_, (holds(F.col(f.name)) for f in self.fields for _, holds in f.checks))

    def normalize(self, df: DataFrame, as_of=None, *extra: Column) -> DataFrame:
        """The stored form of each row, in silver order, with its load date and ``extra`` columns."""
        return df.select(self.key, *(f.stored(F.col(f.name)).alias(f.name) for f in self.fields),
                         load_date(as_of).alias("_ingested_at"), *extra)

    def judged(self, winners: DataFrame, as_of=None) -> DataFrame:
        """All winners in stored form, with ``_valid``: whether silver keeps the row."""
        return self.normalize(winners, as_of, F.coalesce(self.valid(), F.lit(False)).alias(VALID))


# ---------------------------------------------------------------- kinds of fields
def required(name: str, message: str, stored: Condition = lambda c: c, *more: tuple[str, Condition]) -> Field:
    return Field(name, stored, ((message, lambda c: c.isNotNull()), *more))


def member(name: str, values: tuple[str, ...], message: str, case: Callable[[Column], Column] = F.lower,
           optional: bool = False) -> Field:
    """One of a closed vocabulary whatever its case; stored trimmed, in the vocabulary's case."""
    def holds(c: Column) -> Column:
        known = case(c).isin(*values)
        return c.isNull() | known if optional else known

    return Field(name, lambda c: case(F.trim(c)), ((message, holds),))


def text(name: str, message: str, pattern: str, wanted: bool = True) -> Field:
    """Not blank, and matching a pattern (or not, if it is an unwanted one)."""
    return Field(name, checks=((message, lambda c: present(c) & (c.rlike(pattern) if wanted else ~c.rlike(pattern))),))


def iso_date(name: str, message: str) -> Field:
    return Field(name, lambda c: parse_date(c), ((message, lambda c: parse_date(c).isNotNull()),))


# ---------------------------------------------------------------- the entities
def _is(column: str, value: str) -> Column:
    return F.col(column) == value


TRANSACTIONS = Entity(
    name="transactions", key="transaction_id", key_messages=(vocab.TX_ID_NULL, vocab.TX_ID_DUP),
    columns=vocab.TRANSACTION_COLUMNS, date="transaction_date", priority=lambda: status_priority("status"),
    fields=(
        required("user_id", vocab.TX_USER_NULL),
        required("merchant_id", vocab.TX_MERCHANT_NULL),
        required("amount", vocab.TX_AMOUNT_NULL, clean_amount, (vocab.TX_AMOUNT_NOT_POSITIVE, lambda c: amount_value(c) > 0)),
        required("transaction_date", vocab.TX_DATE_NULL, lambda c: parse_date(c, vocab.DATE_FORMAT, vocab.ALT_DATE_FORMAT)),
        Field("reference_id",
              lambda c: F.when(F.lower(F.trim(F.col("transaction_type"))) == vocab.REVERSAL, c).otherwise(F.lit(vocab.NO_REFERENCE)),
              ((vocab.TX_REFERENCE_MISSING, lambda c: c.isNotNull() | ~_is("transaction_type", vocab.REVERSAL)),)),
        member("channel", vocab.CHANNELS, vocab.TX_CHANNEL),
        member("transaction_type", vocab.TRANSACTION_TYPES, vocab.TX_TYPE),
        member("currency", vocab.CURRENCIES, vocab.TX_CURRENCY, F.upper),
        member("status", vocab.TRANSACTION_STATUSES, vocab.TX_STATUS),
    ),
)

USERS = Entity(
    name="users", key="user_id", key_messages=(vocab.U_ID_NULL, vocab.U_ID_DUP),
    columns=vocab.USER_COLUMNS, date="registration_date", priority=lambda: doc_priority("document_id"),
    fields=(
        text("full_name", vocab.U_NAME, vocab.NAME_FORBIDDEN, wanted=False),
        # only one country's documents have a fixed form; a missing country has none
        Field("document_id", lambda c: c.cast("string"),
              ((vocab.U_DOCUMENT, lambda c: ~_is("country", vocab.PERU).eqNullSafe(F.lit(True)) | c.rlike(vocab.PE_DOCUMENT)),)),
        text("email", vocab.U_EMAIL, vocab.EMAIL),
        text("phone", vocab.U_PHONE, vocab.PHONE),
        member("country", vocab.COUNTRIES, vocab.U_COUNTRY, F.upper, optional=True),
        member("segment", vocab.SEGMENTS, vocab.U_SEGMENT, optional=True),
        iso_date("registration_date", vocab.U_DATE),
    ),
)


def _risk_known(c: Column) -> Column:
    """A known level or none; an unknown one is rejected only beside a category, else undecided."""
    unknown = F.when(F.col("category").isNotNull(), F.lit(False))
    return F.when(c.isNull() | F.lower(c).isin(*vocab.RISK_LEVELS), F.lit(True)).otherwise(unknown)


MERCHANTS = Entity(
    name="merchants", key="merchant_id", key_messages=(vocab.M_ID_NULL, vocab.M_ID_DUP),
    columns=vocab.MERCHANT_COLUMNS, date="affiliation_date", priority=lambda: name_priority("merchant_name"),
    fields=(
        Field("merchant_name", checks=((vocab.M_NAME, present),)),
        member("category", vocab.MERCHANT_CATEGORIES, vocab.M_CATEGORY, optional=True),
        member("country", vocab.COUNTRIES, vocab.M_COUNTRY, F.upper, optional=True),
        iso_date("affiliation_date", vocab.M_DATE),
        member("status", vocab.MERCHANT_STATUSES, vocab.M_STATUS, optional=True),
        Field("risk_level", lambda c: F.lower(F.trim(c)),
              ((vocab.M_RISK_NULL, lambda c: c.isNotNull() | F.col("category").isNull()), (vocab.M_RISK, _risk_known))),
    ),
)

ENTITIES = {e.name: e for e in (TRANSACTIONS, USERS, MERCHANTS)}
