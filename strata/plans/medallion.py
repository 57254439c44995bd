"""The whole medallion pipeline as lazily composed DataFrames.

Nothing here executes: callers either return a frame (queries) or write the layers
(``strata.plans.publish.publish``). Each table is built on first access and cached, so a
query that needs one table neither reads nor analyzes the others, and tables that share
a sub-plan (the dedup winners) use the same DataFrame object, letting one job reuse its
shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from strata.operators import gold as G
from strata.operators.dedup import keep_best, rank_rows
from strata.operators.entities import ENTITIES
from strata.operators.quarantine import quarantine, rejected, unaccounted
from strata.operators.silver import silver

SILVER_NAMES = {"transactions": "transactions_silver", "users": "users_silver",
                "merchants": "merchants_silver"}
QUARANTINE_ORDER = ("transactions", "merchants", "users")


class LazyMap(Mapping):
    """Read-only mapping whose values are built on first access, then kept."""

    def __init__(self, factories: Mapping[str, Callable[[], DataFrame]]):
        self._factories = dict(factories)
        self._values: dict[str, DataFrame] = {}

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._values:
            self._values[key] = self._factories[key]()
        return self._values[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


class Layers:
    """Bronze -> winners -> silver / rejects / gap -> quarantine -> gold, all lazy.

    ``winners`` or ``silver`` may be given (for example stored tables re-read by
    ``publish``); everything downstream is then built from them.
    """

    def __init__(self, bronze: Mapping[str, DataFrame], as_of=None,
                 writer_groups: Iterable[str] = (), winners: Mapping[str, DataFrame] | None = None,
                 silver_tables: Mapping[str, DataFrame] | None = None):
        self.bronze = bronze
        self.as_of = as_of
        self.writer_groups = tuple(writer_groups)
        names = list(bronze)
        self.winners = winners if winners is not None else LazyMap(
            {n: (lambda n=n: keep_best(self.bronze[n], ENTITIES[n])) for n in names})
        self.silver = silver_tables if silver_tables is not None else LazyMap(
            {n: (lambda n=n: silver(self.bronze[n], ENTITIES[n], as_of, winners=self.winners[n]))
             for n in names})
        self.rejected = LazyMap(
            {n: (lambda n=n: rejected(self.bronze[n], ENTITIES[n], as_of,
                                      ranked=rank_rows(self.bronze[n], ENTITIES[n], self.winners[n])))
             for n in names})
        self.unaccounted = LazyMap(
            {n: (lambda n=n: unaccounted(self.bronze[n], ENTITIES[n], self.winners[n])) for n in names})
        self.gold = LazyMap({
            "dim_channel": lambda: G.dim_channel(self.silver["transactions"], as_of),
            "fact_transactions": lambda: G.fact_transactions(
                self.silver["transactions"], self.silver["merchants"], None, as_of),
            "dim_merchant": lambda: G.dim_merchant(self.silver["merchants"], as_of),
            "dim_user": lambda: G.dim_user(self.silver["users"], self.writer_groups, as_of),
            "dim_date": lambda: G.dim_date(self.silver["transactions"], as_of),
        })

    @cached_property
    def quarantine(self) -> DataFrame:
        return quarantine([self.rejected[n] for n in QUARANTINE_ORDER if n in self.rejected], self.as_of)


def build(bronze: Mapping[str, DataFrame], as_of=None, writer_groups: Iterable[str] = ()) -> Layers:
    return Layers(bronze, as_of, writer_groups)


def stored_tables(bronze: Mapping[str, DataFrame], stored: Mapping[str, DataFrame]) -> list[tuple[str, str, DataFrame]]:
    """The eleven tables the observability dataset counts: landed rows and published tables."""
    sources = sorted(bronze)
    gold = ("dim_channel", "dim_date", "dim_merchant", "dim_user", "fact_transactions")
    return ([("Bronze", n, bronze[n]) for n in sources] + [("Silver", SILVER_NAMES[n], stored[SILVER_NAMES[n]]) for n in sources]
            + [("Gold", n, stored[n]) for n in gold])
