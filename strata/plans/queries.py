"""Registered queries: one per operator of the inventory, over the driver's tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame; raw landing rows are derived
from the given tables (``strata.fixtures``), stored once as bronze, and every layer is
computed from them. Stamps are pinned to ``FIXTURE_AS_OF`` so outputs are reproducible.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import vocab
from strata.functions.codes import risk_score
from strata.functions.parse import amount_value, clean_amount, parse_date
from strata.operators import gold as G
from strata.operators import observe as O
from strata.operators.dedup import rank_rows
from strata.operators.entities import DUP, ENTITIES, MERCHANTS, TRANSACTIONS, USERS
from strata.operators.governance import apply_masks, row_filter, secure_view
from strata.operators.policies import member_rows, policy_rows
from strata.operators.quarantine import parse_record, unaccounted
from strata.plans.medallion import Layers, build, stored_tables
from strata.plans.publish import materialize, owner_tables, publish, read_lake, versions, write_policies
from strata.session import checkpoint_root
from strata.sources import testdata

AS_OF = testdata.FIXTURE_AS_OF
DATE_RANGE = ("2024-12-01", "2024-12-31")          # dashboard date-range widget
LAYER_SELECTION = ("Bronze", "Gold")               # dashboard layer multi-select
RISK_READER = ("riesgo",)
AUDIT_READER = ("auditoria",)
#: Readers of the published lake and their groups; one is in two groups, one (``guest``) in none.
READERS = (("engineer", "ingenieria"), ("analyst", "riesgo"), ("auditor", "auditoria"), ("auditor", "marketing"), ("lead", "auditoria"), ("lead", "riesgo"))

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
_PUBLISH = threading.Lock()  # one publisher when queries run concurrently


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testdata.fixture_bronzes(spark, sf_dir)


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return build(bronze(spark, sf_dir), AS_OF)


def _data(df: DataFrame, entity) -> DataFrame:
    return df.select(*entity.columns)


# ---------------------------------------------------------------- sources
def _ingested(spark, sf_dir, table, entity) -> DataFrame:
    path = testdata.fixture_ingested(spark, sf_dir, [table])[table]
    return _data(spark.read.parquet(path), entity)


@query("ingest_csv")
def q_ingest_csv(spark, sf_dir):
    return _ingested(spark, sf_dir, "transactions", TRANSACTIONS)


@query("ingest_pipe")
def q_ingest_pipe(spark, sf_dir):
    return _ingested(spark, sf_dir, "users", USERS)


@query("ingest_json")
def q_ingest_json(spark, sf_dir):
    return _ingested(spark, sf_dir, "merchants", MERCHANTS)


@query("ingest_manifest")
def q_ingest_manifest(spark, sf_dir):
    paths = testdata.fixture_ingested(spark, sf_dir)
    parts = [spark.read.parquet(paths[n]).select(F.lit(n).alias("source_name"),
                                                  F.col(ENTITIES[n].key).alias("record_key"))
             for n in ("transactions", "users", "merchants")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- silver
@query("silver_transactions")
def q_silver_transactions(spark, sf_dir):
    return layers(spark, sf_dir).silver["transactions"]


@query("silver_users")
def q_silver_users(spark, sf_dir):
    return layers(spark, sf_dir).silver["users"]


@query("silver_merchants")
def q_silver_merchants(spark, sf_dir):
    return layers(spark, sf_dir).silver["merchants"]


@query("clean_amount")
def q_clean_amount(spark, sf_dir):
    raw = bronze(spark, sf_dir)["transactions"]
    return raw.select("amount", amount_value("amount").alias("amount_value"),
                      clean_amount("amount").alias("amount_clean"))


@query("parse_dates")
def q_parse_dates(spark, sf_dir):
    raw = bronze(spark, sf_dir)["transactions"]
    return raw.select("transaction_date",
                      parse_date("transaction_date", vocab.DATE_FORMAT, vocab.ALT_DATE_FORMAT)
                      .alias("parsed_date"))


@query("expectation_metrics")
def q_expectation_metrics(spark, sf_dir):
    L = layers(spark, sf_dir)
    return O.expectation_metrics({f"{n}_silver": ENTITIES[n].judged(L.winners[n], AS_OF)
                                  for n in ("transactions", "users", "merchants")})


# ---------------------------------------------------------------- dedup / rank
def _dedup(spark, sf_dir, entity):
    return _data(layers(spark, sf_dir).winners[entity.name], entity)


@query("dedup_transactions")
def q_dedup_transactions(spark, sf_dir):
    return _dedup(spark, sf_dir, TRANSACTIONS)


@query("dedup_users")
def q_dedup_users(spark, sf_dir):
    return _dedup(spark, sf_dir, USERS)


@query("dedup_merchants")
def q_dedup_merchants(spark, sf_dir):
    return _dedup(spark, sf_dir, MERCHANTS)


def _rank(spark, sf_dir, entity):
    L = layers(spark, sf_dir)
    ranked = rank_rows(L.bronze[entity.name], entity, L.winners[entity.name])
    return ranked.select(*entity.columns, F.col(DUP).alias("is_duplicate"))


@query("rank_transactions")
def q_rank_transactions(spark, sf_dir):
    return _rank(spark, sf_dir, TRANSACTIONS)


@query("rank_users")
def q_rank_users(spark, sf_dir):
    return _rank(spark, sf_dir, USERS)


@query("rank_merchants")
def q_rank_merchants(spark, sf_dir):
    return _rank(spark, sf_dir, MERCHANTS)


# ---------------------------------------------------------------- quarantine
def _rejected(spark, sf_dir, entity):
    return parse_record(layers(spark, sf_dir).rejected[entity.name], entity)


@query("rejected_transactions")
def q_rejected_transactions(spark, sf_dir):
    return _rejected(spark, sf_dir, TRANSACTIONS)


@query("rejected_users")
def q_rejected_users(spark, sf_dir):
    return _rejected(spark, sf_dir, USERS)


@query("rejected_merchants")
def q_rejected_merchants(spark, sf_dir):
    return _rejected(spark, sf_dir, MERCHANTS)


def _quarantine_keyed(spark, sf_dir) -> DataFrame:
    q = layers(spark, sf_dir).quarantine
    key = F.coalesce(*[F.when(F.col("source_name") == n,
                              F.get_json_object("raw_record", f"$.{e.key}"))
                       for n, e in ENTITIES.items()])
    return q.select("source_name", "reject_reason", "error_column", key.alias("record_key"),
                    "_ingested_at")


@query("quarantine")
def q_quarantine(spark, sf_dir):
    return _quarantine_keyed(spark, sf_dir)


@query("reject_reason_counts")
def q_reject_reason_counts(spark, sf_dir):
    return (lake(spark, sf_dir)["quarantine"]
            .groupBy("source_name", "reject_reason", "error_column")
            .agg(F.count(F.lit(1)).alias("rejected")))


@query("unaccounted_transactions")
def q_unaccounted_transactions(spark, sf_dir):
    L = layers(spark, sf_dir)
    return unaccounted(L.bronze["transactions"], TRANSACTIONS, L.winners["transactions"])


@query("unaccounted")
def q_unaccounted(spark, sf_dir):
    L = layers(spark, sf_dir)
    parts = [unaccounted(L.bronze[n], ENTITIES[n], L.winners[n])
             .select("source_name", F.col(ENTITIES[n].key).alias("record_key"))
             for n in ("transactions", "users", "merchants")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- gold
@query("enrich_risk")
def q_enrich_risk(spark, sf_dir):
    L = layers(spark, sf_dir)
    return G.enrich_risk(L.silver["transactions"], L.silver["merchants"]).select(
        "transaction_id", "merchant_id", "risk_score")


@query("enrich_channel")
def q_enrich_channel(spark, sf_dir):
    L = layers(spark, sf_dir)
    return G.enrich_channel(L.silver["transactions"], L.gold["dim_channel"]).select(
        "transaction_id", "channel", "channel_id")


@query("merchant_risk_score")
def q_merchant_risk_score(spark, sf_dir):
    m = layers(spark, sf_dir).silver["merchants"]
    return m.select("merchant_id", "risk_level", risk_score("risk_level").alias("risk_score"))


@query("fact_transactions")
def q_fact_transactions(spark, sf_dir):
    return layers(spark, sf_dir).gold["fact_transactions"]


@query("reversal_rate")
def q_reversal_rate(spark, sf_dir):
    tx = layers(spark, sf_dir).silver["transactions"]
    return tx.groupBy("merchant_id").agg(G.reversal_rate().alias("reversal_rate"))


@query("dim_channel")
def q_dim_channel(spark, sf_dir):
    return layers(spark, sf_dir).gold["dim_channel"]


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return layers(spark, sf_dir).gold["dim_date"]


@query("dim_merchant")
def q_dim_merchant(spark, sf_dir):
    return layers(spark, sf_dir).gold["dim_merchant"]


@query("dim_user")
def q_dim_user(spark, sf_dir):
    return layers(spark, sf_dir).gold["dim_user"]


# ---------------------------------------------------------------- governance (M1-M7)
@query("mask_pii")
def q_mask_pii(spark, sf_dir):
    users = layers(spark, sf_dir).silver["users"]
    return apply_masks(users.select("user_id", "full_name", "document_id", "email", "phone"))


@query("rls_riesgo")
def q_rls_riesgo(spark, sf_dir):
    return row_filter(layers(spark, sf_dir).silver["users"], RISK_READER).select("user_id", "segment")


@query("rls_auditoria")
def q_rls_auditoria(spark, sf_dir):
    return row_filter(layers(spark, sf_dir).silver["users"], AUDIT_READER).select("user_id", "segment")


@query("secure_users")
def q_secure_users(spark, sf_dir):
    return secure_view(layers(spark, sf_dir).silver["users"], RISK_READER)


@query("secure_lake")
def q_secure_lake(spark, sf_dir):
    """What each of five readers sees of the published users: policies and memberships are rows of the lake."""
    root = lake_root(spark, sf_dir)
    seen = [read_lake(spark, root, reader)["users_silver"].select(F.lit(reader).alias("reader"), "*")
            for reader in ("engineer", "analyst", "auditor", "lead", "guest")]
    return reduce(DataFrame.unionAll, seen)


# ---------------------------------------------------------------- snapshots
def _snapshot(spark, sf_dir, name):
    root = f"{checkpoint_root(spark)}/strata-gold/{testdata._bronze_dir(spark, sf_dir).rsplit('/', 1)[-1]}"
    return materialize(layers(spark, sf_dir).gold[name], f"{root}/mv_{name}")


for _name in ("fact_transactions", "dim_merchant", "dim_user", "dim_channel", "dim_date"):
    REGISTRY[f"mv_{_name}"] = (lambda n: lambda spark, sf_dir: _snapshot(spark, sf_dir, n))(_name)


@query("run_log")
def q_run_log(spark, sf_dir):
    """A full batch publish of every layer; its run log (observed row and expectation counts)."""
    import uuid

    run_id = uuid.uuid4().hex
    root = f"{checkpoint_root(spark)}/strata-lake/{testdata._bronze_dir(spark, sf_dir).rsplit('/', 1)[-1]}"
    stored = publish(layers(spark, sf_dir), root, AS_OF, run_id=run_id)
    return stored["run_log"].filter(F.col("run_id") == run_id).drop("run_id")


# ---------------------------------------------------------------- observability
def lake(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The published tables of the fixtures; published once for each state of the input.

    Dashboard queries read these stored tables and never build a layer of their own.
    """
    return owner_tables(spark, lake_root(spark, sf_dir))


def lake_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the published fixtures, with the policies and members of ``READERS``."""
    root = f"{checkpoint_root(spark)}/strata-published/{testdata._bronze_dir(spark, sf_dir).rsplit('/', 1)[-1]}"
    with _PUBLISH:
        if not versions(spark, root):
            write_policies(policy_rows(spark), member_rows(spark, READERS), root)
            publish(layers(spark, sf_dir), root, AS_OF, snapshots=False, run_id="fixture")
    return root


def records(spark, sf_dir) -> DataFrame:
    stored, landed = lake(spark, sf_dir), bronze(spark, sf_dir)
    return O.records_by_layer(stored_tables(landed, stored))


@query("records_by_layer_table")
def q_records_by_layer_table(spark, sf_dir):
    return O.metric(records(spark, sf_dir), ("layer", "table_name"))


@query("total_processed")
def q_total_processed(spark, sf_dir):
    return O.metric(records(spark, sf_dir))


@query("records_by_layer")
def q_records_by_layer(spark, sf_dir):
    return O.metric(records(spark, sf_dir), ("layer",))


@query("records_over_time")
def q_records_over_time(spark, sf_dir):
    return O.metric(records(spark, sf_dir), ("layer", "ingested_at"))


@query("records_date_range")
def q_records_date_range(spark, sf_dir):
    lo, hi = DATE_RANGE
    where = F.col("ingested_at").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    return O.metric(records(spark, sf_dir), ("layer", "table_name"), where=where)


@query("records_layer_filter")
def q_records_layer_filter(spark, sf_dir):
    return O.metric(records(spark, sf_dir), ("layer", "table_name"),
                    where=F.col("layer").isin(*LAYER_SELECTION))


@query("filter_associativity")
def q_filter_associativity(spark, sf_dir):
    return O.filter_counts(records(spark, sf_dir), "layer", F.col("layer").isin(*LAYER_SELECTION))


@query("total_rejected")
def q_total_rejected(spark, sf_dir):
    return O.metric(lake(spark, sf_dir)["quarantine"], measures=("count",))


@query("rejected_by_source")
def q_rejected_by_source(spark, sf_dir):
    return O.metric(lake(spark, sf_dir)["quarantine"], ("source_name",), ("count",))


def _details(spark, sf_dir) -> DataFrame:
    q = lake(spark, sf_dir)["quarantine"].withColumn("processed_date", F.to_date("processed_at"))
    return O.metric(q, ("source_name", "reject_reason", "error_column", "processed_date"), ("count",))


@query("rejected_details")
def q_rejected_details(spark, sf_dir):
    return _details(spark, sf_dir)


@query("rejected_details_top20")
def q_rejected_details_top20(spark, sf_dir):
    return O.top_n(_details(spark, sf_dir), 20,
                   [F.col("count").desc(), "source_name", "reject_reason", "error_column"])


@query("event_log_rollup")
def q_event_log_rollup(spark, sf_dir):
    return O.rollup_count(testdata.read_table(spark, sf_dir, "events"), ("event_type",))


@query("event_log_dataset")
def q_event_log_dataset(spark, sf_dir):
    """Ten dimensions and count over the event log of a whole job: ingest of the landing files, then a publish."""
    from strata.plans.events import DIMENSIONS, event_dimensions, read_events
    from strata.plans.job import EVENT_LOG

    return O.rollup_count(event_dimensions(read_events(spark, f"{testdata.fixture_job(spark, sf_dir)}/{EVENT_LOG}")), DIMENSIONS)


# ---------------------------------------------------------------- event-time windows
@query("fact_daily_window")
def q_fact_daily_window(spark, sf_dir):
    """The fact by one-day event-time windows, as the bounded stream groups it; rows without a date, in no window, are a group."""
    from strata.streaming.fact import daily_fact

    L = layers(spark, sf_dir)
    tx, merchants = L.silver["transactions"], L.silver["merchants"]
    return daily_fact(tx, merchants, lateness="1 day").unionByName(daily_fact(tx.where("transaction_date is null"), merchants))


@query("fact_closed_repaired")
def q_fact_closed_repaired(spark, sf_dir):
    """Days closed by a watermarked stream, corrected for what came late, and the days still open."""
    from strata.streaming.repair import read_repaired_fact

    root, stored = testdata.fixture_closed_days(spark, sf_dir, lake(spark, sf_dir)), lake(spark, sf_dir)
    return read_repaired_fact(spark, root, stored["transactions_silver"], stored["merchants_silver"])


# ---------------------------------------------------------------- incremental tables
def _silver_incremental(spark, sf_dir, name) -> DataFrame:
    from strata.streaming.incremental import read_silver

    return read_silver(spark, testdata.fixture_incremental(spark, sf_dir, [name])[name])


@query("silver_incremental")
def q_silver_incremental(spark, sf_dir):
    return _silver_incremental(spark, sf_dir, "transactions")


@query("silver_incremental_users")
def q_silver_incremental_users(spark, sf_dir):
    return _silver_incremental(spark, sf_dir, "users")


@query("silver_incremental_merchants")
def q_silver_incremental_merchants(spark, sf_dir):
    return _silver_incremental(spark, sf_dir, "merchants")


@query("fact_retracting")
def q_fact_retracting(spark, sf_dir):
    from strata.streaming.incremental import read_fact

    roots = testdata.fixture_incremental(spark, sf_dir, ["transactions", "merchants"])
    return read_fact(spark, roots["transactions"], _silver_incremental(spark, sf_dir, "merchants"), AS_OF)


@query("quarantine_incremental")
def q_quarantine_incremental(spark, sf_dir):
    from strata.streaming.incremental import read_quarantine

    roots = testdata.fixture_incremental(spark, sf_dir)
    parts = [read_quarantine(spark, roots[n]).select("source_name", "reject_reason", "error_column",
                                                           F.get_json_object("raw_record", f"$.{e.key}").alias("record_key"), "_ingested_at")
             for n, e in ENTITIES.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("unaccounted_incremental")
def q_unaccounted_incremental(spark, sf_dir):
    from strata.streaming.incremental import read_unaccounted

    roots = testdata.fixture_incremental(spark, sf_dir)
    parts = [read_unaccounted(spark, roots[n]).select(F.lit(n).alias("source_name"), F.col(e.key).alias("record_key"))
             for n, e in ENTITIES.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
