"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (full execution, nothing
collected to the driver). Bronze fixtures are written once first and timed apart.
vs. two passes, fact join placement).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.operators import gold as G  # noqa: E402
from strata.operators.dedup import keep_best, rank_rows  # noqa: E402
from strata.operators.entities import TRANSACTIONS  # noqa: E402
from strata.operators.quarantine import rejected  # noqa: E402
from strata.operators.silver import silver  # noqa: E402
from strata.plans.queries import REGISTRY, lake, layers  # noqa: E402
from strata.session import checkpoint_root, get_spark  # noqa: E402
from strata.sources import testdata  # noqa: E402

HEADLINE = (
    "silver_transactions", "silver_users", "silver_merchants", "quarantine",
    "fact_transactions", "dim_channel", "dim_date", "dim_user", "secure_users",
    "expectation_metrics", "rejected_details", "records_by_layer_table", "fact_daily_window",
)


def run(df: DataFrame) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def whole(make) -> float:
    """Seconds of building a frame, whatever that runs, and of running it."""
    t0 = time.perf_counter()
    run(make())
    return time.perf_counter() - t0


def best_of(make, n=2) -> float:
    return min(run(make()) for _ in range(n))


def dedup_variants(raw: DataFrame) -> dict[str, DataFrame]:
    e = TRANSACTIONS
    cols = [c for c in e.columns if c != e.key]
    order = F.struct(e.priority().alias("p"), F.col(e.date), *[F.col(c) for c in cols])
    per_column = raw.filter(F.col(e.key).isNotNull()).groupBy(e.key).agg(*[F.max_by(c, order).alias(c) for c in cols])
    w = Window.partitionBy(e.key).orderBy(e.priority().desc(), F.col(e.date).desc_nulls_last(),
                                          *[F.col(c).desc_nulls_last() for c in cols])
    row_number = (raw.filter(F.col(e.key).isNotNull())
                     .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn"))
    return {"dedup_struct_max": keep_best(raw, e), "dedup_max_by_per_column": per_column,
            "dedup_row_number": row_number}


def skewed(raw: DataFrame, hot) -> DataFrame:
    """A third of the rows (by part key of the source line) moved onto one key value."""
    hot_row = F.pmod(F.xxhash64(*[c for c in TRANSACTIONS.columns]), F.lit(3)) == 0
    return raw.withColumn("transaction_id", F.when(hot_row, F.lit(hot)).otherwise(F.col("transaction_id")))


def window_rank(raw: DataFrame) -> DataFrame:
    e = TRANSACTIONS
    w = Window.partitionBy(e.key).orderBy(
        e.priority().desc(), *[F.col(c).desc_nulls_last() for c in (e.date, *(c for c in raw.columns if c not in (e.key, e.date)))])
    return raw.withColumn("_rn", F.row_number().over(w)).withColumn("_dup", F.col("_rn") > 1)


def task_skew(log_dir: str) -> dict[str, dict[str, float]]:
    """Per job group: the stage with the worst max/median task time, from the event log."""
    stage_group, tasks = {}, {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append(
                        (info["Finish Time"] - info["Launch Time"]) / 1000.0)
    out: dict[str, dict[str, float]] = {}
    for sid, durations in tasks.items():
        group = stage_group.get(sid)
        if not group or len(durations) < 2:
            continue
        mx, med = max(durations), statistics.median(durations)
        ratio = mx / med if med > 0 else float("inf")
        if group not in out or ratio > out[group]["max_over_median"]:
            out[group] = {"max_task_s": round(mx, 3), "median_task_s": round(med, 3),
                          "max_over_median": round(ratio, 1), "tasks": len(durations)}
    return out


def stored_winners(spark, raw):
    """The dedup winners written to the shared folder and reread, as a publish does."""
    path = f"{checkpoint_root(spark)}/bench/{uuid.uuid4().hex}"
    keep_best(raw, TRANSACTIONS).write.parquet(path)
    return spark.read.parquet(path)


def silver_and_rejected(raw, winners):
    """Every column of silver and of the rejects as one frame, so that nothing is pruned."""
    good = silver(raw, TRANSACTIONS, winners=winners)
    bad = rejected(raw, TRANSACTIONS, ranked=rank_rows(raw, TRANSACTIONS, winners))
    return good.select(F.to_json(F.struct("*")).alias("row")).unionByName(bad.select(F.to_json(F.struct("*")).alias("row")))


def fact_by_rows(tx, merchants):
    """The rival plan with the same output: merchant risk joined to every row, then one aggregate."""
    rows = G.with_channel_id(tx).join(G.merchant_risk(merchants), "merchant_id", "left").fillna(0, ["risk_score"])
    return rows.groupBy(*G.FACT_KEYS).agg(
        F.sum("amount").alias("total_amount"), F.count("*").alias("transaction_count"),
        G.reversal_rate().alias("reversal_rate"), F.mean("risk_score").alias("avg_risk_score"),
        F.max(F.current_date()).alias("_ingested_at"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    log_dir = os.environ.get("BENCH_EVENT_LOG") or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = get_spark(master=f"local[{cpus}]", spark__eventLog__enabled="true",
                      spark__eventLog__dir=log_dir, spark__eventLog__compress="false",
                      spark__eventLog__rolling__enabled="false")

    t0 = time.perf_counter()
    bronze = testdata.fixture_bronzes(spark, sf_dir)
    for name in bronze:
        bronze[name]  # written on first access
    bronze_secs = time.perf_counter() - t0

    run(REGISTRY["silver_users"](spark, sf_dir))  # JVM warm-up, untimed
    t0 = time.perf_counter()
    lake(spark, sf_dir)  # dashboards read this; its cost is a figure of its own
    publish_secs = time.perf_counter() - t0

    times = {}
    for name in HEADLINE:
        times[name] = round(best_of(lambda n=name: REGISTRY[n](spark, sf_dir)), 3)

    variants = {"bronze_fixture_write": round(bronze_secs, 3), "publish_all_layers": round(publish_secs, 3)}
    raw = bronze["transactions"]
    for name, df in dedup_variants(raw).items():
        variants[name] = round(best_of(lambda d=df: d), 3)
    L = layers(spark, sf_dir)
    winners = L.winners["transactions"]
    # both results in full, the dedup done once (stored winners) or in each
    def shared():
        return silver_and_rejected(raw, stored_winners(spark, raw))

    variants["silver_plus_quarantine_shared_dedup"] = round(min(whole(shared) for _ in range(2)), 3)
    variants["silver_plus_quarantine_own_dedup"] = round(best_of(lambda: silver_and_rejected(raw, None)), 3)
    tx, m = L.silver["transactions"], L.silver["merchants"]
    variants["fact_aggregate_then_join"] = round(best_of(lambda: G.fact_transactions(tx, m)), 3)
    variants["fact_join_then_aggregate"] = round(best_of(lambda: fact_by_rows(tx, m)), 3)
    # the ingest itself runs while the frame is built
    variants["ingest_manifest_with_ingest"] = round(whole(lambda: REGISTRY["ingest_manifest"](spark, sf_dir)), 3)

    sc = spark.sparkContext
    for label, hot in (("hot_key", "T_HOT"), ("null_key", None)):
        data = skewed(raw, hot)
        for name, df in ((f"{label}_rank_rows", rank_rows(data, TRANSACTIONS)),
                         (f"{label}_row_number_window", window_rank(data))):
            sc.setJobGroup(name, name)
            variants[name] = round(best_of(lambda d=df: d), 3)
    sc.setJobGroup("other", "other")

    total = round(sum(times.values()), 3)
    spark.stop()  # flushes the event log
    skew = {k: v for k, v in task_skew(log_dir).items() if k.startswith(("hot_key", "null_key"))}
    print(json.dumps({"metric": "headline_total_wall", "value": total, "unit": "sec",
                      "queries": times, "variants": variants, "task_skew": skew,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
