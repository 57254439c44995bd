"""Edge rows written inline: parsing, three-valued rules, ties, masks, row filters."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata import vocab
from strata.functions.masks import register_sql_functions
from strata.functions.parse import amount_value, clean_amount, parse_date
from strata.operators.dedup import keep_best, rank_rows
from strata.operators.entities import DUP, MERCHANTS, TRANSACTIONS, USERS
from strata.operators.governance import secure_view
from strata.operators.quarantine import rejected, unaccounted
from strata.operators.silver import silver
from tests.helpers import stored_bronze


def frame(spark, rows, columns):
    df = spark.createDataFrame([tuple(r) for r in rows], vocab.string_schema(columns))
    return stored_bronze(spark, df)


def tx(**kw):
    base = dict(transaction_id="T1", user_id="U1", merchant_id="M1", channel="web",
                transaction_type="pago", amount="10.00", currency="PEN",
                transaction_date="2024-01-19", status="aprobado", reference_id=None)
    base.update(kw)
    return tuple(base[c] for c in vocab.TRANSACTION_COLUMNS)


def test_amounts(spark):
    vals = ["12.50", "0.50", "-5", "$100", "1.2.3", "", "S/ 10.00", "99999999999999999999.99", None]
    df = spark.createDataFrame([(v,) for v in vals], "amount string")
    out = {r["amount"]: (r["v"], r["c"]) for r in
           df.select("amount", amount_value("amount").alias("v"), clean_amount("amount").alias("c")).collect()}
    assert out["12.50"] == (Decimal("12.50"), Decimal("12.50"))
    assert out["0.50"] == (Decimal("0.50"), Decimal("0.50"))       # not truncated to 0
    assert out["-5"] == (Decimal("-5.00"), Decimal("-5.00"))       # the value that is tested is stored
    assert out["$100"] == (None, Decimal("100.00"))
    assert out["1.2.3"] == (None, None)                            # no ANSI error
    assert out[""] == (None, None)
    assert out["S/ 10.00"] == (None, Decimal("10.00"))
    assert out["99999999999999999999.99"] == (None, None)          # overflow -> NULL
    assert out[None] == (None, None)


def test_dates(spark):
    vals = ["2024-01-19", "19/01/2024", "2024-13-01", "2024-02-30", "", "not-a-date", None]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    out = {r["d"]: r["p"] for r in df.select(
        "d", parse_date("d", vocab.DATE_FORMAT, vocab.ALT_DATE_FORMAT).alias("p")).collect()}
    assert out["2024-01-19"] == dt.date(2024, 1, 19)
    assert out["19/01/2024"] == dt.date(2024, 1, 19)
    assert out["2024-13-01"] is None and out["2024-02-30"] is None
    assert out[""] is None and out["not-a-date"] is None and out[None] is None


def test_null_predicates_land_in_neither_path(spark):
    rows = [tx(transaction_id="T1", channel=None),            # NULL channel: neither
            tx(transaction_id="T2", amount="S/ 10.00"),       # non-numeric amount: neither
            tx(transaction_id="T3"),                          # valid
            tx(transaction_id="T4", channel="kiosk")]         # rejected
    raw = frame(spark, rows, vocab.TRANSACTION_COLUMNS)
    assert {r.transaction_id for r in silver(raw, TRANSACTIONS).collect()} == {"T3"}
    rej = rejected(raw, TRANSACTIONS).collect()
    assert [(r.reject_reason, r.error_column) for r in rej] == [(vocab.TX_CHANNEL, "channel")]
    assert {r.transaction_id for r in unaccounted(raw, TRANSACTIONS).collect()} == {"T1", "T2"}


def test_reversal_rules_are_raw_case(spark):
    rows = [tx(transaction_id="T1", transaction_type="REVERSA"),               # passes, ref NULL
            tx(transaction_id="T2", transaction_type="reversa"),               # rejected
            tx(transaction_id="T3", transaction_type="pago", reference_id="X")]  # ref -> none
    raw = frame(spark, rows, vocab.TRANSACTION_COLUMNS)
    out = {r.transaction_id: r for r in silver(raw, TRANSACTIONS).collect()}
    assert out["T1"].transaction_type == "reversa" and out["T1"].reference_id is None
    assert out["T3"].reference_id == "none"
    assert [r.reject_reason for r in rejected(raw, TRANSACTIONS).collect()] == [vocab.TX_REFERENCE_MISSING]


def test_first_match_precedence(spark):
    rows = [tx(transaction_id=None, user_id=None, channel="kiosk"),
            tx(transaction_id="T9", user_id=None, channel="kiosk", status="x")]
    raw = frame(spark, rows, vocab.TRANSACTION_COLUMNS)
    got = sorted((r.reject_reason, r.error_column) for r in rejected(raw, TRANSACTIONS).collect())
    assert got == sorted([(vocab.TX_ID_NULL, "transaction_id"), (vocab.TX_USER_NULL, "user_id")])


def test_dedup_priority_then_date_and_exact_copies(spark):
    rows = [tx(status="rechazado", transaction_date="2024-12-31"),
            tx(status="aprobado", transaction_date="2024-01-01"),   # wins on priority
            tx(status="APROBADO", transaction_date="2025-01-01"),   # raw case: priority 1
            tx(transaction_id="T2"), tx(transaction_id="T2"), tx(transaction_id="T2")]  # exact copies
    raw = frame(spark, rows, vocab.TRANSACTION_COLUMNS)
    best = {r.transaction_id: r for r in keep_best(raw, TRANSACTIONS).collect()}
    assert best["T1"].status == "aprobado" and best["T1"].transaction_date == "2024-01-01"
    ranked = rank_rows(raw, TRANSACTIONS)
    counts = {(r.transaction_id, r[DUP]): r["n"] for r in
              ranked.groupBy("transaction_id", DUP).agg(F.count("*").alias("n")).collect()}
    assert counts == {("T1", False): 1, ("T1", True): 2, ("T2", False): 1, ("T2", True): 2}


def test_hot_key_and_null_keys(spark):
    """A key holding most rows, plus NULL keys: one winner, all others flagged."""
    rows = [tx(amount=f"{i}.00", transaction_date=f"2024-01-{1 + i % 28:02d}") for i in range(1, 3001)]
    rows += [tx(transaction_id=None, amount=f"{i}.00") for i in range(500)]
    rows += [tx(transaction_id=f"K{i}") for i in range(200)]
    raw = frame(spark, rows, vocab.TRANSACTION_COLUMNS).repartition(16)
    ranked = rank_rows(raw, TRANSACTIONS)
    counts = {r[DUP]: r["n"] for r in ranked.groupBy(DUP).agg(F.count("*").alias("n")).collect()}
    assert counts == {False: 201, True: 2999, None: 500}
    assert "Window" not in ranked._jdf.queryExecution().executedPlan().toString()


def test_users_and_merchants_rules(spark):
    users = frame(spark, [
        ("U1", "Ana", "12345678", "a@x.pe", "+51999888777", "PE", "premium", "2023-01-15"),
        ("U2", "Perez, Ana", "1", "a@x.pe", "+51999888777", "CO", "nuevo", "2023-01-15"),
        ("U3", "Bo", None, "a@x.pe", "+51999888777", "PE", "nuevo", "2023-01-15"),   # gap
        ("U4", "Cy", "1234", "a@x.pe", "+51999888777", "pe", "nuevo", "2023-01-15"),  # lower pe escapes
    ], vocab.USER_COLUMNS)
    assert {r.user_id for r in silver(users, USERS).collect()} == {"U1", "U4"}
    assert [r.reject_reason for r in rejected(users, USERS).collect()] == [vocab.U_NAME]
    assert [r.user_id for r in unaccounted(users, USERS).collect()] == ["U3"]
    merchants = frame(spark, [
        ("M1", "Shop", None, "PE", "2022-01-01", None, None),        # risk NULL allowed w/o category
        ("M2", "Shop", "retail", "PE", "2022-01-01", "activo", None),  # risk NULL with category
        ("M3", "Shop", None, "PE", "2022-01-01", None, "extremo"),    # gap
        ("M4", "  ", "retail", "PE", "2022-01-01", "activo", "bajo"),
    ], vocab.MERCHANT_COLUMNS)
    assert {r.merchant_id for r in silver(merchants, MERCHANTS).collect()} == {"M1"}
    got = sorted(r.reject_reason for r in rejected(merchants, MERCHANTS).collect())
    assert got == sorted([vocab.M_RISK_NULL, vocab.M_NAME])
    assert [r.merchant_id for r in unaccounted(merchants, MERCHANTS).collect()] == ["M3"]


def test_masks_and_row_filter(spark):
    users = spark.createDataFrame([
        ("U1", "Ana", "12345678", "ana@mail.pe", "+51999888777", "PE", "premium"),
        ("U2", "Bo", "123", "no-at-sign", "123", "PE", "estandar"),
        ("U3", None, None, None, None, "PE", None),
        ("U4", "Di", "9", "d@x.io", "+1555", "PE", "nuevo"),
    ], "user_id string, full_name string, document_id string, email string, phone string, "
       "country string, segment string")
    masked = {r.user_id: r for r in secure_view(users, ()).collect()}
    assert masked == {}                                   # no group: nothing visible
    risk = {r.user_id: r for r in secure_view(users, ("riesgo",)).collect()}
    assert set(risk) == {"U1", "U2"}
    assert risk["U1"].full_name == "***MASKED***"
    assert risk["U1"].document_id == "****5678"
    assert risk["U1"].email == "a*****@mail.pe"
    assert risk["U1"].phone == "+519*******777"
    assert risk["U2"].document_id == "****123"
    assert risk["U2"].email == "n*****no-at-sign"        # no '@': value leaks after the mask
    assert {r.user_id for r in secure_view(users, ("auditoria",)).collect()} == {"U1"}
    eng = {r.user_id: r for r in secure_view(users, ("ingenieria", "auditoria")).collect()}
    assert set(eng) == {"U1", "U2", "U3", "U4"} and eng["U1"].full_name == "Ana"
    register_sql_functions(spark, ("riesgo",))
    users.createOrReplaceTempView("users_edge")
    sql = spark.sql("SELECT user_id, mask_email(email) AS e FROM users_edge WHERE users_rls(segment)")
    assert {r.user_id: r.e for r in sql.collect()} == {"U1": "a*****@mail.pe", "U2": "n*****no-at-sign"}


def test_salted_fact_join_equals_plain(spark):
    """Salting the merchant join (no-AQE fallback) changes nothing but the task split."""
    from strata.operators import gold as G
    from strata.plans.medallion import build
    from strata.plans.queries import AS_OF
    from strata.sources.testdata import fixture_bronzes
    from tests.conftest import SF_SMALL
    from tests.helpers import multiset

    L = build(fixture_bronzes(spark, SF_SMALL), AS_OF)
    tx, m = L.silver["transactions"], L.silver["merchants"]
    plain = G.fact_transactions(tx, m, None, AS_OF)
    salted = G.fact_transactions(tx, m, None, AS_OF, salts=8)
    assert multiset(plain.columns, plain.collect()) == multiset(salted.columns, salted.collect())


def test_enrich_channel_keeps_every_dimension_row(spark):
    from strata.operators.gold import enrich_channel

    tx_rows = spark.createDataFrame([("T1", "kiosk"), ("T2", "web"), ("T3", "none")], "transaction_id string, channel string")
    dim = spark.createDataFrame([(99, "kiosk"), (1, "web")], "channel_id int, des_channel string")
    assert {(r.transaction_id, r.channel_id) for r in enrich_channel(tx_rows, dim).collect()} == {("T1", 99), ("T2", 1), ("T3", None)}


def test_stored_amount_is_the_tested_value(spark):
    amounts = ["1e5", "1E-1", "5e-1", "1.5e3", "12.50", "$100"]
    raw = frame(spark, [tx(transaction_id=f"T{i}", amount=a) for i, a in enumerate(amounts)], vocab.TRANSACTION_COLUMNS)
    got = {r.transaction_id: str(r.amount) for r in silver(raw, TRANSACTIONS).collect()}
    assert got == {"T0": "100000.00", "T1": "0.10", "T2": "0.50", "T3": "1500.00", "T4": "12.50"}
