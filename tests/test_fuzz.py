"""Differential fuzzing: generated dirty rows through Spark and through the SQL oracle.

Small alphabets of edge values per column (NULL, case variants, blanks, bad numbers and
dates, duplicate keys) exercise rule precedence, three-valued logic and the dedup order;
Spark's silver, rejects and gap report must equal DuckDB's on the very same rows.
"""

import duckdb
import pandas as pd
from pyspark.sql import functions as F
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from strata import oracle, vocab
from strata.operators.entities import MERCHANTS, TRANSACTIONS, USERS
from strata.operators.quarantine import parse_record, rejected, unaccounted
from strata.operators.silver import silver
from tests.helpers import multiset, stored_bronze

AS_OF = "2024-12-31"

TX_VALUES = {
    "transaction_id": ["T1", "T2", "T3", None],
    "user_id": ["U1", None],
    "merchant_id": ["M1", "M2", None],
    "channel": ["web", "APP", "Pos", "kiosk", " web", None],
    "transaction_type": ["pago", "reversa", "REVERSA", "Retiro", "cobro", None],
    "amount": ["12.50", "0.50", "0", "-5.00", "S/ 10.00", "1.2.3", "1e5", "1E-1", "5e-1", "1.5e3", "", None],
    "currency": ["PEN", "usd", "Mxn", "EUR", None],
    "transaction_date": ["2024-01-19", "19/01/2024", "2024-02-30", "2024-1-5", "not-a-date", "", None],
    "status": ["aprobado", "APROBADO", "pendiente", "rechazado", "anulado", None],
    "reference_id": ["R1", None],
}
U_VALUES = {
    "user_id": ["U1", "U2", None],
    "full_name": ["Ana", "Perez, Ana", "  ", "Bo|x", None],
    "document_id": ["12345678", "1234", "1234567a", None],
    "email": ["a@mail.pe", "no-at-sign", "x@y.z", " ", None],
    "phone": ["+51999888777", "12345", "+1234", None],
    "country": ["PE", "pe", "CO", "BR", None],
    "segment": ["premium", "Premium", "vip", "nuevo", None],
    "registration_date": ["2023-01-15", "01/02/2023", "2023-02-30", None],
}
M_VALUES = {
    "merchant_id": ["M1", "M2", None],
    "merchant_name": ["Shop", "  ", "", None],
    "category": ["retail", "Retail", "casino", None],
    "country": ["PE", "cl", "US", None],
    "affiliation_date": ["2022-01-01", "2023/01/01", "2022-13-01", None],
    "status": ["activo", "Activo", "cerrado", None],
    "risk_level": ["bajo", "Medio", "extremo", None],
}


def rows_of(values, columns):
    row = st.tuples(*[st.sampled_from(values[c]) for c in columns])
    return st.lists(row, min_size=1, max_size=40)


def spark_frame(spark, rows, columns):
    return stored_bronze(spark, spark.createDataFrame(rows, vocab.string_schema(columns)))


def duck_table(con, name, rows, columns):
    pdf = pd.DataFrame(rows, columns=list(columns), dtype="object")
    con.register(f"{name}_df", pdf)
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT {cols} FROM {name}_df")


def check(spark, entity, rows, table, silver_key, rejected_key):
    con = duckdb.connect()
    empty = {"tx_in": vocab.TRANSACTION_COLUMNS, "u_in": vocab.USER_COLUMNS, "m_in": vocab.MERCHANT_COLUMNS}
    for name, cols in empty.items():
        duck_table(con, name, rows if name == table else [], cols)
    raw = spark_frame(spark, rows, entity.columns)

    got = silver(raw, entity, AS_OF)
    res = con.execute(oracle.over_tables(silver_key))
    want_cols, want = [d[0] for d in res.description], res.fetchall()
    assert multiset(got.columns, got.collect()) == multiset(want_cols, want)

    got = parse_record(rejected(raw, entity, AS_OF), entity)
    res = con.execute(oracle.over_tables(rejected_key))
    assert multiset(got.columns, got.collect()) == multiset([d[0] for d in res.description], res.fetchall())

    gap = unaccounted(raw, entity).select("source_name", F.col(entity.key).alias("record_key"))
    res = con.execute(oracle.over_tables("unaccounted"))
    assert multiset(gap.columns, gap.collect()) == multiset([d[0] for d in res.description], res.fetchall())


# each example runs Spark jobs: generate, but do not spend minutes shrinking
SETTINGS = settings(max_examples=12, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate],
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@SETTINGS
@given(rows=rows_of(TX_VALUES, vocab.TRANSACTION_COLUMNS))
def test_transactions_match_sql(spark, rows):
    check(spark, TRANSACTIONS, rows, "tx_in", "silver_transactions", "rejected_transactions")


@SETTINGS
@given(rows=rows_of(U_VALUES, vocab.USER_COLUMNS))
def test_users_match_sql(spark, rows):
    check(spark, USERS, rows, "u_in", "silver_users", "rejected_users")


@SETTINGS
@given(rows=rows_of(M_VALUES, vocab.MERCHANT_COLUMNS))
def test_merchants_match_sql(spark, rows):
    check(spark, MERCHANTS, rows, "m_in", "silver_merchants", "rejected_merchants")
