"""Dirty raw fixtures derived from the driver's TPC-H-like tables by plain SQL.

The same text runs unchanged in Spark and in DuckDB, so the Spark operators and the
independent SQL oracle start from identical raw rows. The tables they read
(lineitem, orders, customer, supplier) must be registered as views first.
"""

from __future__ import annotations

TRANSACTIONS_RAW_SQL = """
SELECT
  CASE WHEN l_partkey % 37 = 0 THEN NULL
       ELSE 'T' || CAST(l_orderkey * 10 + l_linenumber AS STRING) END              AS transaction_id,
  CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE 'U' || CAST(o_custkey % 10 AS STRING) END AS user_id,
  CASE WHEN l_partkey % 43 = 0 THEN NULL
       WHEN l_partkey % 29 = 0 THEN 'M_UNKNOWN'
       ELSE 'M' || CAST(l_suppkey AS STRING) END                                   AS merchant_id,
  CASE WHEN l_partkey % 47 = 0 THEN 'kiosk' WHEN l_partkey % 49 = 0 THEN NULL
       WHEN l_linenumber % 4 = 0 THEN 'web' WHEN l_linenumber % 4 = 1 THEN 'APP'
       WHEN l_linenumber % 4 = 2 THEN 'pos' ELSE 'Web' END                         AS channel,
  CASE WHEN l_partkey % 53 = 0 THEN 'cobro' WHEN l_partkey % 55 = 0 THEN 'REVERSA'
       WHEN l_returnflag = 'R' THEN 'reversa' WHEN l_returnflag = 'A' THEN 'pago'
       ELSE 'Retiro' END                                                           AS transaction_type,
  CASE WHEN l_partkey % 59 = 0 THEN NULL   WHEN l_partkey % 61 = 0 THEN '-5.00'
       WHEN l_partkey % 63 = 0 THEN '0.50' WHEN l_partkey % 65 = 0 THEN 'S/ 10.00'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END             AS amount,
  CASE WHEN l_partkey % 67 = 0 THEN 'EUR'
       WHEN l_suppkey % 6 = 0 THEN 'PEN' WHEN l_suppkey % 6 = 1 THEN 'usd'
       WHEN l_suppkey % 6 = 2 THEN 'COP' WHEN l_suppkey % 6 = 3 THEN 'Mxn'
       WHEN l_suppkey % 6 = 4 THEN 'CLP' ELSE 'ARS' END                            AS currency,
  CASE WHEN l_partkey % 71 = 0 THEN NULL WHEN l_partkey % 73 = 0 THEN 'not-a-date'
       WHEN l_suppkey % 2 = 0 THEN ds
       ELSE substring(ds, 9, 2) || '/' || substring(ds, 6, 2) || '/' || substring(ds, 1, 4)
  END                                                                              AS transaction_date,
  CASE WHEN l_partkey % 79 = 0 THEN 'anulado' WHEN l_partkey % 83 = 0 THEN 'APROBADO'
       WHEN l_tax < 0.03 THEN 'aprobado' WHEN l_tax < 0.06 THEN 'pendiente'
       ELSE 'rechazado' END                                                        AS status,
  CASE WHEN l_returnflag = 'R' AND l_partkey % 7 <> 0
       THEN 'T' || CAST(l_orderkey * 10 AS STRING) END                             AS reference_id
FROM (SELECT *, '2024-' || lpad(CAST(1 + l_partkey % 12 AS STRING), 2, '0')
                || '-' || CAST(19 + l_partkey % 12 AS STRING) AS ds
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) j
"""

USERS_RAW_SQL = """
SELECT
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 'U' || CAST(c_custkey AS STRING) END AS user_id,
  CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN 'Perez, Ana'
       ELSE 'Name ' || CAST(c_custkey AS STRING) END                               AS full_name,
  CASE WHEN copy = 2 OR c_custkey % 43 = 0 THEN NULL
       WHEN c_custkey % 19 = 0 THEN '1234'
       ELSE lpad(CAST(c_custkey AS STRING), 8, '0') END                            AS document_id,
  CASE WHEN c_custkey % 47 = 0 THEN NULL WHEN c_custkey % 53 = 0 THEN 'no-at-sign'
       ELSE 'u' || CAST(c_custkey AS STRING) || '@mail.example' END                AS email,
  CASE WHEN c_custkey % 59 = 0 THEN '12345'
       ELSE '+519' || lpad(CAST(c_custkey AS STRING), 8, '0') END                  AS phone,
  CASE WHEN c_custkey % 61 = 0 THEN 'BR' WHEN c_custkey % 23 = 0 THEN NULL
       WHEN c_nationkey % 5 = 0 THEN 'PE' WHEN c_nationkey % 5 = 1 THEN 'co'
       WHEN c_nationkey % 5 = 2 THEN 'MX' WHEN c_nationkey % 5 = 3 THEN 'pe'
       ELSE 'AR' END                                                               AS country,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Premium' WHEN c_mktsegment = 'BUILDING' THEN 'estandar'
       WHEN c_mktsegment = 'MACHINERY' THEN NULL
       WHEN c_custkey % 67 = 0 THEN 'vip' ELSE 'nuevo' END                         AS segment,
  CASE WHEN c_custkey % 71 = 0 THEN '01/02/2023'
       ELSE '2023-0' || CAST(1 + (c_custkey + copy) % 9 AS STRING) || '-15' END    AS registration_date
FROM {customer_copies}
WHERE copy = 1 OR c_custkey % 10 = 0
"""

MERCHANTS_RAW_SQL = """
SELECT
  CASE WHEN s_suppkey % 31 = 30 THEN NULL ELSE 'M' || CAST(s_suppkey AS STRING) END AS merchant_id,
  CASE WHEN copy = 2 THEN '  ' WHEN s_suppkey % 23 = 22 THEN NULL ELSE s_name END  AS merchant_name,
  CASE WHEN s_suppkey % 19 = 18 THEN 'casino' WHEN s_suppkey % 13 = 12 THEN NULL
       WHEN s_suppkey % 3 = 0 THEN 'Retail' WHEN s_suppkey % 3 = 1 THEN 'salud'
       ELSE 'moda' END                                                             AS category,
  CASE WHEN s_suppkey % 17 = 16 THEN 'US' WHEN s_nationkey % 2 = 0 THEN 'pe'
       ELSE 'CL' END                                                               AS country,
  CASE WHEN s_suppkey % 11 = 10 THEN '2023/01/01'
       ELSE '2022-0' || CAST(1 + (s_suppkey + copy) % 9 AS STRING) || '-01' END    AS affiliation_date,
  CASE WHEN s_suppkey % 29 = 28 THEN 'cerrado' WHEN s_suppkey % 7 = 6 THEN NULL
       WHEN s_suppkey % 2 = 0 THEN 'Activo' ELSE 'suspendido' END                  AS status,
  CASE WHEN s_suppkey % 13 = 12 AND s_suppkey % 2 = 0 THEN 'extremo'
       WHEN s_suppkey % 13 = 12 THEN NULL
       WHEN s_suppkey % 37 = 36 THEN 'extremo' WHEN s_suppkey % 27 = 26 THEN NULL
       WHEN s_suppkey % 3 = 0 THEN 'bajo' WHEN s_suppkey % 3 = 1 THEN 'Medio'
       ELSE 'alto' END                                                             AS risk_level
FROM {supplier_copies}
WHERE copy = 1 OR s_suppkey % 5 = 0
"""

# Users and merchants carry a second copy of some rows. Spark makes the copies with
# a generator (no join); DuckDB uses the equivalent two-row cross product.
_SPARK_COPIES = "{t} LATERAL VIEW explode(array(1, 2)) c AS copy"
_DUCKDB_COPIES = "{t} CROSS JOIN (SELECT 1 AS copy UNION ALL SELECT 2 AS copy) c"


def raw_sql(name: str, engine: str = "spark") -> str:
    """Fixture SQL for one raw source, in the dialect of ``engine`` (spark|duckdb)."""
    copies = _SPARK_COPIES if engine == "spark" else _DUCKDB_COPIES
    text = {"transactions": TRANSACTIONS_RAW_SQL, "users": USERS_RAW_SQL,
            "merchants": MERCHANTS_RAW_SQL}[name]
    return text.replace("{customer_copies}", copies.format(t="customer")).replace(
        "{supplier_copies}", copies.format(t="supplier"))

# base tables each fixture reads
RAW_INPUTS = {
    "transactions": ("lineitem", "orders"),
    "users": ("customer",),
    "merchants": ("supplier",),
}
