r"""Independent SQL oracle (DuckDB dialect) for every registered query.

Written directly from the rule tables with window ``row_number`` dedup, so it shares
no code path with the Spark operators (which use an aggregate + anti join). Only the
fixture SQL and the fixed vocabularies are common.
"""

from __future__ import annotations

from strata import fixtures

AS_OF = "DATE '2024-12-31'"


def _iso(c: str) -> str:
    return (f"CAST(CASE WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') "
            f"THEN try_strptime({c}, '%Y-%m-%d') END AS DATE)")


def _dmy(c: str) -> str:
    return (f"CAST(CASE WHEN regexp_matches({c}, '^[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}$') "
            f"THEN try_strptime({c}, '%d/%m/%Y') END AS DATE)")


def _loaded(key: str) -> str:
    """Load date of a fixture row: 0, 20 or 40 days before the pinned date, by its key's last sign."""
    return f"{AS_OF} - CAST(20 * coalesce(ascii(right({key}, 1)) % 3, 0) AS INTEGER)"


EMAIL = r"'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'"
PHONE = r"'^\+[0-9]{1,3}[0-9]{6,}$'"
CHANNELS = "('web', 'app', 'pos')"
TYPES = "('pago', 'reversa', 'retiro')"
CURRENCIES = "('PEN', 'USD', 'COP', 'MXN', 'CLP', 'ARS')"
TX_STATUSES = "('aprobado', 'rechazado', 'pendiente')"
CATEGORIES = ("('retail', 'restaurante', 'farmacia', 'supermercado', 'tecnologia', "
              "'transporte', 'educacion', 'salud', 'entretenimiento', 'moda')")
COUNTRIES = "('PE', 'CO', 'MX', 'CL', 'AR')"
M_STATUSES = "('activo', 'inactivo', 'suspendido')"
RISKS = "('bajo', 'medio', 'alto')"
SEGMENTS = "('premium', 'estandar', 'nuevo')"

TX_COLS = "transaction_id, user_id, merchant_id, channel, transaction_type, amount, currency, transaction_date, status, reference_id"
U_COLS = "user_id, full_name, document_id, email, phone, country, segment, registration_date"
M_COLS = "merchant_id, merchant_name, category, country, affiliation_date, status, risk_level"

TX_VALID = f"""(transaction_id IS NOT NULL AND user_id IS NOT NULL AND merchant_id IS NOT NULL
  AND amount IS NOT NULL AND try_cast(amount AS DECIMAL(18,2)) > 0
  AND transaction_date IS NOT NULL
  AND NOT (transaction_type = 'reversa' AND reference_id IS NULL)
  AND lower(channel) IN {CHANNELS} AND lower(transaction_type) IN {TYPES}
  AND upper(currency) IN {CURRENCIES} AND lower(status) IN {TX_STATUSES})"""

#: Numbered rules of each source as (column, condition, message); the lowest number that holds wins.
TX_RULES = [
    ("transaction_id", "transaction_id IS NULL", "transaction_id nulo crítico"),
    ("transaction_id", "rn > 1", "transaction_id duplicado"),
    ("user_id", "user_id IS NULL", "user_id nulo crítico"),
    ("merchant_id", "merchant_id IS NULL", "merchant_id nulo crítico"),
    ("amount", "amount IS NULL", "amount nulo crítico"),
    ("amount", "try_cast(amount AS DECIMAL(18,2)) <= 0", "amount inválido (no positivo)"),
    ("transaction_date", "transaction_date IS NULL", "transaction_date nulo crítico"),
    ("reference_id", "transaction_type = 'reversa' AND reference_id IS NULL", "reference_id faltante en reversa"),
    ("channel", f"lower(channel) NOT IN {CHANNELS}", "channel formato incorrecto"),
    ("transaction_type", f"lower(transaction_type) NOT IN {TYPES}", "transaction_type inválido"),
    ("currency", f"upper(currency) NOT IN {CURRENCIES}", "currency inválido"),
    ("status", f"lower(status) NOT IN {TX_STATUSES}", "status inválido"),
]

U_VALID = f"""(user_id IS NOT NULL AND full_name IS NOT NULL AND trim(full_name) <> ''
  AND NOT regexp_matches(full_name, '[,;|]')
  AND ((country = 'PE' AND regexp_matches(document_id, '^[0-9]{{8}}$')) OR country <> 'PE' OR country IS NULL)
  AND email IS NOT NULL AND trim(email) <> '' AND regexp_matches(email, {EMAIL})
  AND phone IS NOT NULL AND regexp_matches(phone, {PHONE})
  AND (upper(country) IN {COUNTRIES} OR country IS NULL)
  AND (lower(segment) IN {SEGMENTS} OR segment IS NULL)
  AND {_iso('registration_date')} IS NOT NULL)"""

U_RULES = [
    ("user_id", "user_id IS NULL", "user_id nulo crítico"),
    ("user_id", "rn > 1", "user_id duplicado"),
    ("full_name", "coalesce(trim(full_name), '') = '' OR regexp_matches(full_name, '[,;|]')", "full_name inválido"),
    ("document_id", "country = 'PE' AND NOT regexp_matches(document_id, '^[0-9]{8}$')", "document_id inválido para PE"),
    ("email", f"coalesce(trim(email), '') = '' OR NOT regexp_matches(email, {EMAIL})", "email inválido"),
    ("phone", f"phone IS NULL OR NOT regexp_matches(phone, {PHONE})", "phone inválido"),
    ("country", f"upper(country) NOT IN {COUNTRIES}", "country inválido"),
    ("segment", f"lower(segment) NOT IN {SEGMENTS}", "segment inválido"),
    ("registration_date", f"{_iso('registration_date')} IS NULL", "registration_date inválido"),
]

M_VALID = f"""(merchant_id IS NOT NULL AND merchant_name IS NOT NULL AND trim(merchant_name) <> ''
  AND (lower(category) IN {CATEGORIES} OR category IS NULL)
  AND (upper(country) IN {COUNTRIES} OR country IS NULL)
  AND {_iso('affiliation_date')} IS NOT NULL
  AND (lower(status) IN {M_STATUSES} OR status IS NULL)
  AND ((risk_level IS NOT NULL AND lower(risk_level) IN {RISKS}) OR (risk_level IS NULL AND category IS NULL)))"""

M_RULES = [
    ("merchant_id", "merchant_id IS NULL", "merchant_id nulo crítico"),
    ("merchant_id", "rn > 1", "merchant_id duplicado"),
    ("merchant_name", "coalesce(trim(merchant_name), '') = ''", "merchant_name vacío o nulo"),
    ("category", f"lower(category) NOT IN {CATEGORIES}", "category inválido"),
    ("country", f"upper(country) NOT IN {COUNTRIES}", "country inválido"),
    ("affiliation_date", f"{_iso('affiliation_date')} IS NULL", "affiliation_date inválido"),
    ("status", f"lower(status) NOT IN {M_STATUSES}", "status inválido"),
    ("risk_level", "risk_level IS NULL AND category IS NOT NULL", "risk_level nulo con category presente"),
    ("risk_level", f"lower(risk_level) NOT IN {RISKS} AND category IS NOT NULL", "risk_level inválido"),
]


def _first_rule(rules: list[tuple[str, str, str]], part: int) -> str:
    """Column (0) or message (2) of the lowest-numbered rule that holds, by number from a list."""
    numbers = ", ".join(f"CASE WHEN {rule[1]} THEN {k} END" for k, rule in enumerate(rules, 1))
    values = ", ".join(f"'{rule[part]}'" for rule in rules)
    return f"list_extract([{values}], least({numbers}))"


_D = "DESC NULLS LAST"

_RAW = f"""
tx_raw AS ({fixtures.raw_sql('transactions', 'duckdb')}),
u_raw AS ({fixtures.raw_sql('users', 'duckdb')}),
m_raw AS ({fixtures.raw_sql('merchants', 'duckdb')}),"""

_DERIVED = f"""
tx_r AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
      CASE WHEN status = 'aprobado' THEN 3 WHEN status = 'pendiente' THEN 2 ELSE 1 END DESC,
      transaction_date {_D}, user_id {_D}, merchant_id {_D}, channel {_D}, transaction_type {_D},
      amount {_D}, currency {_D}, status {_D}, reference_id {_D}) AS rn
  FROM tx_raw),
tx_q AS (SELECT *, {TX_VALID} AS valid, {_first_rule(TX_RULES, 2)} AS reject_reason, {_first_rule(TX_RULES, 0)} AS error_column FROM tx_r),
u_r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
      CASE WHEN document_id IS NOT NULL THEN 2 ELSE 1 END DESC,
      registration_date {_D}, full_name {_D}, document_id {_D}, email {_D}, phone {_D},
      country {_D}, segment {_D}) AS rn
  FROM u_raw),
u_q AS (SELECT *, {U_VALID} AS valid, {_first_rule(U_RULES, 2)} AS reject_reason, {_first_rule(U_RULES, 0)} AS error_column FROM u_r),
m_r AS (
  SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY
      CASE WHEN merchant_name IS NOT NULL AND trim(merchant_name) <> '' THEN 2 ELSE 1 END DESC,
      affiliation_date {_D}, merchant_name {_D}, category {_D}, country {_D}, status {_D},
      risk_level {_D}) AS rn
  FROM m_raw),
m_q AS (SELECT *, {M_VALID} AS valid, {_first_rule(M_RULES, 2)} AS reject_reason, {_first_rule(M_RULES, 0)} AS error_column FROM m_r),
tx_w AS (SELECT * FROM tx_q WHERE rn = 1 AND transaction_id IS NOT NULL),
u_w AS (SELECT * FROM u_q WHERE rn = 1 AND user_id IS NOT NULL),
m_w AS (SELECT * FROM m_q WHERE rn = 1 AND merchant_id IS NOT NULL),
tx_norm AS (
  SELECT transaction_id, user_id, merchant_id,
    coalesce(try_cast(amount AS DECIMAL(18,2)), try_cast(regexp_replace(amount, '[^0-9.]', '', 'g') AS DECIMAL(18,2))) AS amount,
    coalesce({_iso('transaction_date')}, {_dmy('transaction_date')}) AS transaction_date,
    CASE WHEN lower(trim(transaction_type)) = 'reversa' THEN reference_id ELSE 'none' END AS reference_id,
    lower(trim(channel)) AS channel, lower(trim(transaction_type)) AS transaction_type,
    upper(trim(currency)) AS currency, lower(trim(status)) AS status,
    {AS_OF} AS _ingested_at, valid
  FROM tx_w),
u_norm AS (
  SELECT user_id, full_name, document_id, email, phone, upper(trim(country)) AS country,
    lower(trim(segment)) AS segment, {_iso('registration_date')} AS registration_date,
    {AS_OF} AS _ingested_at, valid
  FROM u_w),
m_norm AS (
  SELECT merchant_id, merchant_name, lower(trim(category)) AS category, upper(trim(country)) AS country,
    {_iso('affiliation_date')} AS affiliation_date, lower(trim(status)) AS status,
    lower(trim(risk_level)) AS risk_level, {AS_OF} AS _ingested_at, valid
  FROM m_w),
tx_silver AS (SELECT * EXCLUDE (valid) FROM tx_norm WHERE valid),
u_silver AS (SELECT * EXCLUDE (valid) FROM u_norm WHERE valid),
m_silver AS (SELECT * EXCLUDE (valid) FROM m_norm WHERE valid),
m_risk AS (
  SELECT merchant_id, risk_level, CASE lower(risk_level) WHEN 'bajo' THEN 1 WHEN 'medio' THEN 2
      WHEN 'alto' THEN 3 ELSE 0 END AS risk_score
  FROM m_silver),
dim_channel AS (
  SELECT CASE channel WHEN 'web' THEN 1 WHEN 'app' THEN 2 WHEN 'pos' THEN 3 ELSE 99 END AS channel_id,
    channel AS des_channel, {AS_OF} AS _ingested_at
  FROM (SELECT DISTINCT channel FROM tx_silver)),
fact AS (
  SELECT t.user_id, t.merchant_id, c.channel_id, t.transaction_date,
    CAST(sum(t.amount) AS DECIMAL(28,2)) AS total_amount,
    count(*) AS transaction_count,
    sum(CASE WHEN t.transaction_type = 'reversa' THEN 1 ELSE 0 END) / count(*) AS reversal_rate,
    avg(coalesce(r.risk_score, 0)) AS avg_risk_score,
    {AS_OF} AS _ingested_at
  FROM tx_silver t
  LEFT JOIN m_risk r ON t.merchant_id = r.merchant_id
  LEFT JOIN dim_channel c ON t.channel = c.des_channel
  GROUP BY t.user_id, t.merchant_id, c.channel_id, t.transaction_date),
dim_date AS (
  SELECT transaction_date AS date_id, CAST(day(transaction_date) AS INTEGER) AS day,
    CAST(weekofyear(transaction_date) AS INTEGER) AS week, CAST(month(transaction_date) AS INTEGER) AS month,
    CAST(quarter(transaction_date) AS INTEGER) AS quarter, CAST(year(transaction_date) AS INTEGER) AS year,
    {AS_OF} AS _ingested_at
  FROM (SELECT DISTINCT transaction_date FROM tx_silver)),
dim_merchant AS (SELECT * FROM m_silver),
dim_user AS (
  SELECT user_id, '***MASKED***' AS full_name, '****' || right(document_id, 4) AS document_id,
    substring(email, 1, 1) || '*****' || substring(email, instr(email, '@')) AS email,
    '+' || substring(phone, 2, 3) || '*******' || right(phone, 3) AS phone,
    segment, country, registration_date, {AS_OF} AS _ingested_at
  FROM u_silver),
quarantine AS (
  SELECT 'transactions' AS source_name, reject_reason, error_column, transaction_id AS record_key, {AS_OF} AS _ingested_at
  FROM tx_q WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT 'merchants', reject_reason, error_column, merchant_id, {AS_OF} FROM m_q WHERE reject_reason IS NOT NULL
  UNION ALL
  SELECT 'users', reject_reason, error_column, user_id, {AS_OF} FROM u_q WHERE reject_reason IS NOT NULL),
records AS (
  SELECT 'Bronze' AS layer, 'merchants' AS table_name, {_loaded('merchant_id')} AS ingested_at, count(*) AS record_count FROM m_raw GROUP BY ALL
  UNION ALL SELECT 'Bronze', 'transactions', {_loaded('transaction_id')}, count(*) FROM tx_raw GROUP BY ALL
  UNION ALL SELECT 'Bronze', 'users', {_loaded('user_id')}, count(*) FROM u_raw GROUP BY ALL
  UNION ALL SELECT 'Silver', 'merchants_silver', {AS_OF}, count(*) FROM m_silver GROUP BY ALL
  UNION ALL SELECT 'Silver', 'transactions_silver', {AS_OF}, count(*) FROM tx_silver GROUP BY ALL
  UNION ALL SELECT 'Silver', 'users_silver', {AS_OF}, count(*) FROM u_silver GROUP BY ALL
  UNION ALL SELECT 'Gold', 'dim_channel', {AS_OF}, count(*) FROM dim_channel GROUP BY ALL
  UNION ALL SELECT 'Gold', 'dim_date', {AS_OF}, count(*) FROM dim_date GROUP BY ALL
  UNION ALL SELECT 'Gold', 'dim_merchant', {AS_OF}, count(*) FROM dim_merchant GROUP BY ALL
  UNION ALL SELECT 'Gold', 'dim_user', {AS_OF}, count(*) FROM dim_user GROUP BY ALL
  UNION ALL SELECT 'Gold', 'fact_transactions', {AS_OF}, count(*) FROM fact GROUP BY ALL),
details AS (
  SELECT source_name, reject_reason, error_column, {AS_OF} AS processed_date, count(*) AS count
  FROM quarantine GROUP BY ALL)
"""

BASE = _RAW + _DERIVED


def _q(select: str) -> str:
    return f"WITH {BASE}\n{select}"


def over_tables(name: str, tx: str = "tx_in", users: str = "u_in", merchants: str = "m_in") -> str:
    """The oracle of query ``name`` over given raw tables instead of the fixtures."""
    raw = (f"tx_raw AS (SELECT * FROM {tx}),\nu_raw AS (SELECT * FROM {users}),\n"
           f"m_raw AS (SELECT * FROM {merchants}),")
    return ORACLE[name].replace(f"WITH {BASE}", f"WITH {raw}{_DERIVED}", 1)


def _expect(table: str, name: str, cond: str, src: str, scope: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{name}' AS expectation, '{scope}' AS scope, "
            f"count_if(coalesce({cond}, false)) AS passed, "
            f"count_if(NOT coalesce({cond}, false)) AS failed FROM {src}")


_EXPECTATIONS = [
    ("transactions_silver", "valid_amount", "amount IS NOT NULL AND amount > 0", "tx"),
    ("transactions_silver", "date_parsed", "transaction_date IS NOT NULL", "tx"),
    ("users_silver", "valid_email", f"regexp_matches(email, {EMAIL})", "u"),
    ("merchants_silver", "valid_affiliation_date", "affiliation_date IS NOT NULL", "m"),
]

_MASKED_USER = """user_id, '***MASKED***' AS full_name, '****' || right(document_id, 4) AS document_id,
  substring(email, 1, 1) || '*****' || substring(email, instr(email, '@')) AS email,
  '+' || substring(phone, 2, 3) || '*******' || right(phone, 3) AS phone"""

def _run_log() -> str:
    rows = [("Silver", "transactions_silver", "tx_silver"), ("Silver", "users_silver", "u_silver"),
            ("Silver", "merchants_silver", "m_silver"), ("Silver", "quarantine", "quarantine"),
            ("Gold", "dim_channel", "dim_channel"), ("Gold", "fact_transactions", "fact"),
            ("Gold", "dim_merchant", "dim_merchant"), ("Gold", "dim_user", "dim_user"),
            ("Gold", "dim_date", "dim_date")]
    rows += [("Gold", f"mv_{t}", src) for _, t, src in rows if _ == "Gold"]
    gaps = {"transactions": "tx_w", "users": "u_w", "merchants": "m_w"}
    parts = [f"SELECT '{layer}' AS layer, '{table}' AS table_name, 'rows' AS metric, count(*) AS value FROM {src}"
             for layer, table, src in rows]
    parts += [f"SELECT 'Silver', 'unaccounted_{n}', 'rows', count(*) FROM {w} "
              "WHERE NOT coalesce(valid, false) AND reject_reason IS NULL" for n, w in gaps.items()]
    for table, name, cond, src in _EXPECTATIONS:
        parts.append(f"SELECT 'Silver', '{table}', '{name}__passed', count_if(coalesce({cond}, false)) "
                     f"FROM {src}_silver")
        parts.append(f"SELECT 'Silver', '{table}', '{name}__failed', count_if(NOT coalesce({cond}, false)) "
                     f"FROM {src}_silver")
    return _q(" UNION ALL ".join(parts))


def _event_log() -> str:
    """Events of one job in order: start, batches read, tables written, end."""
    written = [("Silver", "transactions_silver", "tx_silver"), ("Silver", "users_silver", "u_silver"), ("Silver", "merchants_silver", "m_silver")]
    written += [("Silver", f"unaccounted_{n}", f"{w} WHERE NOT coalesce(valid, false) AND reject_reason IS NULL")
                for n, w in (("transactions", "tx_w"), ("users", "u_w"), ("merchants", "m_w"))]
    written += [("Silver", "quarantine", "quarantine")]
    gold = [("dim_channel", "dim_channel"), ("fact_transactions", "fact"), ("dim_merchant", "dim_merchant"),
            ("dim_user", "dim_user"), ("dim_date", "dim_date")]
    written += [("Gold", t, src) for t, src in gold]
    views = dict(gold)
    written += [("Gold", f"mv_{t}", views[t]) for t in ("fact_transactions", "dim_merchant", "dim_user", "dim_channel", "dim_date")]
    event = ("'fixture:' || {n} AS id, '{{\"run_id\":\"fixture\",\"number\":{n}}}' AS sequence, {origin} AS origin, "
             f"CAST({AS_OF} AS TIMESTAMP) AS timestamp, {{message}} AS message, {{level}} AS level, 'STABLE' AS maturity_level, "
             "CAST(NULL AS VARCHAR) AS error, {details} AS details, '{kind}' AS event_type, 1 AS count")
    parts = ["SELECT " + event.format(n=0, origin="CAST(NULL AS VARCHAR)", message="'Run fixture started'", level="'INFO'",
                                      details="CAST(NULL AS VARCHAR)", kind="create_update")]
    for n, (table, src) in enumerate((("transactions", "tx_raw"), ("users", "u_raw"), ("merchants", "m_raw")), 1):
        parts.append("SELECT " + event.format(
            n=n, origin=f"'{{\"layer\":\"Bronze\",\"table_name\":\"{table}\",\"batch_id\":0}}'", message=f"count(*) || ' rows read into {table}'",
            level="'INFO'", details="'{\"rows\":' || count(*) || ',\"expectations\":[]}'", kind="flow_progress") + f" FROM {src}")
    for n, (layer, table, src) in enumerate(written, 4):
        checks = sorted((name, f"coalesce({cond}, false)") for t, name, cond, _ in _EXPECTATIONS if t == table)
        cells = " || ',' || ".join(f"'{{\"name\":\"{name}\",\"passed\":' || count_if({ok}) || ',\"failed\":' || count_if(NOT {ok}) || '}}'" for name, ok in checks)
        level = f"CASE WHEN {' + '.join(f'count_if(NOT {ok})' for _, ok in checks)} > 0 THEN 'WARN' ELSE 'INFO' END" if checks else "'INFO'"
        parts.append("SELECT " + event.format(
            n=n, origin=f"'{{\"layer\":\"{layer}\",\"table_name\":\"{table}\"}}'", message=f"count(*) || ' rows written to {table}'", level=level,
            details="'{\"rows\":' || count(*) || ',\"expectations\":[' || " + (cells + " || " if cells else "") + "']}'", kind="flow_progress") + f" FROM {src}")
    parts.append("SELECT " + event.format(n=len(written) + 4, origin="CAST(NULL AS VARCHAR)", message="'Run fixture completed'", level="'INFO'",
                                          details="CAST(NULL AS VARCHAR)", kind="update_progress"))
    return _q(" UNION ALL ".join(parts))


ORACLE: dict[str, str] = {
    "run_log": _run_log(),
    "event_log_dataset": _event_log(),
    # sources
    "ingest_csv": _q(f"SELECT {TX_COLS} FROM tx_raw"),
    "ingest_pipe": _q(f"SELECT {U_COLS} FROM u_raw"),
    "ingest_json": _q(f"SELECT {M_COLS} FROM m_raw"),
    "ingest_manifest": _q("SELECT 'transactions' AS source_name, transaction_id AS record_key FROM tx_raw "
                          "UNION ALL SELECT 'users', user_id FROM u_raw "
                          "UNION ALL SELECT 'merchants', merchant_id FROM m_raw"),
    # silver
    "silver_transactions": _q("SELECT * FROM tx_silver"),
    "silver_users": _q("SELECT * FROM u_silver"),
    "silver_merchants": _q("SELECT * FROM m_silver"),
    "clean_amount": _q("SELECT amount, try_cast(amount AS DECIMAL(18,2)) AS amount_value, "
                       "coalesce(try_cast(amount AS DECIMAL(18,2)), try_cast(regexp_replace(amount, '[^0-9.]', '', 'g') AS DECIMAL(18,2))) AS amount_clean "
                       "FROM tx_raw"),
    "parse_dates": _q(f"SELECT transaction_date, coalesce({_iso('transaction_date')}, "
                      f"{_dmy('transaction_date')}) AS parsed_date FROM tx_raw"),
    "expectation_metrics": _q(" UNION ALL ".join(
        [_expect(t, n, c, f"{s}_silver", "output") for t, n, c, s in _EXPECTATIONS]
        + [_expect(t, n, c, f"{s}_norm", "input") for t, n, c, s in _EXPECTATIONS])),
    # dedup / rank
    "dedup_transactions": _q(f"SELECT {TX_COLS} FROM tx_w"),
    "dedup_users": _q(f"SELECT {U_COLS} FROM u_w"),
    "dedup_merchants": _q(f"SELECT {M_COLS} FROM m_w"),
    "rank_transactions": _q(f"SELECT {TX_COLS}, CASE WHEN transaction_id IS NOT NULL THEN rn > 1 END AS is_duplicate FROM tx_r"),
    "rank_users": _q(f"SELECT {U_COLS}, CASE WHEN user_id IS NOT NULL THEN rn > 1 END AS is_duplicate FROM u_r"),
    "rank_merchants": _q(f"SELECT {M_COLS}, CASE WHEN merchant_id IS NOT NULL THEN rn > 1 END AS is_duplicate FROM m_r"),
    # quarantine
    "rejected_transactions": _q(f"SELECT 'transactions' AS source_name, reject_reason, error_column, {TX_COLS} "
                                "FROM tx_q WHERE reject_reason IS NOT NULL"),
    "rejected_users": _q(f"SELECT 'users' AS source_name, reject_reason, error_column, {U_COLS} "
                         "FROM u_q WHERE reject_reason IS NOT NULL"),
    "rejected_merchants": _q(f"SELECT 'merchants' AS source_name, reject_reason, error_column, {M_COLS} "
                             "FROM m_q WHERE reject_reason IS NOT NULL"),
    "quarantine": _q("SELECT * FROM quarantine"),
    "reject_reason_counts": _q("SELECT source_name, reject_reason, error_column, count(*) AS rejected "
                               "FROM quarantine GROUP BY ALL"),
    "unaccounted_transactions": _q(f"SELECT 'transactions' AS source_name, {TX_COLS} FROM tx_w "
                                   "WHERE NOT coalesce(valid, false) AND reject_reason IS NULL"),
    "unaccounted": _q("SELECT 'transactions' AS source_name, transaction_id AS record_key FROM tx_w "
                      "WHERE NOT coalesce(valid, false) AND reject_reason IS NULL "
                      "UNION ALL SELECT 'users', user_id FROM u_w WHERE NOT coalesce(valid, false) AND reject_reason IS NULL "
                      "UNION ALL SELECT 'merchants', merchant_id FROM m_w WHERE NOT coalesce(valid, false) AND reject_reason IS NULL"),
    # gold
    "enrich_risk": _q("SELECT t.transaction_id, t.merchant_id, coalesce(r.risk_score, 0) AS risk_score "
                      "FROM tx_silver t LEFT JOIN m_risk r ON t.merchant_id = r.merchant_id"),
    "enrich_channel": _q("SELECT t.transaction_id, t.channel, c.channel_id FROM tx_silver t "
                         "LEFT JOIN dim_channel c ON t.channel = c.des_channel"),
    "merchant_risk_score": _q("SELECT merchant_id, risk_level, risk_score FROM m_risk"),
    "fact_transactions": _q("SELECT * FROM fact"),
    "reversal_rate": _q("SELECT merchant_id, sum(CASE WHEN transaction_type = 'reversa' THEN 1 ELSE 0 END) / count(*) "
                        "AS reversal_rate FROM tx_silver GROUP BY merchant_id"),
    "dim_channel": _q("SELECT * FROM dim_channel"),
    "dim_date": _q("SELECT * FROM dim_date"),
    "dim_merchant": _q("SELECT * FROM dim_merchant"),
    "dim_user": _q("SELECT * FROM dim_user"),
    "mv_fact_transactions": _q("SELECT * FROM fact"),
    "mv_dim_merchant": _q("SELECT * FROM dim_merchant"),
    "mv_dim_user": _q("SELECT * FROM dim_user"),
    "mv_dim_channel": _q("SELECT * FROM dim_channel"),
    "mv_dim_date": _q("SELECT * FROM dim_date"),
    "fact_daily_window": _q("""SELECT t.user_id, t.merchant_id,
    CASE t.channel WHEN 'web' THEN 1 WHEN 'app' THEN 2 WHEN 'pos' THEN 3 ELSE 99 END AS channel_id,
    CAST(time_bucket(INTERVAL 1 DAY, CAST(t.transaction_date AS TIMESTAMP)) AS DATE) AS transaction_date,
    CAST(sum(t.amount) AS DECIMAL(28,2)) AS total_amount, count(*) AS transaction_count,
    avg(CASE WHEN t.transaction_type = 'reversa' THEN 1.0 ELSE 0.0 END) AS reversal_rate,
    CAST(coalesce(any_value(r.risk_score), 0) AS DOUBLE) AS avg_risk_score
  FROM tx_silver t LEFT JOIN m_risk r ON t.merchant_id = r.merchant_id
  GROUP BY 1, 2, 3, 4"""),
    "fact_closed_repaired": _q("SELECT * EXCLUDE (_ingested_at) FROM fact"),
    # governance
    "mask_pii": _q(f"SELECT {_MASKED_USER} FROM u_silver"),
    "rls_riesgo": _q("SELECT user_id, segment FROM u_silver WHERE segment IN ('premium', 'estandar')"),
    "rls_auditoria": _q("SELECT user_id, segment FROM u_silver WHERE segment = 'premium'"),
    "secure_users": _q(f"SELECT {_MASKED_USER}, country, segment, registration_date, _ingested_at "
                       "FROM u_silver WHERE segment IN ('premium', 'estandar')"),
    "secure_lake": _q("SELECT 'engineer' AS reader, * FROM u_silver "
                      + "".join(f"UNION ALL SELECT '{who}', {_MASKED_USER}, country, segment, registration_date, _ingested_at "
                                f"FROM u_silver WHERE segment IN ({seen}) "
                                for who, seen in (("analyst", "'premium', 'estandar'"), ("auditor", "'premium'"),
                                                  ("lead", "'premium', 'estandar'")))),
    # observability
    "records_by_layer_table": _q("SELECT layer, table_name, CAST(sum(record_count) AS BIGINT) AS total_records "
                                 "FROM records GROUP BY layer, table_name"),
    "total_processed": _q("SELECT CAST(sum(record_count) AS BIGINT) AS total_records FROM records"),
    "records_by_layer": _q("SELECT layer, CAST(sum(record_count) AS BIGINT) AS total_records FROM records GROUP BY layer"),
    "records_over_time": _q("SELECT layer, ingested_at, CAST(sum(record_count) AS BIGINT) AS total_records "
                            "FROM records GROUP BY layer, ingested_at"),
    "records_date_range": _q("SELECT layer, table_name, CAST(sum(record_count) AS BIGINT) AS total_records FROM records "
                             "WHERE ingested_at BETWEEN DATE '2024-12-01' AND DATE '2024-12-31' GROUP BY layer, table_name"),
    "records_layer_filter": _q("SELECT layer, table_name, CAST(sum(record_count) AS BIGINT) AS total_records FROM records "
                               "WHERE layer IN ('Bronze', 'Gold') GROUP BY layer, table_name"),
    "filter_associativity": _q("SELECT layer, count_if(layer IN ('Bronze', 'Gold')) AS layer_associativity "
                               "FROM records GROUP BY layer"),
    "total_rejected": _q("SELECT count(*) AS count FROM quarantine"),
    "rejected_by_source": _q("SELECT source_name, count(*) AS count FROM quarantine GROUP BY source_name"),
    "rejected_details": _q("SELECT * FROM details"),
    "rejected_details_top20": _q("SELECT * FROM details ORDER BY count DESC, source_name, reject_reason, "
                                 "error_column LIMIT 20"),
    "event_log_rollup": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
}

# tables kept by changes, after all drops of the fixtures: what the batch tables hold
for _name, _same in (("silver_incremental", "silver_transactions"), ("silver_incremental_users", "silver_users"),
                     ("silver_incremental_merchants", "silver_merchants"), ("fact_retracting", "fact_transactions"),
                     ("quarantine_incremental", "quarantine"), ("unaccounted_incremental", "unaccounted")):
    ORACLE[_name] = ORACLE[_same]
