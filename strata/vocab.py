"""Vocabularies, codes, patterns and messages.

These are data, not logic. They must equal the values the original pipeline
validates against and writes, so they are kept verbatim and together here.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------------------
# Fixed values (closed vocabularies, lower/upper case as compared)
# ---------------------------------------------------------------------------
CHANNELS = ("web", "app", "pos")
TRANSACTION_TYPES = ("pago", "reversa", "retiro")
CURRENCIES = ("PEN", "USD", "COP", "MXN", "CLP", "ARS")
TRANSACTION_STATUSES = ("aprobado", "rechazado", "pendiente")
MERCHANT_CATEGORIES = (
    "retail", "restaurante", "farmacia", "supermercado", "tecnologia",
    "transporte", "educacion", "salud", "entretenimiento", "moda",
)
COUNTRIES = ("PE", "CO", "MX", "CL", "AR")
MERCHANT_STATUSES = ("activo", "inactivo", "suspendido")
RISK_LEVELS = ("bajo", "medio", "alto")
SEGMENTS = ("premium", "estandar", "nuevo")

# codes
CHANNEL_IDS = (("web", 1), ("app", 2), ("pos", 3))
OTHER_CHANNEL_ID = 99
RISK_SCORES = (("bajo", 1), ("medio", 2), ("alto", 3))
UNKNOWN_RISK_SCORE = 0
# raw, case-sensitive status -> dedup priority (higher wins); anything else 1
STATUS_PRIORITIES = (("aprobado", 3), ("pendiente", 2))
REVERSAL = "reversa"
NO_REFERENCE = "none"
PERU = "PE"

# patterns
DATE_FORMAT = "yyyy-MM-dd"
ALT_DATE_FORMAT = "dd/MM/yyyy"
AMOUNT_JUNK = "[^0-9.]"
NAME_FORBIDDEN = "[,;|]"
PE_DOCUMENT = "^[0-9]{8}$"
EMAIL = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$"
PHONE = "^\\+[0-9]{1,3}[0-9]{6,}$"

# Masks and reader groups
MASKED_NAME = "***MASKED***"
DOCUMENT_MASK = "****"
EMAIL_MASK = "*****"
PHONE_MASK = "*******"
GROUP_ENGINEERING = "ingenieria"
GROUP_RISK = "riesgo"
GROUP_AUDIT = "auditoria"
RISK_VISIBLE_SEGMENTS = ("premium", "estandar")
AUDIT_VISIBLE_SEGMENTS = ("premium",)

# Reject reasons (output text, verbatim)
TX_ID_NULL = "transaction_id nulo crítico"
TX_ID_DUP = "transaction_id duplicado"
TX_USER_NULL = "user_id nulo crítico"
TX_MERCHANT_NULL = "merchant_id nulo crítico"
TX_AMOUNT_NULL = "amount nulo crítico"
TX_AMOUNT_NOT_POSITIVE = "amount inválido (no positivo)"
TX_DATE_NULL = "transaction_date nulo crítico"
TX_REFERENCE_MISSING = "reference_id faltante en reversa"
TX_CHANNEL = "channel formato incorrecto"
TX_TYPE = "transaction_type inválido"
TX_CURRENCY = "currency inválido"
TX_STATUS = "status inválido"

M_ID_NULL = "merchant_id nulo crítico"
M_ID_DUP = "merchant_id duplicado"
M_NAME = "merchant_name vacío o nulo"
M_CATEGORY = "category inválido"
M_COUNTRY = "country inválido"
M_DATE = "affiliation_date inválido"
M_STATUS = "status inválido"
M_RISK_NULL = "risk_level nulo con category presente"
M_RISK = "risk_level inválido"

U_ID_NULL = "user_id nulo crítico"
U_ID_DUP = "user_id duplicado"
U_NAME = "full_name inválido"
U_DOCUMENT = "document_id inválido para PE"
U_EMAIL = "email inválido"
U_PHONE = "phone inválido"
U_COUNTRY = "country inválido"
U_SEGMENT = "segment inválido"
U_DATE = "registration_date inválido"

# ---------------------------------------------------------------------------
# Landing-file schemas: every column is a nullable string at the edge.
# ---------------------------------------------------------------------------
TRANSACTION_COLUMNS = (
    "transaction_id", "user_id", "merchant_id", "channel", "transaction_type",
    "amount", "currency", "transaction_date", "status", "reference_id",
)
USER_COLUMNS = (
    "user_id", "full_name", "document_id", "email", "phone", "country",
    "segment", "registration_date",
)
MERCHANT_COLUMNS = (
    "merchant_id", "merchant_name", "category", "country", "affiliation_date",
    "status", "risk_level",
)

AUDIT_COLUMNS = ("_ingested_at", "_source_file", "_pipeline_run_id")
ROW_ID = "_row_id"


def string_schema(columns) -> StructType:
    """All-string, nullable schema in the given column order."""
    return StructType([StructField(c, StringType(), True) for c in columns])


TRANSACTIONS_SCHEMA = string_schema(TRANSACTION_COLUMNS)
USERS_SCHEMA = string_schema(USER_COLUMNS)
MERCHANTS_SCHEMA = string_schema(MERCHANT_COLUMNS)
