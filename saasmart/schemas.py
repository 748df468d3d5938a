"""Raw-layer schemas and layer names.

Types are fixed here and enforced at ingest: timestamps are TIMESTAMP_NTZ
(the generator adds days to dates, which yields midnight timestamps), money
is DECIMAL(10,2), keys are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

USERS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("email", T.StringType(), True),
    T.StructField("full_name", T.StringType(), True),
    T.StructField("plan", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("country_code", T.StringType(), True),
])

EVENTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_name", T.StringType(), True),
    T.StructField("event_timestamp", T.TimestampNTZType(), True),
    T.StructField("properties", T.StringType(), True),
])

INVOICES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("amount", MONEY, True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("issued_at", T.TimestampNTZType(), True),
    T.StructField("paid_at", T.TimestampNTZType(), True),
])

SUPPORT_TICKETS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("subject", T.StringType(), True),
    T.StructField("priority", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("resolved_at", T.TimestampNTZType(), True),
])

RAW_TABLES = {
    "users": USERS,
    "events": EVENTS,
    "invoices": INVOICES,
    "support_tickets": SUPPORT_TICKETS,
}

# Activity tables are appended batch by batch; users are replaced whole.
ACTIVITY_TABLES = ("events", "invoices", "support_tickets")

# Tables that a lake with buckets keeps by user: joins and sums on that key need no exchange.
BUCKET_KEYS = {"users": "id", "invoices": "user_id", "support_tickets": "user_id"}

# Default layer (database) names; a custom name is used verbatim.
DEFAULT_LAYERS = {
    "raw": "raw",
    "staging": "stg",
    "intermediate": "intermediate",
    "marts": "marts",
}


def layer_name(custom: str | None, default_schema: str) -> str:
    """Custom layer name used verbatim (trimmed), else the target default."""
    if custom is None:
        return default_schema
    return custom.strip()


def nullable(schema: T.StructType) -> T.StructType:
    """Same fields, all nullable (file-source reads report columns as nullable)."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
