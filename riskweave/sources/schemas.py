"""Declared schemas of the raw and staged tables (schema is declared, never inferred)."""

from pyspark.sql import types as T

S, D, I, L, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()
DATE, TS_NTZ = T.DateType(), T.TimestampNTZType()


def _struct(*cols):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


ACCOUNTS = _struct(
    ("account_id", S, False),
    ("account_name", S, False),
    ("plan_name", S, False),
    ("mrr", D, False),
    ("seats_contracted", I, False),
    ("renewal_date", DATE, False),
    ("is_active", B, False),
    ("created_at", TS_NTZ, False),
)

PRODUCT_EVENTS = _struct(
    ("event_id", S, False),
    ("account_id", S, False),
    ("user_id", S, False),
    ("session_id", S, False),
    ("feature_name", S, False),
    ("event_ts", TS_NTZ, False),
)

BILLING_EVENTS = _struct(
    ("event_id", S, False),
    ("account_id", S, False),
    ("event_type", S, False),
    ("amount", D, True),
    ("event_ts", TS_NTZ, False),
)

SUPPORT_TICKETS = _struct(
    ("ticket_id", S, False),
    ("account_id", S, False),
    ("severity", S, False),
    ("status", S, False),
    ("created_at", TS_NTZ, False),
    ("resolved_at", TS_NTZ, True),
)

RAW = {
    "accounts": ACCOUNTS,
    "product_events": PRODUCT_EVENTS,
    "billing_events": BILLING_EVENTS,
    "support_tickets": SUPPORT_TICKETS,
}

# fixed value domains declared by the data tests
PLAN_NAMES = ["starter", "growth", "enterprise"]
BILLING_EVENT_TYPES = ["payment_failure", "downgrade", "upgrade", "renewal", "cancellation"]
SEVERITIES = ["P1", "P2", "P3", "P4"]
TICKET_STATUSES = ["open", "resolved", "closed"]
