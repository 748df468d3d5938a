"""Plain SQL renderings of every registered query, for the DuckDB oracle.

The driver pre-registers the test tables as views; these strings only read
those views. The adapter CTEs mirror ``saasmart.sources.adapters`` and the
model SQL mirrors ``saasmart.plans.models``, with two deterministic choices
made explicit on both sides: ``event_id`` breaks timestamp ties and NULL
timestamps sort last. Decimal sums are cast to the type Spark gives
(DECIMAL(10,2) summed -> DECIMAL(20,2)).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from saasmart.sources import adapters as A
from saasmart.sources import rules as R

SUM_MONEY = "DECIMAL(20,2)"

# DAU counted events for the test data (event types present: error, click,
# view, signup, purchase).
TEST_DAU_EVENTS = {
    "page_views": "view",
    "signups": "signup",
    "upgrades": "purchase",
    "downgrades": "error",
}

SYNTH_SEED = 42


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def sql_list(values: Sequence[str]) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def pick(values: Sequence[str], expr: str) -> str:
    """values[expr] for a 0-based index expression (DuckDB lists are 1-based)."""
    return f"{sql_list(values)}[({expr}) + 1]"


def days_after(date_text: str, days_expr: str) -> str:
    return f"CAST(DATE {q(date_text)} + CAST({days_expr} AS INTEGER) AS TIMESTAMP)"


# ---------------------------------------------------------------------------
# adapters (test tables -> raw tables)
# ---------------------------------------------------------------------------

RAW_USERS = f"""
SELECT CAST(c.c_custkey AS BIGINT) AS id,
       'user' || CAST(c.c_custkey AS VARCHAR) || {q('@' + A.USER_EMAIL_DOMAIN)} AS email,
       c.c_name AS full_name,
       c.c_mktsegment AS plan,
       {days_after(R.USER_BASE_DATE, f'-((c.c_custkey * {R.CREATED_AT_STEP}) % {R.CREATED_AT_SPAN_DAYS})')} AS created_at,
       n.n_name AS country_code
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

RAW_EVENTS = """
SELECT CAST(event_id AS BIGINT) AS id,
       CAST(user_id AS BIGINT) AS user_id,
       event_type AS event_name,
       CAST(ts AS TIMESTAMP) AS event_timestamp,
       props AS properties
FROM events
"""

_status_case = " ".join(f"WHEN {q(code)} THEN {q(name)}"
                        for code, name in A.ORDER_STATUS_TO_INVOICE.items())
_paid_codes = ", ".join(q(code) for code, name in A.ORDER_STATUS_TO_INVOICE.items()
                        if name not in R.UNPAID_STATUSES)

RAW_INVOICES = f"""
SELECT CAST(o_orderkey AS BIGINT) AS id,
       CAST(o_custkey AS BIGINT) AS user_id,
       CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
       {q(R.CURRENCY)} AS currency,
       CASE o_orderstatus {_status_case} ELSE {q(A.UNKNOWN_ORDER_STATUS)} END AS status,
       CAST(o_orderdate AS TIMESTAMP) AS issued_at,
       CASE WHEN o_orderstatus IN ({_paid_codes}) THEN CAST(o_orderdate AS TIMESTAMP) END AS paid_at
FROM orders
"""

_n_open = len(R.OPEN_STATUSES)
RAW_TICKETS = f"""
SELECT CAST(event_id AS BIGINT) AS id,
       CAST(user_id AS BIGINT) AS user_id,
       {pick(R.TICKET_SUBJECTS, f'event_id % {len(R.TICKET_SUBJECTS)}')} AS subject,
       {pick(R.TICKET_PRIORITIES, f'event_id % {len(R.TICKET_PRIORITIES)}')} AS priority,
       {pick(R.TICKET_STATUSES, f'event_id % {len(R.TICKET_STATUSES)}')} AS status,
       CAST(ts AS TIMESTAMP) AS created_at,
       CASE WHEN event_id % {len(R.TICKET_STATUSES)} < {_n_open} THEN NULL
            ELSE CAST(ts AS TIMESTAMP)
                 + to_days(CAST(event_id % {R.RESOLVE_LAG_MOD} + 1 AS INTEGER)) END AS resolved_at
FROM events
WHERE event_type = {q(A.TICKET_SOURCE_EVENT)}
"""

# ---------------------------------------------------------------------------
# staging
# ---------------------------------------------------------------------------

STG_USERS = f"""
SELECT id AS user_id, email, full_name, plan, created_at, country_code FROM ({RAW_USERS})
"""
STG_EVENTS = f"""
SELECT id AS event_id, user_id, event_name, event_timestamp, properties FROM ({RAW_EVENTS})
"""
STG_INVOICES = f"""
SELECT id AS invoice_id, user_id, amount, currency, status, issued_at, paid_at FROM ({RAW_INVOICES})
"""
STG_TICKETS = f"""
SELECT id AS ticket_id, user_id, subject, priority, status, created_at, resolved_at FROM ({RAW_TICKETS})
"""

# ---------------------------------------------------------------------------
# models
# ---------------------------------------------------------------------------

REVENUE_BY_USER = f"""
SELECT user_id,
       count(*) AS total_invoices,
       count(*) FILTER (WHERE status = 'paid') AS paid_invoices,
       CAST(coalesce(sum(amount) FILTER (WHERE status = 'paid'), 0) AS {SUM_MONEY}) AS total_revenue,
       CAST(coalesce(sum(amount) FILTER (WHERE status = 'refunded'), 0) AS {SUM_MONEY}) AS total_refunded,
       min(issued_at) AS first_invoice_at,
       max(issued_at) AS last_invoice_at
FROM ({STG_INVOICES})
GROUP BY user_id
"""

_resolved = ", ".join(q(s) for s in R.RESOLVED_STATUSES)
TICKETS_BY_USER = f"""
SELECT user_id,
       count(*) AS total_tickets,
       count(*) FILTER (WHERE status IN ({_resolved})) AS resolved_tickets
FROM ({STG_TICKETS})
GROUP BY user_id
"""

_ORDER = "event_timestamp ASC NULLS LAST, event_id ASC NULLS LAST"
_GAP = f"INTERVAL {R.SESSION_GAP_SECONDS} SECOND"

SESSIONIZE_FLAGS = f"""
WITH lagged AS (
    SELECT *, lag(event_timestamp) OVER (PARTITION BY user_id ORDER BY {_ORDER}) AS prev_event_at
    FROM ({STG_EVENTS})
)
SELECT event_id, user_id, event_name, event_timestamp, properties, prev_event_at,
       CASE WHEN prev_event_at IS NULL OR event_timestamp - prev_event_at > {_GAP}
            THEN 1 ELSE 0 END AS is_new_session
FROM lagged
"""

SESSIONIZE = f"""
SELECT event_id, user_id, event_name, event_timestamp, properties,
       CAST(sum(is_new_session) OVER (PARTITION BY user_id ORDER BY {_ORDER}
                                      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_number
FROM ({SESSIONIZE_FLAGS})
"""


def daily_active_users_sql(events_sql: str, counted: Mapping[str, str] = TEST_DAU_EVENTS) -> str:
    counts = ",\n       ".join(f"count(*) FILTER (WHERE event_name = {q(ev)}) AS {col}"
                               for col, ev in counted.items())
    return f"""
SELECT CAST(event_timestamp AS DATE) AS activity_date,
       count(DISTINCT user_id) AS active_users,
       count(*) AS total_events,
       {counts}
FROM ({events_sql})
GROUP BY 1
"""


DAILY_ACTIVE_USERS = daily_active_users_sql(STG_EVENTS)

FCT_REVENUE = f"""
SELECT i.issued_at AS revenue_date,
       u.plan,
       u.country_code,
       i.status AS invoice_status,
       count(*) AS invoice_count,
       CAST(sum(i.amount) AS {SUM_MONEY}) AS gross_amount,
       CAST(sum(i.amount) FILTER (WHERE i.status = 'paid') AS {SUM_MONEY}) AS net_revenue,
       CAST(sum(i.amount) FILTER (WHERE i.status = 'refunded') AS {SUM_MONEY}) AS refunded_amount
FROM ({STG_INVOICES}) i
JOIN ({STG_USERS}) u ON i.user_id = u.user_id
GROUP BY 1, 2, 3, 4
"""

DIM_USERS = f"""
SELECT u.user_id, u.email, u.full_name, u.plan, u.created_at, u.country_code,
       CAST(coalesce(r.total_revenue, 0) AS {SUM_MONEY}) AS lifetime_revenue,
       coalesce(r.total_invoices, 0) AS total_invoices,
       r.first_invoice_at,
       r.last_invoice_at,
       coalesce(t.total_tickets, 0) AS total_tickets,
       coalesce(t.resolved_tickets, 0) AS resolved_tickets
FROM ({STG_USERS}) u
LEFT JOIN ({REVENUE_BY_USER}) r ON u.user_id = r.user_id
LEFT JOIN ({TICKETS_BY_USER}) t ON u.user_id = t.user_id
"""

# ---------------------------------------------------------------------------
# synthesis rules applied to ids read from the test tables
# ---------------------------------------------------------------------------

SYNTH_USERS = f"""
SELECT i AS id,
       'user' || CAST(i AS VARCHAR) || '@' || {pick(R.EMAIL_DOMAINS, f'i % {len(R.EMAIL_DOMAINS)}')} AS email,
       {pick(R.FULL_NAMES, f'i % {len(R.FULL_NAMES)}')} || ' ' || CAST(i % {R.NAME_SUFFIX_MOD} AS VARCHAR) AS full_name,
       CASE WHEN i % 10 < {R.PLAN_FREE_BELOW} THEN {q(R.PLANS[0])}
            WHEN i % 10 < {R.PLAN_PRO_BELOW} THEN {q(R.PLANS[1])}
            ELSE {q(R.PLANS[2])} END AS plan,
       {days_after(R.USER_BASE_DATE, f'-((i * {R.CREATED_AT_STEP}) % {R.CREATED_AT_SPAN_DAYS})')} AS created_at,
       {pick(R.COUNTRY_CODES, f'i % {len(R.COUNTRY_CODES)}')} AS country_code
FROM (SELECT CAST(c_custkey AS BIGINT) AS i FROM customer)
"""


def _props_sql(k: str) -> str:
    f = R.PROPERTIES_FORMATS
    n = len(R.EVENT_NAMES)
    return f"""CASE ({k}) % {n}
        WHEN 0 THEN printf({q(f['page_view'])}, {pick(R.PAGES, f'({k}) % {len(R.PAGES)}')},
                           {pick(R.REFERRERS, f'({k}) % {len(R.REFERRERS)}')})
        WHEN 1 THEN printf({q(f['signup'])}, {pick(R.SIGNUP_SOURCES, f'({k}) % {len(R.SIGNUP_SOURCES)}')})
        WHEN 2 THEN printf({q(f['upgrade'])}, {pick(R.PAID_PLANS, f'({k}) % {len(R.PAID_PLANS)}')})
        WHEN 3 THEN printf({q(f['downgrade'])}, {pick(R.PAID_PLANS, f'({k}) % {len(R.PAID_PLANS)}')})
        WHEN 4 THEN printf({q(f['feature_use'])}, {pick(R.FEATURES, f'({k}) % {len(R.FEATURES)}')})
        ELSE printf({q(f['logout'])}, CAST(({k}) % {R.SESSION_DURATION_MOD} AS VARCHAR))
    END"""


def synth_events_sql(ids_sql: str, seed: int = SYNTH_SEED) -> str:
    k = f"i + {seed}"
    span = R.ACTIVITY_DAYS * R.SECONDS_PER_DAY
    return f"""
SELECT i + CAST({seed} AS BIGINT) * {R.ID_OFFSET_PER_SEED * R.EVENT_ID_STRIDE} AS id,
       i % {R.NUM_USERS} + 1 AS user_id,
       {pick(R.EVENT_NAMES, f'({k}) % {len(R.EVENT_NAMES)}')} AS event_name,
       TIMESTAMP {q(R.ACTIVITY_START)} + to_seconds((i * {R.EVENT_TS_STEP} + {seed}) % {span}) AS event_timestamp,
       {_props_sql(k)} AS properties
FROM ({ids_sql})
"""


def synth_invoices_sql(ids_sql: str, seed: int = SYNTH_SEED) -> str:
    k = f"(i + {seed})"
    day = f"((i * {R.INVOICE_DAY_STEP} + {seed}) % {R.ACTIVITY_DAYS})"
    statuses = " ".join(f"WHEN {n} THEN {q(s)}" for n, s in enumerate(R.INVOICE_STATUSES))
    return f"""
SELECT i + CAST({seed} AS BIGINT) * {R.ID_OFFSET_PER_SEED * R.INVOICE_ID_STRIDE} AS id,
       i % {R.NUM_USERS} + 1 AS user_id,
       CAST(round(CASE WHEN {k} % 5 < {R.PRICE_LOW_BELOW}
                       THEN {R.PRICE_LOW_BASE} + ({k} % {R.PRICE_LOW_MOD}) * {R.PRICE_LOW_STEP}
                       WHEN {k} % 5 < {R.PRICE_MID_BELOW}
                       THEN {R.PRICE_MID_BASE} + ({k} % {R.PRICE_MID_MOD}) * {R.PRICE_MID_STEP}
                       ELSE {R.PRICE_HIGH_BASE} + ({k} % {R.PRICE_HIGH_MOD}) * {R.PRICE_HIGH_STEP}
                  END, 2) AS DECIMAL(10,2)) AS amount,
       {q(R.CURRENCY)} AS currency,
       CASE {k} % 10 {statuses} ELSE {q(R.INVOICE_STATUS_OTHERWISE)} END AS status,
       {days_after(R.ACTIVITY_START, day)} AS issued_at,
       CASE WHEN {k} % 10 < {len(R.UNPAID_STATUSES)} THEN NULL
            ELSE {days_after(R.ACTIVITY_START, f'{day} + {k} % {R.PAID_LAG_MOD}')} END AS paid_at
FROM ({ids_sql})
"""


def synth_tickets_sql(ids_sql: str, seed: int = SYNTH_SEED) -> str:
    k = f"(i + {seed})"
    day = f"((i * {R.TICKET_DAY_STEP} + {seed}) % {R.ACTIVITY_DAYS})"
    return f"""
SELECT i + CAST({seed} AS BIGINT) * {R.ID_OFFSET_PER_SEED * R.TICKET_ID_STRIDE} AS id,
       i % {R.NUM_USERS} + 1 AS user_id,
       {pick(R.TICKET_SUBJECTS, f'{k} % {len(R.TICKET_SUBJECTS)}')} AS subject,
       {pick(R.TICKET_PRIORITIES, f'{k} % {len(R.TICKET_PRIORITIES)}')} AS priority,
       {pick(R.TICKET_STATUSES, f'{k} % {len(R.TICKET_STATUSES)}')} AS status,
       {days_after(R.ACTIVITY_START, day)} AS created_at,
       CASE WHEN {k} % {len(R.TICKET_STATUSES)} < {_n_open} THEN NULL
            ELSE {days_after(R.ACTIVITY_START, f'{day} + 1 + {k} % {R.RESOLVE_LAG_MOD}')} END AS resolved_at
FROM ({ids_sql})
"""


EVENT_IDS = "SELECT CAST(event_id AS BIGINT) AS i FROM events"
ORDER_IDS = "SELECT CAST(o_orderkey AS BIGINT) AS i FROM orders"

# ---------------------------------------------------------------------------
# ingest, ledger, audit
# ---------------------------------------------------------------------------

INGEST_USERS_REPLACE = RAW_USERS

# two landed batches of the same rows: append keeps both copies
INGEST_APPEND_TWICE = f"SELECT * FROM ({RAW_EVENTS}) UNION ALL SELECT * FROM ({RAW_EVENTS})"

_COUNT_SOURCES = {
    "users": "customer",
    "events": "events",
    "invoices": "orders",
    "support_tickets": f"events WHERE event_type = {q(A.TICKET_SOURCE_EVENT)}",
}

ROW_COUNT_AUDIT = "\nUNION ALL\n".join(
    f"SELECT {q(t)} AS table_name, count(*) AS row_count FROM {src}"
    for t, src in _COUNT_SOURCES.items())

# two full runs: users replaced twice, every activity table appended twice
LOAD_LEDGER = "\nUNION ALL\n".join(
    f"SELECT {q(t)} AS table_name, {q('replace' if t == 'users' else 'append')} AS load_mode, "
    f"2 * count(*) AS rows_loaded FROM {src}"
    for t, src in _COUNT_SOURCES.items())
