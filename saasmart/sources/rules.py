"""Fixed values of the deterministic SaaS data generator.

Everything in this module is a fixed value that must stay exactly as it is
for generated tables to match the rules being reproduced: word lists in
their natural order (index = the modulo bucket), thresholds, strides, base
dates and the JSON text formats of event properties.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

NUM_USERS = 2000

# users: email domain by id % 5
EMAIL_DOMAINS = ["gmail.com", "outlook.com", "company.io", "fastmail.com", "proton.me"]

# users: full name by id % 12, followed by ' ' and id % 200
FULL_NAMES = [
    "Alice Johnson",
    "Bob Smith",
    "Carlos Garcia",
    "Diana Chen",
    "Erik Larsson",
    "Fatima Al-Rashid",
    "Grace Kim",
    "Hiroshi Tanaka",
    "Isabella Rossi",
    "James O'Brien",
    "Katarina Novak",
    "Liam Patel",
]
NAME_SUFFIX_MOD = 200

# users: plan by id % 10: below 5 free, below 8 pro, else enterprise
PLAN_MOD = 10
PLAN_FREE_BELOW = 5
PLAN_PRO_BELOW = 8
PLANS = ["free", "pro", "enterprise"]

# users: created_at = 2025-07-01 minus (id * 97 % 730) days
USER_BASE_DATE = "2025-07-01"
CREATED_AT_STEP = 97
CREATED_AT_SPAN_DAYS = 730

# users: country code by id % 8
COUNTRY_CODES = ["US", "GB", "DE", "CA", "AU", "FR", "JP", "BR"]

# activity: rows per batch, id strides per unit of offset (offset = seed * 100)
EVENTS_PER_BATCH = 50000
INVOICES_PER_BATCH = 5000
TICKETS_PER_BATCH = 1500
ID_OFFSET_PER_SEED = 100
EVENT_ID_STRIDE = 500
INVOICE_ID_STRIDE = 5
TICKET_ID_STRIDE = 1

# activity: time base and span
ACTIVITY_START = "2025-10-01"
ACTIVITY_DAYS = 180
SECONDS_PER_DAY = 86400

# events: name by (id + seed) % 6
EVENT_NAMES = ["page_view", "signup", "upgrade", "downgrade", "feature_use", "logout"]
# events: timestamp = 2025-10-01 + ((id * 317 + seed) % (180 * 86400)) seconds
EVENT_TS_STEP = 317
# events: properties values
PAGES = ["home", "pricing", "dashboard", "settings", "docs"]  # (id + seed) % 5
REFERRERS = ["https://google.com", "https://twitter.com", "direct", "https://github.com"]  # % 4
SIGNUP_SOURCES = ["organic", "referral", "paid"]  # % 3
PAID_PLANS = ["pro", "enterprise"]  # % 2
FEATURES = ["export_csv", "create_report", "invite_member", "api_call"]  # % 4
SESSION_DURATION_MOD = 3600
# events: properties JSON text, one format per event name (one space after ':' and ',')
PROPERTIES_FORMATS = {
    "page_view": '{"page": "/%s", "referrer": "%s"}',
    "signup": '{"source": "%s"}',
    "upgrade": '{"from_plan": "free", "to_plan": "%s"}',
    "downgrade": '{"from_plan": "%s", "to_plan": "free"}',
    "feature_use": '{"feature": "%s"}',
    "logout": '{"session_duration_sec": %s}',
}

# invoices: amount tier by (id + seed) % 5: below 3 low, below 4 mid, else high
PRICE_TIER_MOD = 5
PRICE_LOW_BELOW = 3
PRICE_MID_BELOW = 4
PRICE_LOW_BASE, PRICE_LOW_MOD, PRICE_LOW_STEP = "9.99", 20, "0.5"
PRICE_MID_BASE, PRICE_MID_MOD, PRICE_MID_STEP = "49.99", 50, "1"
PRICE_HIGH_BASE, PRICE_HIGH_MOD, PRICE_HIGH_STEP = "199.99", 100, "2"
CURRENCY = "USD"
# invoices: status by (id + seed) % 10: 0 pending, 1 failed, 2 refunded, else paid
INVOICE_STATUS_MOD = 10
INVOICE_STATUSES = ["pending", "failed", "refunded"]
INVOICE_STATUS_OTHERWISE = "paid"
UNPAID_STATUSES = ["pending", "failed"]  # paid_at is NULL for these
# invoices: issued_at = 2025-10-01 + ((id * 131 + seed) % 180) days;
#           paid_at = issued_at + ((id + seed) % 14) days
INVOICE_DAY_STEP = 131
PAID_LAG_MOD = 14

# tickets: subject by (id + seed) % 8
TICKET_SUBJECTS = [
    "Cannot export data",
    "Billing discrepancy",
    "Login issues after upgrade",
    "Feature request: dark mode",
    "API rate limit too low",
    "Dashboard not loading",
    "Team invitation failed",
    "Data sync delay",
]
# tickets: priority and status by (id + seed) % 4
TICKET_PRIORITIES = ["low", "medium", "high", "critical"]
TICKET_STATUSES = ["open", "in_progress", "resolved", "closed"]
OPEN_STATUSES = ["open", "in_progress"]  # resolved_at is NULL for these
RESOLVED_STATUSES = ["resolved", "closed"]
# tickets: created_at = 2025-10-01 + ((id * 73 + seed) % 180) days;
#          resolved_at = created_at + 1 + ((id + seed) % 7) days
TICKET_DAY_STEP = 73
RESOLVE_LAG_MOD = 7

# sessionization: a gap strictly greater than this starts a new session
SESSION_GAP_SECONDS = 30 * 60
