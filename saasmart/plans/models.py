"""Intermediate and mart models as DataFrame functions.

Every model is ``(upstream DataFrames...) -> DataFrame``; nothing runs until
an action, so staging views and intermediates fold into each mart's plan and
Catalyst prunes columns through all of them down to the scans.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saasmart.functions import count_where, sum_where, sum_where_or_zero
from saasmart.operators.sessionize import sessionize
from saasmart.sources import rules as R

PAID = "paid"
REFUNDED = "refunded"

# DAU conditional counts: output column -> event name counted.
DAU_EVENTS = {
    "page_views": "page_view",
    "signups": "signup",
    "upgrades": "upgrade",
    "downgrades": "downgrade",
}


def revenue_by_user(stg_invoices: DataFrame) -> DataFrame:
    """One row per user: invoice counts, paid / refunded sums (0 if none), first / last issue."""
    status = F.col("status")
    amount = F.col("amount")
    return stg_invoices.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_invoices"),
        count_where(status == PAID).alias("paid_invoices"),
        sum_where_or_zero(amount, status == PAID).alias("total_revenue"),
        sum_where_or_zero(amount, status == REFUNDED).alias("total_refunded"),
        F.min("issued_at").alias("first_invoice_at"),
        F.max("issued_at").alias("last_invoice_at"),
    )


def tickets_by_user(stg_tickets: DataFrame) -> DataFrame:
    """One row per user: tickets and resolved-or-closed tickets."""
    return stg_tickets.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        count_where(F.col("status").isin(*R.RESOLVED_STATUSES)).alias("resolved_tickets"),
    )


def user_events_sessionized(stg_events: DataFrame, gap_seconds: int = R.SESSION_GAP_SECONDS,
                            with_flags: bool = False, **split) -> DataFrame:
    """Events with a 1-based session number per user (gap > 30 min starts a new one).

    ``event_id`` breaks ties on equal timestamps so the numbering is
    deterministic. ``with_flags`` keeps ``prev_event_at`` and ``is_new_session``.
    ``split`` passes hot-key settings (``parallelism``, ``min_slice_rows``).
    """
    out = sessionize(stg_events, key="user_id", ts="event_timestamp", tiebreak="event_id",
                     gap_seconds=gap_seconds, **split)
    cols = ["event_id", "user_id", "event_name", "event_timestamp", "properties"]
    if with_flags:
        return out.select(*cols, "prev_event_at", "is_new_session")
    return out.select(*cols, "session_number")


def daily_active_users(stg_events: DataFrame,
                       counted: Mapping[str, str] = DAU_EVENTS) -> DataFrame:
    """Per calendar day: distinct users, all events, and one count per named event."""
    name = F.col("event_name")
    return stg_events.groupBy(F.to_date("event_timestamp").alias("activity_date")).agg(
        F.countDistinct("user_id").alias("active_users"),
        F.count(F.lit(1)).alias("total_events"),
        *[count_where(name == event).alias(col) for col, event in counted.items()],
    )


def fct_revenue(stg_invoices: DataFrame, stg_users: DataFrame) -> DataFrame:
    """Invoices by issue date x plan x country x status (inner join: unknown users drop).

    ``net_revenue`` is the paid sum and ``refunded_amount`` the refunded sum;
    both are NULL on groups of any other status. With users broadcast only the
    partial sums are shuffled; else AQE splits the join's partition of a hot user.
    """
    status, amount = F.col("status"), F.col("amount")
    users = stg_users.select("user_id", "plan", "country_code")
    return stg_invoices.join(users, "user_id").groupBy(
        F.col("issued_at").alias("revenue_date"), "plan", "country_code", F.col("status").alias("invoice_status")).agg(
        F.count(F.lit(1)).alias("invoice_count"),
        F.sum("amount").alias("gross_amount"),
        sum_where(amount, status == PAID).alias("net_revenue"),
        sum_where(amount, status == REFUNDED).alias("refunded_amount"))


def dim_users(stg_users: DataFrame, revenue: DataFrame, tickets: DataFrame) -> DataFrame:
    """Every user with lifetime revenue and support history (0 when none, dates stay NULL).

    Both right sides are one row per user and hash-partitioned on user_id by
    their aggregation, so the two left joins share one partitioning.
    """
    r = revenue.select("user_id", "total_revenue", "total_invoices",
                       "first_invoice_at", "last_invoice_at")
    t = tickets.select("user_id", "total_tickets", "resolved_tickets")
    zero = F.lit(0)
    return (stg_users.join(r, "user_id", "left").join(t, "user_id", "left")
            .select("user_id", "email", "full_name", "plan", "created_at", "country_code",
                    F.coalesce("total_revenue", zero).alias("lifetime_revenue"),
                    F.coalesce("total_invoices", zero).alias("total_invoices"),
                    "first_invoice_at", "last_invoice_at",
                    F.coalesce("total_tickets", zero).alias("total_tickets"),
                    F.coalesce("resolved_tickets", zero).alias("resolved_tickets")))


def sql_model(spark: SparkSession, text: str, **upstream: DataFrame) -> DataFrame:
    """A model written in SQL: ``{name}`` placeholders bind upstream DataFrames.

    Same plan as the DataFrame form; Catalyst optimizes across the boundary.
    """
    return spark.sql(text, **upstream)


# int_revenue_by_user as the SQL model that the build makes a view of
REVENUE_BY_USER_SQL = """
SELECT user_id,
       count(*) AS total_invoices,
       count_if(status = 'paid') AS paid_invoices,
       coalesce(sum(amount) FILTER (WHERE status = 'paid'), 0) AS total_revenue,
       coalesce(sum(amount) FILTER (WHERE status = 'refunded'), 0) AS total_refunded,
       min(issued_at) AS first_invoice_at,
       max(issued_at) AS last_invoice_at
FROM {stg_invoices}
GROUP BY user_id
"""

# tickets_by_user written as a SQL model (the two forms are tested to agree)
TICKETS_BY_USER_SQL = """
SELECT user_id,
       count(*) AS total_tickets,
       count_if(status IN ('resolved', 'closed')) AS resolved_tickets
FROM {stg_tickets}
GROUP BY user_id
"""
