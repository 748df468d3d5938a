"""Staging layer: conform raw tables to named columns, renaming the key.

Each model is declared once as (raw table, [(raw column, staged name)]); the
same spec yields the DataFrame projection and the SQL text of the
persistent view, so both stay in step. Catalyst prunes unread columns
through the projection down to the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGING: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "stg_users": ("users", [("id", "user_id"), ("email", "email"), ("full_name", "full_name"),
                            ("plan", "plan"), ("created_at", "created_at"),
                            ("country_code", "country_code")]),
    "stg_events": ("events", [("id", "event_id"), ("user_id", "user_id"),
                              ("event_name", "event_name"),
                              ("event_timestamp", "event_timestamp"),
                              ("properties", "properties")]),
    "stg_invoices": ("invoices", [("id", "invoice_id"), ("user_id", "user_id"),
                                  ("amount", "amount"), ("currency", "currency"),
                                  ("status", "status"), ("issued_at", "issued_at"),
                                  ("paid_at", "paid_at")]),
    "stg_tickets": ("support_tickets", [("id", "ticket_id"), ("user_id", "user_id"),
                                        ("subject", "subject"), ("priority", "priority"),
                                        ("status", "status"), ("created_at", "created_at"),
                                        ("resolved_at", "resolved_at")]),
}


def stage(name: str, raw: DataFrame) -> DataFrame:
    _, cols = STAGING[name]
    return raw.select(*[F.col(src).alias(dst) for src, dst in cols])


def view_sql(name: str, raw_db: str) -> str:
    """``SELECT`` text of the staging view over the catalog table ``raw_db.<table>``."""
    table, cols = STAGING[name]
    items = ", ".join(src if src == dst else f"{src} AS {dst}" for src, dst in cols)
    return f"SELECT {items} FROM `{raw_db}`.`{table}`"


def stg_users(raw_users: DataFrame) -> DataFrame:
    return stage("stg_users", raw_users)


def stg_events(raw_events: DataFrame) -> DataFrame:
    return stage("stg_events", raw_events)


def stg_invoices(raw_invoices: DataFrame) -> DataFrame:
    return stage("stg_invoices", raw_invoices)


def stg_tickets(raw_tickets: DataFrame) -> DataFrame:
    return stage("stg_tickets", raw_tickets)
