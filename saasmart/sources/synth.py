"""Deterministic SaaS table synthesis as Spark jobs.

Every table is a pure column expression over a row-id column, so generation
is embarrassingly parallel (``spark.range`` splits into as many tasks as the
cluster has slots) and a given (id, seed) always yields the same row.

Two entry styles:

* ``users(spark)`` / ``events(spark, seeds)`` ...: ids from ``spark.range``;
  several batches are one job, the batch number and its seed are columns.
* ``*_from_ids(df, seed)``: apply the same rules to the ids of any DataFrame
  (column ``i``), e.g. ids read from existing tables.

The seed is passed in (the rules are reproducible), never drawn at random.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saasmart import schemas
from saasmart.functions import date_plus_days, dec, pick, timestamp_plus_seconds
from saasmart.sources import rules as R


def _as_col(seed: int | Column) -> Column:
    return seed if isinstance(seed, Column) else F.lit(int(seed)).cast("long")


# ---------------------------------------------------------------------------
# users
# ---------------------------------------------------------------------------

def users_from_ids(ids: DataFrame, id_col: str = "i") -> DataFrame:
    i = F.col(id_col).cast("long")
    plan_bucket = i % R.PLAN_MOD
    plan = (F.when(plan_bucket < R.PLAN_FREE_BELOW, F.lit(R.PLANS[0]))
            .when(plan_bucket < R.PLAN_PRO_BELOW, F.lit(R.PLANS[1]))
            .otherwise(F.lit(R.PLANS[2])))
    return ids.select(
        i.alias("id"),
        F.concat(F.lit("user"), i.cast("string"), F.lit("@"),
                 pick(R.EMAIL_DOMAINS, i % len(R.EMAIL_DOMAINS))).alias("email"),
        F.concat(pick(R.FULL_NAMES, i % len(R.FULL_NAMES)), F.lit(" "),
                 (i % R.NAME_SUFFIX_MOD).cast("string")).alias("full_name"),
        plan.alias("plan"),
        date_plus_days(R.USER_BASE_DATE,
                       -((i * R.CREATED_AT_STEP) % R.CREATED_AT_SPAN_DAYS)).alias("created_at"),
        pick(R.COUNTRY_CODES, i % len(R.COUNTRY_CODES)).alias("country_code"),
    )


def users(spark: SparkSession, n: int = R.NUM_USERS) -> DataFrame:
    return users_from_ids(spark.range(1, n + 1).withColumnRenamed("id", "i"))


# ---------------------------------------------------------------------------
# activity batches
# ---------------------------------------------------------------------------

# Rows of one generated file: a task makes whole batches up to this, or a
# part of one larger batch.
ROWS_PER_FILE = 1_000_000
MIN_ROWS_PER_TASK = 50_000


def _tasks(rows_per_batch: int, batches: int) -> int:
    """Tasks so that each makes at least MIN_ROWS_PER_TASK rows and large batches split evenly."""
    if rows_per_batch >= MIN_ROWS_PER_TASK:
        return batches * -(-rows_per_batch // ROWS_PER_FILE)
    return max(1, batches * rows_per_batch // MIN_ROWS_PER_TASK)


def batch_ids(spark: SparkSession, rows_per_batch: int, seeds: Sequence[int]) -> DataFrame:
    """(batch, seed, i) for every batch: i runs 1..rows_per_batch within a batch.

    The seeds are a table of one row per batch, joined on the batch number.
    """
    n = len(seeds)
    by_batch = spark.createDataFrame(list(enumerate(map(int, seeds))), "batch long, seed long")
    ids = spark.range(0, n * rows_per_batch, 1, _tasks(rows_per_batch, n)).select(
        F.floor(F.col("id") / rows_per_batch).alias("batch"), (F.col("id") % rows_per_batch + 1).alias("i"))
    # one row per batch asked for: tiny beside the rows that the batches make
    return ids.join(F.broadcast(by_batch), "batch").select("batch", "i", "seed")


def _properties(k: Column) -> Column:
    fmt = R.PROPERTIES_FORMATS
    name = k % len(R.EVENT_NAMES)
    return (
        F.when(name == 0, F.format_string(fmt["page_view"],
                                          pick(R.PAGES, k % len(R.PAGES)),
                                          pick(R.REFERRERS, k % len(R.REFERRERS))))
        .when(name == 1, F.format_string(fmt["signup"],
                                         pick(R.SIGNUP_SOURCES, k % len(R.SIGNUP_SOURCES))))
        .when(name == 2, F.format_string(fmt["upgrade"],
                                         pick(R.PAID_PLANS, k % len(R.PAID_PLANS))))
        .when(name == 3, F.format_string(fmt["downgrade"],
                                         pick(R.PAID_PLANS, k % len(R.PAID_PLANS))))
        .when(name == 4, F.format_string(fmt["feature_use"],
                                         pick(R.FEATURES, k % len(R.FEATURES))))
        .otherwise(F.format_string(fmt["logout"],
                                   (k % R.SESSION_DURATION_MOD).cast("string")))
    )


def events_from_ids(ids: DataFrame, seed: int | Column | None = None,
                    id_col: str = "i", keep: Sequence[str] = ()) -> DataFrame:
    i = F.col(id_col).cast("long")
    s = _as_col(seed if seed is not None else F.col("seed"))
    k = i + s
    span = R.ACTIVITY_DAYS * R.SECONDS_PER_DAY
    return ids.select(
        *keep,
        (i + s * R.ID_OFFSET_PER_SEED * R.EVENT_ID_STRIDE).alias("id"),
        (i % R.NUM_USERS + 1).alias("user_id"),
        pick(R.EVENT_NAMES, k % len(R.EVENT_NAMES)).alias("event_name"),
        timestamp_plus_seconds(R.ACTIVITY_START,
                               (i * R.EVENT_TS_STEP + s) % span).alias("event_timestamp"),
        _properties(k).alias("properties"),
    )


def _amount(k: Column) -> Column:
    tier = k % R.PRICE_TIER_MOD
    raw = (F.when(tier < R.PRICE_LOW_BELOW,
                  dec(R.PRICE_LOW_BASE) + (k % R.PRICE_LOW_MOD) * dec(R.PRICE_LOW_STEP))
           .when(tier < R.PRICE_MID_BELOW,
                 dec(R.PRICE_MID_BASE) + (k % R.PRICE_MID_MOD) * dec(R.PRICE_MID_STEP))
           .otherwise(dec(R.PRICE_HIGH_BASE) + (k % R.PRICE_HIGH_MOD) * dec(R.PRICE_HIGH_STEP)))
    return F.round(raw, 2).cast(schemas.MONEY)


def invoices_from_ids(ids: DataFrame, seed: int | Column | None = None,
                      id_col: str = "i", keep: Sequence[str] = ()) -> DataFrame:
    i = F.col(id_col).cast("long")
    s = _as_col(seed if seed is not None else F.col("seed"))
    k = i + s
    status_bucket = k % R.INVOICE_STATUS_MOD
    status = (F.when(status_bucket < len(R.INVOICE_STATUSES),
                     pick(R.INVOICE_STATUSES, status_bucket))
              .otherwise(F.lit(R.INVOICE_STATUS_OTHERWISE)))
    issue_day = (i * R.INVOICE_DAY_STEP + s) % R.ACTIVITY_DAYS
    unpaid = status_bucket < len(R.UNPAID_STATUSES)
    return ids.select(
        *keep,
        (i + s * R.ID_OFFSET_PER_SEED * R.INVOICE_ID_STRIDE).alias("id"),
        (i % R.NUM_USERS + 1).alias("user_id"),
        _amount(k).alias("amount"),
        F.lit(R.CURRENCY).alias("currency"),
        status.alias("status"),
        date_plus_days(R.ACTIVITY_START, issue_day).alias("issued_at"),
        F.when(~unpaid, date_plus_days(R.ACTIVITY_START,
                                       issue_day + k % R.PAID_LAG_MOD)).alias("paid_at"),
    )


def tickets_from_ids(ids: DataFrame, seed: int | Column | None = None,
                     id_col: str = "i", keep: Sequence[str] = ()) -> DataFrame:
    i = F.col(id_col).cast("long")
    s = _as_col(seed if seed is not None else F.col("seed"))
    k = i + s
    day = (i * R.TICKET_DAY_STEP + s) % R.ACTIVITY_DAYS
    status_bucket = k % len(R.TICKET_STATUSES)
    still_open = status_bucket < len(R.OPEN_STATUSES)
    return ids.select(
        *keep,
        (i + s * R.ID_OFFSET_PER_SEED * R.TICKET_ID_STRIDE).alias("id"),
        (i % R.NUM_USERS + 1).alias("user_id"),
        pick(R.TICKET_SUBJECTS, k % len(R.TICKET_SUBJECTS)).alias("subject"),
        pick(R.TICKET_PRIORITIES, k % len(R.TICKET_PRIORITIES)).alias("priority"),
        pick(R.TICKET_STATUSES, status_bucket).alias("status"),
        date_plus_days(R.ACTIVITY_START, day).alias("created_at"),
        F.when(~still_open, date_plus_days(R.ACTIVITY_START,
                                           day + 1 + k % R.RESOLVE_LAG_MOD)).alias("resolved_at"),
    )


def events(spark: SparkSession, seeds: Sequence[int],
           rows_per_batch: int = R.EVENTS_PER_BATCH) -> DataFrame:
    """All batches in one DataFrame; column ``batch`` tells them apart."""
    return events_from_ids(batch_ids(spark, rows_per_batch, seeds), keep=["batch"])


def invoices(spark: SparkSession, seeds: Sequence[int],
             rows_per_batch: int = R.INVOICES_PER_BATCH) -> DataFrame:
    return invoices_from_ids(batch_ids(spark, rows_per_batch, seeds), keep=["batch"])


def support_tickets(spark: SparkSession, seeds: Sequence[int],
                    rows_per_batch: int = R.TICKETS_PER_BATCH) -> DataFrame:
    return tickets_from_ids(batch_ids(spark, rows_per_batch, seeds), keep=["batch"])


GENERATORS = {
    "events": events,
    "invoices": invoices,
    "support_tickets": support_tickets,
}
