"""Map the driver's star-schema test tables onto the four raw SaaS tables.

| domain table    | from                                                   |
|-----------------|--------------------------------------------------------|
| users           | customer LEFT JOIN nation                              |
| events          | events                                                 |
| invoices        | orders (status F->paid, O->pending, P->refunded)       |
| support_tickets | events of type 'error'                                 |

Each function returns a DataFrame with the raw schema of ``saasmart.schemas``.
All of them are scans plus column expressions; the only join is against
``nation`` (25 rows), which Catalyst broadcasts after its own size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saasmart import schemas
from saasmart.functions import date_plus_days, pick
from saasmart.sources import rules as R

# Fixed mapping of order status onto invoice status.
ORDER_STATUS_TO_INVOICE = {"F": "paid", "O": "pending", "P": "refunded"}
UNKNOWN_ORDER_STATUS = "failed"
TICKET_SOURCE_EVENT = "error"
USER_EMAIL_DOMAIN = "example.com"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").alias("c")
    n = table(spark, sf_dir, "nation").alias("n")
    key = F.col("c.c_custkey").cast("long")
    return (c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"), "left")
            .select(
                key.alias("id"),
                F.concat(F.lit("user"), key.cast("string"), F.lit("@" + USER_EMAIL_DOMAIN)).alias("email"),
                F.col("c.c_name").alias("full_name"),
                F.col("c.c_mktsegment").alias("plan"),
                date_plus_days(R.USER_BASE_DATE,
                               -((key * R.CREATED_AT_STEP) % R.CREATED_AT_SPAN_DAYS)).alias("created_at"),
                F.col("n.n_name").alias("country_code"),
            ))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("long").alias("id"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("event_type").alias("event_name"),
        F.col("ts").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("props").alias("properties"),
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    status = F.lit(UNKNOWN_ORDER_STATUS)
    for code, name in reversed(list(ORDER_STATUS_TO_INVOICE.items())):
        status = F.when(F.col("o_orderstatus") == code, F.lit(name)).otherwise(status)
    issued = F.col("o_orderdate").cast("timestamp_ntz")
    return (o.select(
                F.col("o_orderkey").cast("long").alias("id"),
                F.col("o_custkey").cast("long").alias("user_id"),
                F.col("o_totalprice").cast(schemas.MONEY).alias("amount"),
                F.lit(R.CURRENCY).alias("currency"),
                status.alias("status"),
                issued.alias("issued_at"),
            )
            .withColumn("paid_at", F.when(~F.col("status").isin(*R.UNPAID_STATUSES),
                                          F.col("issued_at"))))


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type") == TICKET_SOURCE_EVENT)
    eid = F.col("event_id").cast("long")
    status = pick(R.TICKET_STATUSES, eid % len(R.TICKET_STATUSES))
    created = F.col("ts").cast("timestamp_ntz")
    return (e.select(
                eid.alias("id"),
                F.col("user_id").cast("long").alias("user_id"),
                pick(R.TICKET_SUBJECTS, eid % len(R.TICKET_SUBJECTS)).alias("subject"),
                pick(R.TICKET_PRIORITIES, eid % len(R.TICKET_PRIORITIES)).alias("priority"),
                status.alias("status"),
                created.alias("created_at"),
                (eid % R.RESOLVE_LAG_MOD + 1).alias("_lag"),
            )
            .withColumn("resolved_at",
                        F.when(~F.col("status").isin(*R.OPEN_STATUSES),
                               F.timestamp_add("DAY", F.col("_lag"), F.col("created_at"))))
            .drop("_lag"))


RAW_ADAPTERS = {
    "users": users,
    "events": events,
    "invoices": invoices,
    "support_tickets": support_tickets,
}
