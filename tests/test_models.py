"""Model semantics on hand fixtures (branches generated data does not reach)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from saasmart import schemas
from saasmart.plans import models as M
from saasmart.plans import registry
from saasmart.plans import staging as S
from tests.conftest import SF01

D = dt.datetime(2025, 10, 1)


def invoices(spark, rows):
    return S.stg_invoices(spark.createDataFrame(rows, schemas.INVOICES))


def users(spark, ids, plan="pro", country="US"):
    rows = [(i, f"user{i}@x", f"N {i}", plan, D, country) for i in ids]
    return S.stg_users(spark.createDataFrame(rows, schemas.USERS))


def tickets(spark, rows):
    return S.stg_tickets(spark.createDataFrame(rows, schemas.SUPPORT_TICKETS))


def inv(i, user, amount, status, day=D, currency="USD"):
    paid = None if status in ("pending", "failed") else day
    return (i, user, Decimal(amount), currency, status, day, paid)


def test_revenue_by_user_zero_not_null(spark):
    df = invoices(spark, [inv(1, 1, "10.00", "pending"), inv(2, 1, "5.00", "pending"),
                          inv(3, 2, "7.50", "paid"), inv(4, 2, "3.00", "refunded"),
                          inv(5, 2, "9.99", "failed")])
    got = {r.user_id: r for r in M.revenue_by_user(df).collect()}
    assert got[1].total_revenue == 0 and got[1].total_refunded == 0
    assert got[1].total_invoices == 2 and got[1].paid_invoices == 0
    assert got[2].total_invoices == 3 and got[2].paid_invoices == 1
    assert got[2].total_revenue == Decimal("7.50") and got[2].total_refunded == Decimal("3.00")


def test_fct_revenue_null_filters_inner_join_and_currency(spark):
    df = invoices(spark, [inv(1, 1, "4.00", "refunded"), inv(2, 1, "6.00", "paid"),
                          inv(3, 1, "1.00", "paid", currency="EUR"),
                          inv(4, 99, "100.00", "paid")])  # user 99 unknown
    out = M.fct_revenue(df, users(spark, [1])).collect()
    by_status = {r.invoice_status: r for r in out}
    assert set(by_status) == {"refunded", "paid"}
    assert by_status["refunded"].net_revenue is None
    assert by_status["refunded"].refunded_amount == Decimal("4.00")
    assert by_status["paid"].refunded_amount is None
    assert by_status["paid"].net_revenue == Decimal("7.00")  # currencies summed together
    assert by_status["paid"].invoice_count == 2
    assert sum(r.invoice_count for r in out) == 3  # unknown user dropped


def test_dim_users_zeros_and_null_dates(spark):
    u = users(spark, [1, 2])
    inv_df = invoices(spark, [inv(1, 2, "5.00", "paid")])
    t = tickets(spark, [(1, 2, "s", "low", "closed", D, D), (2, 2, "s", "low", "open", D, None)])
    got = {r.user_id: r for r in
           M.dim_users(u, M.revenue_by_user(inv_df), M.tickets_by_user(t)).collect()}
    a = got[1]
    assert (a.lifetime_revenue, a.total_invoices, a.total_tickets, a.resolved_tickets) == (0, 0, 0, 0)
    assert a.first_invoice_at is None and a.last_invoice_at is None
    b = got[2]
    assert (b.total_invoices, b.total_tickets, b.resolved_tickets) == (1, 2, 1)


def test_daily_active_users_days_and_zero_counts(spark):
    rows = [(1, 1, "page_view", D, "{}"), (2, 1, "page_view", D + dt.timedelta(hours=1), "{}"),
            (3, 1, "upgrade", D + dt.timedelta(hours=23, minutes=59, seconds=59), "{}"),
            (4, 2, "logout", D + dt.timedelta(days=1), "{}")]
    ev = S.stg_events(spark.createDataFrame(rows, schemas.EVENTS))
    got = {r.activity_date: r for r in M.daily_active_users(ev).collect()}
    d1, d2 = got[D.date()], got[(D + dt.timedelta(days=1)).date()]
    assert (d1.active_users, d1.total_events, d1.page_views, d1.upgrades, d1.signups) == (1, 3, 2, 1, 0)
    assert (d2.active_users, d2.total_events, d2.page_views) == (1, 1, 0)


def test_conservation_on_test_tables(spark):
    inv_df = registry.stg_invoices(spark, SF01)
    users_df = registry.stg_users(spark, SF01)
    known = inv_df.join(users_df.select("user_id"), "user_id", "left_semi").count()
    fct = registry.fct_revenue(spark, SF01)
    assert fct.agg(F.sum("invoice_count")).first()[0] == known
    ev = registry.stg_events(spark, SF01)
    dau = registry.daily_active_users(spark, SF01)
    assert dau.agg(F.sum("total_events")).first()[0] == ev.count()
    assert registry.dim_users(spark, SF01).count() == users_df.count()
    sess = registry.sessionize(spark, SF01)
    per_user = sess.groupBy("user_id").agg(F.max("session_number").alias("m"),
                                           F.count("*").alias("n"))
    assert per_user.where(F.col("m") > F.col("n")).count() == 0


def test_sql_model_matches_dataframe_model(spark):
    t = registry.stg_tickets(spark, SF01)
    a = M.sql_model(spark, M.TICKETS_BY_USER_SQL, stg_tickets=t)
    b = M.tickets_by_user(t)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_small_trigger_splits_backlog(spark):
    from saasmart.sources import adapters as A
    from saasmart.sources import landing as L
    from saasmart.streaming import ingest as I
    from tests.conftest import SF001
    lake = I.Lake.fresh(spark, "t-trigger")
    ev = A.events(spark, SF001)
    for n in range(3):
        L.write_batch(ev.where(F.col("id") % 3 == n).coalesce(1), lake.landing, "events", str(n))
    I.append_incremental(spark, lake, "events", max_files_per_trigger=1)
    assert I.read_raw(spark, lake, "events").count() == ev.count()
    assert I.read_ledger(spark, lake).count() == 3


def test_fct_revenue_with_hot_and_duplicated_user_equals_direct_join(spark):
    inv = registry.stg_invoices(spark, SF01)
    inv = inv.withColumn("user_id", F.when(F.col("invoice_id") % 3 == 0, F.lit(1))
                         .otherwise(F.col("user_id")))            # a third on user 1
    usr = registry.stg_users(spark, SF01)
    extra = (usr.where(F.col("user_id") == 1)
             .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(49)))).drop("_copy"))
    usr = usr.unionByName(extra)                                  # user 1 copied 50 times
    got = M.fct_revenue(inv, usr)
    direct = (inv.alias("i").join(usr.alias("u"), "user_id")
              .groupBy(F.col("issued_at").alias("revenue_date"), "plan", "country_code",
                       F.col("status").alias("invoice_status"))
              .agg(F.count(F.lit(1)).alias("invoice_count"),
                   F.sum("amount").alias("gross_amount"),
                   F.sum(F.when(F.col("status") == "paid", F.col("amount"))).alias("net_revenue"),
                   F.sum(F.when(F.col("status") == "refunded", F.col("amount")))
                   .alias("refunded_amount")))
    assert sorted(map(tuple, got.collect()), key=repr) == \
        sorted(map(tuple, direct.select(*got.columns).collect()), key=repr)
    assert dict(got.dtypes) == dict(direct.select(*got.columns).dtypes)
