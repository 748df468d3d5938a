"""Plan guards: the physical plans keep the properties the scale design relies on."""

import contextlib
import io

import pytest

from saasmart.plans import registry
from tests.conftest import SF01

READ_ONLY = ["stg_users", "stg_events", "stg_invoices", "stg_tickets", "revenue_by_user",
             "tickets_by_user", "sessionize_flags", "sessionize", "sessionize_split",
             "daily_active_users", "fct_revenue", "dim_users", "synth_users",
             "synth_events_batch", "synth_invoices_batch", "synth_tickets_batch"]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", READ_ONLY)
def test_no_cross_or_nested_loop_join(spark, key):
    text = plan(registry.QUERIES[key](spark, SF01))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_dau_prunes_columns_and_has_no_expand(spark):
    text = plan(registry.daily_active_users(spark, SF01))
    assert "Expand" not in text
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert schemas and all("props" not in s and "value" not in s for s in schemas)


def test_fct_revenue_shuffles_once_with_users_broadcast(spark):
    text = plan(registry.fct_revenue(spark, SF01))
    top = text.split("\n\n")[0]  # the operator tree
    assert sum("Exchange" in line and "Broadcast" not in line for line in top.splitlines()) == 1
    assert "BroadcastHashJoin" in top


def test_plain_sessionize_has_one_exchange_on_the_key(spark):
    text = plan(registry.sessionize(spark, SF01))
    exchanges = [l for l in text.splitlines() if l.startswith("Arguments: hashpartitioning")]
    assert len(exchanges) == 1 and "user_id" in exchanges[0]


def test_dim_users_joins_share_one_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(registry.dim_users(spark, SF01))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_user = [l for l in text.splitlines()
               if l.startswith("Arguments: hashpartitioning(") and "user_id" in l]
    # users, invoices (after partial agg) and tickets (after partial agg): one each
    assert len(by_user) == 3


def _exchanges(df) -> list[str]:
    top = plan(df).split("\n\n")[0]
    return [line for line in top.splitlines() if "Exchange" in line]


def test_buckets_by_user_need_no_exchange(spark):
    from saasmart.plans import catalog as C
    from saasmart.plans import models as M
    from saasmart.plans import runner as PL
    from saasmart.streaming import ingest as I
    from tests.conftest import SF001
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lake, layers = registry._loaded(spark, SF001, "t-buckets", batches=2, buckets=4)
        stg = C.create_staging_views(spark, layers)
        revenue, tickets = M.revenue_by_user(stg["stg_invoices"]), M.tickets_by_user(stg["stg_tickets"])
        users = M.dim_users(stg["stg_users"], revenue, tickets)
        assert _exchanges(revenue) == [] == _exchanges(tickets) == _exchanges(users)
        joined = stg["stg_invoices"].join(stg["stg_users"], "user_id")
        assert _exchanges(joined) == []
        # the same rows as without buckets
        plain, plain_layers = registry._loaded(spark, SF001, "t-plain", batches=2)
        other = C.create_staging_views(spark, plain_layers)
        want = M.dim_users(other["stg_users"], M.revenue_by_user(other["stg_invoices"]), M.tickets_by_user(other["stg_tickets"]))
        assert users.count() == want.count() and users.exceptAll(want).count() == 0
        assert len(_exchanges(want)) == 3
        built = PL.build(spark, lake, layers, tables=["dim_users"])["dim_users"]
        assert built.exceptAll(want).count() == 0
        with pytest.raises(ValueError):
            I.set_buckets(spark, lake, 8)
        # a lake without buckets under the same names
        C.register_raw_tables(spark, layers, plain)
        assert spark.table(f"{layers.raw}.invoices").count() == spark.table(f"{plain_layers.raw}.invoices").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
