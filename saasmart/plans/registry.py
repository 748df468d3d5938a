"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They read the driver's test tables through ``saasmart.sources.adapters`` so
that their work grows with those tables. ``saasmart.oracle`` holds the SQL
rendering of each key for the DuckDB comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saasmart import oracle as O
from saasmart import schemas
from saasmart.plans import audit
from saasmart.plans import catalog as C
from saasmart.plans import models as M
from saasmart.plans import runner as PL
from saasmart.plans import staging as S
from saasmart.plans import state
from saasmart.sources import adapters as A
from saasmart.sources import landing as L
from saasmart.sources import synth
from saasmart.streaming import ingest as I

Query = Callable[[SparkSession, str], DataFrame]


def stg_users(spark: SparkSession, sf: str) -> DataFrame:
    return S.stg_users(A.users(spark, sf))


def stg_events(spark: SparkSession, sf: str) -> DataFrame:
    return S.stg_events(A.events(spark, sf))


def stg_invoices(spark: SparkSession, sf: str) -> DataFrame:
    return S.stg_invoices(A.invoices(spark, sf))


def stg_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return S.stg_tickets(A.support_tickets(spark, sf))


def revenue_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return M.revenue_by_user(stg_invoices(spark, sf))


def tickets_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return M.tickets_by_user(stg_tickets(spark, sf))


def sessionize_flags(spark: SparkSession, sf: str) -> DataFrame:
    return M.user_events_sessionized(stg_events(spark, sf), with_flags=True)


def sessionize(spark: SparkSession, sf: str) -> DataFrame:
    return M.user_events_sessionized(stg_events(spark, sf))


# Split plan as sized for a wide cluster: 512 target tasks and no row floor,
# so every test user counts as hot and is cut into slices that are fixed up.
WIDE_SPLIT = {"parallelism": 512, "min_slice_rows": 1}


def sessionize_split(spark: SparkSession, sf: str) -> DataFrame:
    return M.user_events_sessionized(stg_events(spark, sf), **WIDE_SPLIT)


def daily_active_users(spark: SparkSession, sf: str) -> DataFrame:
    return M.daily_active_users(stg_events(spark, sf), O.TEST_DAU_EVENTS)


def fct_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return M.fct_revenue(stg_invoices(spark, sf), stg_users(spark, sf))


def dim_users(spark: SparkSession, sf: str) -> DataFrame:
    return M.dim_users(stg_users(spark, sf), revenue_by_user(spark, sf),
                       tickets_by_user(spark, sf))


def _ids(spark: SparkSession, sf: str, table: str, column: str) -> DataFrame:
    return A.table(spark, sf, table).select(F.col(column).cast("long").alias("i"))


def synth_users(spark: SparkSession, sf: str) -> DataFrame:
    return synth.users_from_ids(_ids(spark, sf, "customer", "c_custkey"))


def synth_events_batch(spark: SparkSession, sf: str) -> DataFrame:
    return synth.events_from_ids(_ids(spark, sf, "events", "event_id"), O.SYNTH_SEED)


def synth_invoices_batch(spark: SparkSession, sf: str) -> DataFrame:
    return synth.invoices_from_ids(_ids(spark, sf, "orders", "o_orderkey"), O.SYNTH_SEED)


def synth_tickets_batch(spark: SparkSession, sf: str) -> DataFrame:
    return synth.tickets_from_ids(_ids(spark, sf, "events", "event_id"), O.SYNTH_SEED)


def _raw_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {t: A.RAW_ADAPTERS[t](spark, sf) for t in schemas.RAW_TABLES}


def ingest_users_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Land and load users twice by replace: one copy remains."""
    lake = I.Lake.fresh(spark, "ingest-replace")
    users = A.users(spark, sf)
    for _ in range(2):
        L.write_users(users, lake.landing)
        I.replace_load(spark, lake, "users")
    return I.read_raw(spark, lake, "users")


def ingest_append_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches of events, drained by the file stream (with a rerun in between)."""
    lake = I.Lake.fresh(spark, "ingest-append")
    events = A.events(spark, sf)
    for n in range(2):
        L.write_batch(events, lake.landing, "events", L.batch_tag(n))
        I.append_incremental(spark, lake, "events")
        I.append_incremental(spark, lake, "events")  # nothing new: loads nothing
    return I.read_raw(spark, lake, "events")


def ingest_append_mtime(spark: SparkSession, sf: str) -> DataFrame:
    """Same two batches through the modification-time cursor (batch form)."""
    lake = I.Lake.fresh(spark, "ingest-mtime")
    events = A.events(spark, sf)
    for n in range(2):
        L.write_batch(events, lake.landing, "events", L.batch_tag(n))
        I.append_by_mtime(spark, lake, "events")
        I.append_by_mtime(spark, lake, "events")  # nothing newer: loads nothing
    return I.read_raw(spark, lake, "events")


def _new_lake(spark: SparkSession, name: str) -> tuple[I.Lake, C.Layers]:
    lake = I.Lake.fresh(spark, name)
    return lake, C.Layers.suffixed(lake.root.rsplit("-", 1)[-1])


def _loaded(spark: SparkSession, sf: str, name: str, batches: int = 1, buckets: int = 0) -> tuple[I.Lake, C.Layers]:
    """A new lake with all four tables landed and ingested, so many times."""
    lake, layers = _new_lake(spark, name)
    if buckets:
        I.set_buckets(spark, lake, buckets)
    raw = _raw_tables(spark, sf)
    for n in range(batches):
        PL.land(spark, lake, raw_tables=raw, tag=L.batch_tag(n))
        I.ingest_all(spark, lake)
    C.create_layers(spark, layers, lake.warehouse)
    C.register_raw_tables(spark, layers, lake)
    return lake, layers


def load_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Two full ingests of all four tables; rows per table and mode from the ledger table."""
    _, layers = _loaded(spark, sf, "ledger", batches=2)
    return audit.ledger_totals(spark.table(f"`{layers.raw}`.`{C.LEDGER_TABLE}`"))


def row_count_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Land and ingest, then count the raw tables from the catalog's load ledger."""
    lake, layers = _loaded(spark, sf, "audit")
    return audit.recorded_counts(spark.table(f"`{layers.raw}`.`{C.LEDGER_TABLE}`"),
                                 {t: I.generation(spark, lake, t) for t in schemas.RAW_TABLES})


def row_count_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Land and ingest, then count the raw tables of the catalog themselves."""
    _, layers = _loaded(spark, sf, "audit-scan")
    return audit.row_counts({t: spark.table(f"`{layers.raw}`.`{t}`") for t in schemas.RAW_TABLES})


def _in_batches(spark: SparkSession, sf: str, name: str, table: str, update, batches: int = 3) -> I.Lake:
    """A new lake with users, and one table landed in batches; ``update`` runs after each ingest."""
    lake = I.Lake.fresh(spark, name)
    raw = _raw_tables(spark, sf)
    L.write_users(raw["users"], lake.landing)
    I.replace_load(spark, lake)
    for n in range(batches):
        # not by time, so that later batches bring days and users of earlier ones
        L.write_batch(raw[table].where(F.pmod(F.xxhash64("id"), F.lit(batches)) == n), lake.landing, table, L.batch_tag(n))
        I.append_incremental(spark, lake, table)
        update(lake)
    return lake


def daily_active_users_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The daily-active-users mart from bitmaps per load, after three loads."""
    lake = _in_batches(spark, sf, "daily", "events", lambda lake: state.DailyUsers(spark, lake).update())
    return state.DailyUsers(spark, lake).read(O.TEST_DAU_EVENTS)


def fct_revenue_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The revenue fact from partial sums per load, after three loads."""
    lake = _in_batches(spark, sf, "revenue", "invoices", lambda lake: state.Revenue(spark, lake).update())
    return state.Revenue(spark, lake).read()


def sessionize_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Session numbers carried over three loads, each with events from before and after the others'."""
    lake = _in_batches(spark, sf, "sessions", "events", lambda lake: state.Sessions(spark, lake).update())
    return state.Sessions(spark, lake).read()


def build_selected(spark: SparkSession, sf: str) -> DataFrame:
    """One chosen model, built with what it needs."""
    lake, layers = _loaded(spark, sf, "select")
    return PL.build_models(spark, lake, ["dim_users"], layers)["dim_users"]


def mart_materialize(spark: SparkSession, sf: str) -> DataFrame:
    """A mart table, first with fewer columns, then replaced: read back from the catalog."""
    lake, layers = _loaded(spark, sf, "marts")
    stg = C.create_staging_views(spark, layers)
    early = M.fct_revenue(stg["stg_invoices"], stg["stg_users"]).drop("net_revenue")
    C.materialize_table(early, layers.marts, "fct_revenue", lake.warehouse)
    PL.build(spark, lake, layers, O.TEST_DAU_EVENTS, tables=["fct_revenue"])
    return spark.table(f"`{layers.marts}`.`fct_revenue`")


def mart_drop_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """A mart dropped (twice: the second time there is none) and built again."""
    lake, layers = _loaded(spark, sf, "drop")
    PL.build(spark, lake, layers, tables=["dim_users"])
    for _ in range(2):
        C.drop_table(spark, layers.marts, "dim_users", lake.warehouse)
    PL.build(spark, lake, layers, tables=["dim_users"])
    return spark.table(f"`{layers.marts}`.`dim_users`")


def dim_users_colocated(spark: SparkSession, sf: str) -> DataFrame:
    """The user dimension as a mart of a lake in buckets, read back from the catalog."""
    lake, layers = _loaded(spark, sf, "buckets", buckets=8)
    PL.build(spark, lake, layers, tables=["dim_users"])
    return spark.table(f"`{layers.marts}`.`dim_users`")


def int_revenue_view(spark: SparkSession, sf: str) -> DataFrame:
    """The revenue-by-user view of the intermediate layer, from the catalog."""
    lake, layers = _loaded(spark, sf, "int-view")
    PL.build(spark, lake, layers, tables=[])
    return spark.table(f"`{layers.intermediate}`.`int_revenue_by_user`")


def int_sessions_table(spark: SparkSession, sf: str) -> DataFrame:
    """The sessions table of the intermediate layer, from the catalog."""
    lake, layers = _loaded(spark, sf, "int-table")
    PL.build(spark, lake, layers, tables=[PL.SESSIONS])
    return spark.table(f"`{layers.intermediate}`.`{PL.SESSIONS}`")


def run_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Land -> ingest -> build all; the daily-active-users mart."""
    lake, layers = _new_lake(spark, "run")
    marts = PL.run(spark, lake, layers, raw_tables=_raw_tables(spark, sf),
                   dau_events=O.TEST_DAU_EVENTS)
    return marts["fct_daily_active_users"]


QUERIES: dict[str, Query] = {
    "stg_users": stg_users,
    "stg_events": stg_events,
    "stg_invoices": stg_invoices,
    "stg_tickets": stg_tickets,
    "revenue_by_user": revenue_by_user,
    "tickets_by_user": tickets_by_user,
    "sessionize_flags": sessionize_flags,
    "sessionize": sessionize,
    "sessionize_split": sessionize_split,
    "daily_active_users": daily_active_users,
    "fct_revenue": fct_revenue,
    "dim_users": dim_users,
    "synth_users": synth_users,
    "synth_events_batch": synth_events_batch,
    "synth_invoices_batch": synth_invoices_batch,
    "synth_tickets_batch": synth_tickets_batch,
    "dim_users_colocated": dim_users_colocated,
    "ingest_users_replace": ingest_users_replace,
    "ingest_append_incremental": ingest_append_incremental,
    "ingest_append_mtime": ingest_append_mtime,
    "load_ledger": load_ledger,
    "row_count_audit": row_count_audit,
    "row_count_scan": row_count_scan,
    "daily_active_users_merged": daily_active_users_merged,
    "fct_revenue_merged": fct_revenue_merged,
    "sessionize_batches": sessionize_batches,
    "build_selected": build_selected,
    "mart_materialize": mart_materialize,
    "mart_drop_rebuild": mart_drop_rebuild,
    "int_revenue_view": int_revenue_view,
    "int_sessions_table": int_sessions_table,
    "run_end_to_end": run_end_to_end,
}

ORACLE_SQL: dict[str, str] = {
    "stg_users": O.STG_USERS,
    "stg_events": O.STG_EVENTS,
    "stg_invoices": O.STG_INVOICES,
    "stg_tickets": O.STG_TICKETS,
    "revenue_by_user": O.REVENUE_BY_USER,
    "tickets_by_user": O.TICKETS_BY_USER,
    "sessionize_flags": O.SESSIONIZE_FLAGS,
    "sessionize": O.SESSIONIZE,
    "sessionize_split": O.SESSIONIZE,
    "daily_active_users": O.DAILY_ACTIVE_USERS,
    "fct_revenue": O.FCT_REVENUE,
    "dim_users": O.DIM_USERS,
    "synth_users": O.SYNTH_USERS,
    "synth_events_batch": O.synth_events_sql(O.EVENT_IDS),
    "synth_invoices_batch": O.synth_invoices_sql(O.ORDER_IDS),
    "synth_tickets_batch": O.synth_tickets_sql(O.EVENT_IDS),
    "dim_users_colocated": O.DIM_USERS,
    "ingest_users_replace": O.INGEST_USERS_REPLACE,
    "ingest_append_incremental": O.INGEST_APPEND_TWICE,
    "ingest_append_mtime": O.INGEST_APPEND_TWICE,
    "load_ledger": O.LOAD_LEDGER,
    "row_count_audit": O.ROW_COUNT_AUDIT,
    "row_count_scan": O.ROW_COUNT_AUDIT,
    "daily_active_users_merged": O.DAILY_ACTIVE_USERS,
    "fct_revenue_merged": O.FCT_REVENUE,
    "sessionize_batches": O.SESSIONIZE,
    "build_selected": O.DIM_USERS,
    "mart_materialize": O.FCT_REVENUE,
    "mart_drop_rebuild": O.DIM_USERS,
    "int_revenue_view": O.REVENUE_BY_USER,
    "int_sessions_table": O.SESSIONIZE,
    "run_end_to_end": O.DAILY_ACTIVE_USERS,
}
