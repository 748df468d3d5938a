"""Run all: land -> ingest -> build models, in one Spark application.

Models state their inputs: raw tables (``raw.<table>``) or other models. A SQL model's are the
placeholders of its text, a DataFrame model's are listed beside it. The order of
building follows from that, whatever the order of declaration, and models whose inputs are there are built side by
side::

    raw.users            -> stg_users    ----------------------+--> dim_users
    raw.invoices         -> stg_invoices -> int_revenue_by_user-+    fct_revenue
    raw.support_tickets  -> stg_tickets  -> int_tickets_by_user-+
    raw.events           -> stg_events   -> int_user_events_sessionized
                                         -> fct_daily_active_users

Staging models and ``int_revenue_by_user`` are persistent views; sessions and
marts are tables (``plans.catalog``), rebuilt in full on each run;
``int_tickets_by_user`` is part of the models that use it. ``build`` makes all views and
the tables it is given, ``build_models`` the models it is given with what they need, and no others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from graphlib import CycleError, TopologicalSorter
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from saasmart import schemas
from saasmart.plans import catalog as C
from saasmart.plans import models as M
from saasmart.plans import staging as S
from saasmart.sources import landing as L
from saasmart.streaming import ingest as I

MART_TABLES = ("dim_users", "fct_daily_active_users", "fct_revenue")
SESSIONS = "int_user_events_sessionized"
TABLES = (SESSIONS, *MART_TABLES)


def _concurrently(tasks: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Submit independent Spark jobs from driver threads (they share the cluster)."""
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def land(spark: SparkSession, lake: I.Lake, raw_tables: Mapping[str, DataFrame] | None = None,
         seeds: Sequence[int] | None = None, tag: str | None = None) -> None:
    """Write a landing batch: from given raw-shaped DataFrames, or synthesized."""
    if raw_tables is not None:
        tag = tag or L.batch_tag(0)
        jobs = {t: (lambda t=t: L.write_batch(raw_tables[t], lake.landing, t, tag))
                for t in schemas.ACTIVITY_TABLES}
        jobs["users"] = lambda: L.write_users(raw_tables["users"], lake.landing)
        _concurrently(jobs)
    else:
        L.land_synthetic(spark, lake.landing, seeds or [0])


VIEW, TABLE, PART = "view", "table", "part"
RAW = "raw."


@dataclass(frozen=True)
class Model:
    """How a model is kept (``PART``: only as part of others), what it reads and how it is made.

    ``make`` gets the inputs' DataFrames in the order of ``inputs``; a model with ``text`` is SQL
    with its inputs as placeholders.
    """

    layer: str
    kind: str
    inputs: tuple[str, ...]
    make: Callable[..., DataFrame] | None = None
    text: str | None = None


def sql_inputs(text: str) -> tuple[str, ...]:
    """The names that a SQL model reads: its placeholders, in order."""
    return tuple(dict.fromkeys(name for _, name, _, _ in Formatter().parse(text) if name))


def declared(dau_events: Mapping[str, str] = M.DAU_EVENTS) -> dict[str, Model]:
    """All models by name."""
    def sql(layer: str, kind: str, text: str) -> Model:
        return Model(layer, kind, sql_inputs(text), text=text)

    return {
        "dim_users": Model("marts", TABLE, ("stg_users", "int_revenue_by_user", "int_tickets_by_user"), M.dim_users),
        "fct_revenue": Model("marts", TABLE, ("stg_invoices", "stg_users"), M.fct_revenue),
        "fct_daily_active_users": Model("marts", TABLE, ("stg_events",), partial(M.daily_active_users, counted=dau_events)),
        # a table, not a view: the hot-key slices of sessionize hold for the events they were made from
        SESSIONS: Model("intermediate", TABLE, ("stg_events",), M.user_events_sessionized),
        "int_revenue_by_user": sql("intermediate", VIEW, M.REVENUE_BY_USER_SQL),
        "int_tickets_by_user": sql("intermediate", PART, M.TICKETS_BY_USER_SQL),
        **{name: Model("staging", VIEW, (f"{RAW}{table}",)) for name, (table, _) in S.STAGING.items()},
    }


def _sorter(models: Mapping[str, Model]) -> TopologicalSorter:
    """The models' dependencies, checked: every input is there and none needs itself."""
    for name, model in models.items():
        for source in model.inputs:
            if source not in models and source.removeprefix(RAW) not in schemas.RAW_TABLES:
                raise ValueError(f"{name} reads {source}, which is neither a model nor a raw table")
    sorter = TopologicalSorter({name: [i for i in m.inputs if i in models] for name, m in models.items()})
    try:
        sorter.prepare()
    except CycleError as error:
        raise ValueError("models need each other: " + " -> ".join(reversed(error.args[1]))) from error
    return sorter


def order(models: Mapping[str, Model]) -> list[str]:
    """The models' names, each after what it reads; equal ones by name."""
    sorter, out = _sorter(models), []
    while sorter.is_active():
        ready = sorted(sorter.get_ready())
        out += ready
        sorter.done(*ready)
    return out


def with_upstream(models: Mapping[str, Model], names: Iterable[str]) -> dict[str, Model]:
    """The named models and all that they need."""
    wanted, found = list(names), {}
    while wanted:
        name = wanted.pop()
        if name not in models:
            raise ValueError(f"no model {name}")
        if name not in found:
            found[name] = models[name]
            wanted += [i for i in models[name].inputs if i in models]
    return found


def _make(spark: SparkSession, lake: I.Lake, layers: C.Layers, models: Mapping[str, Model], built: Mapping[str, DataFrame],
          name: str) -> DataFrame:
    model, where = models[name], {n: m.layer for n, m in models.items()}
    layer = getattr(layers, model.layer)
    if model.layer == "staging":
        return C.create_staging_view(spark, layers, name)
    inputs = [built[i] for i in model.inputs]
    if model.text is None:
        df = model.make(*inputs)
    elif model.kind == VIEW:
        return C.create_sql_view(spark, layer, name, model.text, **{i: f"`{getattr(layers, where[i])}`.`{i}`" for i in model.inputs})
    else:
        df = M.sql_model(spark, model.text, **dict(zip(model.inputs, inputs)))
    return C.materialize_table(df, layer, name, lake.warehouse) if model.kind == TABLE else df


def _build(spark: SparkSession, lake: I.Lake, layers: C.Layers, models: Mapping[str, Model]) -> dict[str, DataFrame]:
    """Build the models, each as soon as its inputs are there."""
    C.create_layers(spark, layers, lake.warehouse)
    C.register_raw_tables(spark, layers, lake)
    sorter, out = _sorter(models), {}
    while sorter.is_active():
        ready = sorter.get_ready()
        out.update(_concurrently({name: partial(_make, spark, lake, layers, models, out, name) for name in ready}))
        sorter.done(*ready)
    return out


def build(spark: SparkSession, lake: I.Lake, layers: C.Layers = C.Layers(),
          dau_events: Mapping[str, str] = M.DAU_EVENTS, tables: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    """Create layers and views, then rebuild the named tables."""
    models = declared(dau_events)
    return _build(spark, lake, layers, {n: m for n, m in models.items() if m.kind != TABLE or n in with_upstream(models, tables)})


def build_models(spark: SparkSession, lake: I.Lake, names: Sequence[str], layers: C.Layers = C.Layers(),
                 dau_events: Mapping[str, str] = M.DAU_EVENTS) -> dict[str, DataFrame]:
    """Build the named models and what they need, and nothing else."""
    return _build(spark, lake, layers, with_upstream(declared(dau_events), names))


def run(spark: SparkSession, lake: I.Lake, layers: C.Layers = C.Layers(),
        raw_tables: Mapping[str, DataFrame] | None = None, seeds: Sequence[int] | None = None,
        dau_events: Mapping[str, str] = M.DAU_EVENTS, tables: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    """Land one batch, ingest everything new, rebuild the models."""
    land(spark, lake, raw_tables=raw_tables, seeds=seeds)
    I.ingest_all(spark, lake)
    return build(spark, lake, layers, dau_events, tables)
