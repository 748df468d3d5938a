"""Models are built in the order of what they read, whatever the order of declaration."""

import random

import pytest

from saasmart.plans import audit
from saasmart.plans import catalog as C
from saasmart.plans import runner as PL
from saasmart.plans import registry
from saasmart.streaming import ingest as I
from tests.conftest import SF001
from tests.test_plans import plan


def test_order_does_not_depend_on_declaration():
    models = PL.declared()
    rng, want = random.Random(1), PL.order(models)
    for _ in range(20):
        names = list(models)
        rng.shuffle(names)
        assert PL.order({n: models[n] for n in names}) == want
    for name, model in models.items():
        assert all(want.index(i) < want.index(name) for i in model.inputs if i in models)


def test_sql_models_read_their_placeholders():
    assert PL.sql_inputs("select * from {a} join {b} using (x) join {a} as again") == ("a", "b")
    assert PL.declared()["int_revenue_by_user"].inputs == ("stg_invoices",)


def test_cycles_and_unknown_inputs_are_named():
    part = lambda *inputs: PL.Model("marts", PL.PART, inputs, lambda *a: a[0])
    with pytest.raises(ValueError, match="a -> b -> c -> a|b -> c -> a -> b|c -> a -> b -> c"):
        PL.order({"a": part("b"), "b": part("c"), "c": part("a"), "d": part("a")})
    with pytest.raises(ValueError, match="d reads nothing_here"):
        PL.order({"d": part("nothing_here")})
    with pytest.raises(ValueError, match="raw.other"):
        PL.order({"d": part("raw.other")})
    with pytest.raises(ValueError, match="no model x"):
        PL.with_upstream(PL.declared(), ["x"])


def test_upstream_of_one_model():
    assert set(PL.with_upstream(PL.declared(), ["dim_users"])) == {
        "dim_users", "stg_users", "stg_invoices", "stg_tickets", "int_revenue_by_user", "int_tickets_by_user"}


def test_a_chosen_model_is_built_with_what_it_needs_alone(spark):
    lake, layers = registry._loaded(spark, SF001, "d-select")
    built = PL.build_models(spark, lake, ["fct_revenue"], layers)
    assert set(built) == {"fct_revenue", "stg_invoices", "stg_users"}
    assert {t.name for t in spark.catalog.listTables(layers.staging) if not t.isTemporary} == {"stg_invoices", "stg_users"}
    assert {t.name for t in spark.catalog.listTables(layers.marts) if not t.isTemporary} == {"fct_revenue", "fct_revenue__v1"}


def test_recorded_counts_equal_the_tables_and_read_none(spark):
    lake, layers = registry._loaded(spark, SF001, "d-audit", batches=2)
    generations = {t: I.generation(spark, lake, t) for t in ("users", "events", "invoices", "support_tickets")}
    counted = audit.recorded_counts(spark.table(f"{layers.raw}.{C.LEDGER_TABLE}"), generations)
    want = {t: spark.table(f"{layers.raw}.{t}").count() for t in generations}
    assert {r.table_name: r.row_count for r in counted.collect()} == want
    scans = [line for line in plan(counted).splitlines() if line.startswith(("Location", "ReadSchema"))]
    assert all("ledger" in line for line in scans if line.startswith("Location"))
    empty = I.Lake.fresh(spark, "d-empty")
    none = audit.recorded_counts(I.read_ledger(spark, empty), {"users": I.FIRST_GENERATION})
    assert [tuple(r) for r in none.collect()] == [("users", 0)]
