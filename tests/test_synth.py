"""Generator rules: invariants and an independent DuckDB rendering."""

import duckdb
from pyspark.sql import functions as F

from saasmart import oracle as O
from saasmart.sources import rules as R
from saasmart.sources import synth


def _rows(pdf):
    return sorted(tuple(None if v != v else v for v in r) for r in
                  pdf.astype(object).itertuples(index=False, name=None))


def test_users_match_duckdb_rendering(spark):
    got = synth.users(spark).toPandas()
    sql = O.SYNTH_USERS.replace("(SELECT CAST(c_custkey AS BIGINT) AS i FROM customer)",
                                f"(SELECT i FROM range(1, {R.NUM_USERS + 1}) t(i))")
    exp = duckdb.sql(sql).df()
    assert len(got) == R.NUM_USERS
    got["created_at"] = got["created_at"].astype("datetime64[us]")
    exp["created_at"] = exp["created_at"].astype("datetime64[us]")
    assert _rows(got[sorted(got.columns)]) == _rows(exp[sorted(exp.columns)])


def test_batches_match_duckdb_rendering_seed0(spark):
    ids = f"SELECT i FROM range(1, {R.INVOICES_PER_BATCH + 1}) t(i)"
    got = synth.invoices(spark, [0]).drop("batch").toPandas()
    exp = duckdb.sql(O.synth_invoices_sql(ids, seed=0)).df()
    for c in ("issued_at", "paid_at"):
        got[c] = got[c].astype("datetime64[us]")
        exp[c] = exp[c].astype("datetime64[us]")
    got["amount"] = got["amount"].astype(float)
    assert _rows(got[sorted(got.columns)]) == _rows(exp[sorted(exp.columns)])

    ids = f"SELECT i FROM range(1, {R.TICKETS_PER_BATCH + 1}) t(i)"
    got = synth.support_tickets(spark, [0]).drop("batch").toPandas()
    exp = duckdb.sql(O.synth_tickets_sql(ids, seed=0)).df()
    for c in ("created_at", "resolved_at"):
        got[c] = got[c].astype("datetime64[us]")
        exp[c] = exp[c].astype("datetime64[us]")
    assert _rows(got[sorted(got.columns)]) == _rows(exp[sorted(exp.columns)])


def test_event_invariants(spark):
    ev = synth.events(spark, [7, 11])
    assert ev.count() == 2 * R.EVENTS_PER_BATCH
    assert ev.where(F.col("batch") == 1).count() == R.EVENTS_PER_BATCH
    names = {r[0] for r in ev.select("event_name").distinct().collect()}
    assert names == set(R.EVENT_NAMES)
    # within one batch a user's events are far apart (>= 336,000 s)
    one = ev.where(F.col("batch") == 0)
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("event_timestamp")
    gaps = one.withColumn("g", F.unix_timestamp(F.col("event_timestamp").cast("timestamp"))
                          - F.unix_timestamp(F.lag("event_timestamp").over(w).cast("timestamp")))
    assert gaps.agg(F.min("g")).first()[0] >= 336000
    props = {r.event_name: r.properties for r in ev.where(F.col("batch") == 0)
             .groupBy("event_name").agg(F.first("properties").alias("properties")).collect()}
    assert props["logout"].startswith('{"session_duration_sec": ')
    assert props["page_view"].startswith('{"page": "/')


def test_paid_and_resolved_null_rules(spark):
    inv = synth.invoices(spark, [3])
    bad = inv.where((F.col("status").isin("pending", "failed")) != F.col("paid_at").isNull())
    assert bad.count() == 0
    assert inv.select("currency").distinct().count() == 1
    t = synth.support_tickets(spark, [3])
    bad = t.where((F.col("status").isin("open", "in_progress")) != F.col("resolved_at").isNull())
    assert bad.count() == 0
    # ticket ids of two seeds 1 apart overlap (ids are not unique across batches)
    two = synth.support_tickets(spark, [1, 2])
    assert two.select("id").distinct().count() < two.count()


def test_land_synthetic_one_folder_per_batch(spark):
    from saasmart.sources import landing as L
    from saasmart.streaming import ingest as I
    lake = I.Lake.fresh(spark, "t-land")
    tags = L.land_synthetic(spark, lake.landing, [4, 8], n_users=50)
    assert len(tags) == 2
    for table, per_batch in (("events", R.EVENTS_PER_BATCH), ("invoices", R.INVOICES_PER_BATCH),
                             ("support_tickets", R.TICKETS_PER_BATCH)):
        for seed, tag in zip([4, 8], tags):
            got = spark.read.parquet(f"{lake.landing}/{table}/batch_{tag}.parquet")
            assert got.count() == per_batch
            exp = synth.GENERATORS[table](spark, [seed]).drop("batch")
            assert got.exceptAll(exp).count() == 0
    assert spark.read.parquet(L.users_path(lake.landing)).count() == 50
