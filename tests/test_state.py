"""Marts kept up load by load equal those made in one go."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from saasmart import schemas
from saasmart.plans import models as M
from saasmart.plans import staging as S
from saasmart.plans import state
from saasmart.sources import adapters as A
from saasmart.sources import landing as L
from saasmart.streaming import ingest as I
from tests.conftest import SF001

T0 = dt.datetime(2026, 3, 1, 12)


def _same(got, want):
    assert got.schema.names == want.schema.names
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def _times(folder):
    return {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(folder.replace("file:", "")) for f in fs}


def _land(spark, lake, table, df, tag):
    L.write_batch(df, lake.landing, table, tag)
    I.append_incremental(spark, lake, table)


def _events(spark, rows):
    schema = schemas.nullable(schemas.EVENTS)
    return spark.createDataFrame([(i, u, name, None if t is None else T0 + dt.timedelta(seconds=t), "{}") for i, u, name, t in rows], schema)


def test_daily_users_by_bitmaps(spark):
    lake, daily = I.Lake.fresh(spark, "s-daily"), None
    names = list(M.DAU_EVENTS.values()) + ["other"]
    rng = random.Random(3)
    ids = [None, 0, 1, -1, -40000, 32767, 32768, 32769, 1 << 40, (1 << 62) + 5, *range(100, 140)]
    daily = state.DailyUsers(spark, lake)
    for n in range(3):
        day = lambda: rng.choice([None, 0, 86_400 * n, 86_400 * (n + 1)])
        rows = [(100 * n + k, rng.choice(ids), rng.choice(names), day()) for k in range(150)]
        before = _times(daily.parts.root)
        _land(spark, lake, "events", _events(spark, rows), str(n))
        assert len(daily.update()) == 1 and daily.update() == []
        after = _times(daily.parts.root)
        assert all(after[f] == t for f, t in before.items())  # parts of earlier loads stay as they are
        want = M.daily_active_users(S.stg_events(I.read_raw(spark, lake, "events")))
        _same(daily.read(), want)


def _invoices(spark, lo, hi):
    return A.invoices(spark, SF001).where(f"id >= {lo} and id < {hi}")


def test_revenue_reads_the_new_load_alone(spark, monkeypatch):
    lake = I.Lake.fresh(spark, "s-revenue")
    users = A.users(spark, SF001)
    few = users.where("id % 3 <> 0")
    revenue, read = state.Revenue(spark, lake), []
    real = state.read_load
    monkeypatch.setattr(state, "read_load", lambda *a: read.append(real(*a)) or read[-1])

    def check(loads):
        assert len(revenue.update()) == loads
        _same(revenue.read(), M.fct_revenue(S.stg_invoices(I.read_raw(spark, lake, "invoices")), S.stg_users(I.read_raw(spark, lake, "users"))))
        files, seen = [f for df in read for f in df.inputFiles()], len(read)
        read.clear()
        assert seen == loads
        return {f.split("/load_")[1].split("/")[0] for f in files}

    def replace(df):
        L.write_users(df, lake.landing)
        I.replace_load(spark, lake)

    replace(few)
    _land(spark, lake, "invoices", _invoices(spark, 0, 500).withColumn("user_id", F.expr("if(id % 50 = 0, null, user_id)")), "a")
    first = check(1)
    _land(spark, lake, "invoices", _invoices(spark, 400, 900), "b")
    second = check(1)
    assert len(first) == len(second) == 1 and first != second
    replace(users)  # new users have invoices in both loads: no load is read again
    assert check(0) == set()
    _land(spark, lake, "invoices", _invoices(spark, 900, 1500), "c")
    assert not check(1) & (first | second)
    replace(users.withColumn("plan", F.expr("if(id = 1, 'moved', plan)")))  # a known user changed: all loads anew
    assert len(check(3)) == 3
    replace(users.where("id <> 2").union(users.where("id = 4")))
    check(3)


def test_sessions_batch_by_batch(spark):
    from saasmart.operators.sessionize import sessionize_plain
    rng = random.Random(8)
    lake = I.Lake.fresh(spark, "s-sessions")
    sessions, every, number = state.Sessions(spark, lake), [], 0
    for n in range(5):
        rows = []
        for user in [None, *range(12)]:
            for _ in range(rng.randint(0, 6)):
                number += 1
                start = 20_000 * n
                kind = rng.random()
                late = user in (3, 4) and kind < 0.5
                t = None if user in (5, None) and kind < 0.4 else rng.randrange(start - 15_000 if late else start, start + 20_000, 300)
                rows.append((number if kind < 0.95 else 1, user, "e", t))
        if n == 3:
            rows += [r for r in every if r[1] == 6][:1]                        # a repeated row
        if n == 4:
            rows += [(number + 50, 7, "e", max([r[3] for r in every if r[1] == 7] or [0]))]  # the carried time again, a later id
            rows += [(0, 8, "e", max([r[3] for r in every if r[1] == 8] or [0]))]            # and an earlier id
        every += rows
        _land(spark, lake, "events", _events(spark, rows), str(n))
        assert len(sessions.update()) == 1 and sessions.update() == []
        staged = S.stg_events(I.read_raw(spark, lake, "events"))
        want = sessionize_plain(staged).select("event_id", "user_id", "event_name", "event_timestamp", "properties", "session_number")
        _same(sessions.read(), want)
    users = sessions.parts.read("users", sessions.parts.done())
    assert users.where("late").count() > 5 and users.where("not late and before is not null").count() > 15


def test_update_cut_short_goes_on(spark, monkeypatch):
    lake = I.Lake.fresh(spark, "s-cut")
    rows = [(k, k % 5, "page_view", 400 * k) for k in range(60)]
    for n in range(2):
        _land(spark, lake, "events", _events(spark, rows[30 * n:30 * n + 30]), str(n))
    for make in (state.Sessions, state.DailyUsers):
        table, real = make(spark, lake), state.Parts.write
        calls = []

        def write(self, df, kind, label):
            calls.append(kind)
            if len(calls) == 5 if make is state.Sessions else len(calls) == 4:
                raise OSError("lost")
            return real(self, df, kind, label)

        with monkeypatch.context() as m:
            m.setattr(state.Parts, "write", write)
            try:
                table.update()
            except OSError:
                pass
        assert len(table.update()) == 1
    staged = S.stg_events(I.read_raw(spark, lake, "events"))
    _same(state.Sessions(spark, lake).read(), M.user_events_sessionized(staged))
    _same(state.DailyUsers(spark, lake).read(), M.daily_active_users(staged))


def test_a_replaced_table_starts_anew(spark):
    lake = I.Lake.fresh(spark, "s-replaced")
    for n, seed in enumerate((1, 2)):
        I.bootstrap_raw(spark, lake, seed, n_users=50)
        daily = state.DailyUsers(spark, lake)
        assert len(daily.update()) == 1
        assert daily.read().agg(F.sum("total_events")).first()[0] == I.read_raw(spark, lake, "events").count()
