"""Landing + ingest behaviour: replace, incremental cursor, rerun, names, touch."""

import os
import time

import pytest
from pyspark.sql import functions as F

from saasmart.sources import adapters as A
from saasmart.sources import landing as L
from saasmart.streaming import ingest as I
from tests.conftest import SF001


def _events(spark, lo, hi):
    return A.events(spark, SF001).where((F.col("id") >= lo) & (F.col("id") < hi))


def test_users_replace_keeps_one_copy(spark):
    lake = I.Lake.fresh(spark, "t-replace")
    users = A.users(spark, SF001)
    n = users.count()
    for _ in range(2):
        L.write_users(users, lake.landing)
        assert I.replace_load(spark, lake) == n
    assert I.read_raw(spark, lake, "users").count() == n


def test_incremental_stream_cursor(spark):
    lake = I.Lake.fresh(spark, "t-stream")
    L.write_batch(_events(spark, 0, 10), lake.landing, "events", "a")
    I.append_incremental(spark, lake, "events")
    assert I.read_raw(spark, lake, "events").count() == 10
    I.append_incremental(spark, lake, "events")  # rerun: nothing new
    assert I.read_raw(spark, lake, "events").count() == 10
    L.write_batch(_events(spark, 10, 25), lake.landing, "events", "b")
    # neither a file nor a folder whose name does not start with batch_ is loaded
    _events(spark, 0, 5).write.parquet(f"{lake.landing}/events/other.parquet")
    _events(spark, 0, 5).write.parquet(f"{lake.landing}/events/xbatch_c.parquet")
    I.append_incremental(spark, lake, "events")
    assert I.read_raw(spark, lake, "events").count() == 25
    ledger = I.read_ledger(spark, lake).where(F.col("table_name") == "events")
    assert sorted(r.rows_loaded for r in ledger.collect()) == [10, 15]


def test_cursors_are_per_table(spark):
    lake = I.Lake.fresh(spark, "t-tables")
    L.write_batch(_events(spark, 0, 10), lake.landing, "events", "a")
    I.append_incremental(spark, lake, "events")
    L.write_batch(A.invoices(spark, SF001).where(F.col("id") < 7), lake.landing, "invoices", "a")
    I.append_incremental(spark, lake, "invoices")
    I.append_incremental(spark, lake, "events")
    assert I.read_raw(spark, lake, "invoices").count() == 7
    assert I.read_raw(spark, lake, "events").count() == 10


def _touch_folder(path):
    local = path.replace("file:", "")
    later = time.time() + 5
    for root, _, files in os.walk(local):
        for f in files:
            os.utime(os.path.join(root, f), (later, later))


def test_touched_file_stream_vs_mtime(spark):
    lake = I.Lake.fresh(spark, "t-touch")
    path = L.write_batch(_events(spark, 0, 10), lake.landing, "events", "a")
    I.append_incremental(spark, lake, "events")
    mlake = I.Lake(lake.root + "-m")
    mpath = L.write_batch(_events(spark, 0, 10), mlake.landing, "events", "a")
    assert I.append_by_mtime(spark, mlake, "events") == 10
    assert I.append_by_mtime(spark, mlake, "events") == 0
    if not path.startswith(("file:", "/")):
        return
    _touch_folder(path)
    _touch_folder(mpath)
    I.append_incremental(spark, lake, "events")
    assert I.read_raw(spark, lake, "events").count() == 10   # path cursor: not again
    assert I.append_by_mtime(spark, mlake, "events") == 10    # mtime cursor: again


def _set_times(path, when):
    for root, _, files in os.walk(path.replace("file:", "")):
        for f in files:
            os.utime(os.path.join(root, f), (when, when))


def test_late_batch_with_older_mtime(spark):
    """Ten days older than what is loaded: new to the path cursor, old to the mtime cursor."""
    lake = I.Lake.fresh(spark, "t-late")
    mlake = I.Lake(lake.root + "-m")
    for lk in (lake, mlake):
        L.write_batch(_events(spark, 0, 10), lk.landing, "events", "a")
    I.append_incremental(spark, lake, "events")
    assert I.append_by_mtime(spark, mlake, "events") == 10
    for lk in (lake, mlake):
        _set_times(L.write_batch(_events(spark, 10, 25), lk.landing, "events", "b"), time.time() - 10 * 86400)
    I.append_incremental(spark, lake, "events")
    assert I.read_raw(spark, lake, "events").count() == 25
    assert I.append_by_mtime(spark, mlake, "events") == 0


def test_mtime_cursor_loads_a_batch_of_equal_time(spark):
    lake, now = I.Lake.fresh(spark, "t-equal"), time.time()
    _set_times(L.write_batch(_events(spark, 0, 10), lake.landing, "events", "a"), now)
    assert I.append_by_mtime(spark, lake, "events") == 10
    _set_times(L.write_batch(_events(spark, 10, 25), lake.landing, "events", "b"), now)
    assert I.append_by_mtime(spark, lake, "events") == 15
    _set_times(L.write_batch(_events(spark, 25, 30), lake.landing, "events", "c"), now)
    assert I.append_by_mtime(spark, lake, "events") == 5
    assert I.append_by_mtime(spark, lake, "events") == 0
    assert I.read_raw(spark, lake, "events").count() == 30


def test_mtime_cursor_loads_a_straddling_batch_whole(spark):
    lake, now = I.Lake.fresh(spark, "t-straddle"), time.time()
    _set_times(L.write_batch(_events(spark, 0, 10), lake.landing, "events", "a"), now)
    assert I.append_by_mtime(spark, lake, "events") == 10
    path = L.write_batch(_events(spark, 10, 30).repartition(2), lake.landing, "events", "b").replace("file:", "")
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(parts) == 2
    for f, when in zip(parts, (now - 60, now + 60)):
        os.utime(os.path.join(path, f), (when, when))
    assert I.append_by_mtime(spark, lake, "events") == 20
    assert I.read_raw(spark, lake, "events").count() == 30


def test_mtime_load_repeated_after_a_crash(spark, monkeypatch):
    """The rows are written, the ledger isn't: the next run rewrites the same load."""
    lake = I.Lake.fresh(spark, "t-crash")
    L.write_batch(_events(spark, 0, 10), lake.landing, "events", "a")
    ledger = I.Lake.ledger
    with monkeypatch.context() as m:
        m.setattr(I.Lake, "ledger", property(lambda self: "nosuchscheme://x/ledger" if m.armed else ledger.fget(self)))
        m.armed = False
        real = I.current_path

        def arm(*args):
            path = real(*args)
            m.armed = True
            return path

        m.setattr(I, "current_path", arm)
        with pytest.raises(Exception):
            I.append_by_mtime(spark, lake, "events")
    assert I.append_by_mtime(spark, lake, "events") == 10
    assert I.read_raw(spark, lake, "events").count() == 10


def test_idle_runs_write_nothing_and_no_batch_is_no_error(spark):
    lake = I.Lake.fresh(spark, "t-idle")
    os.makedirs(L.table_dir(lake.landing, "events").replace("file:", ""))
    assert I.append_by_mtime(spark, lake, "events") == 0
    I.append_incremental(spark, lake, "events")
    L.write_batch(_events(spark, 0, 10), lake.landing, "events", "a")
    assert I.append_by_mtime(spark, lake, "events") == 10
    for _ in range(3):
        assert I.append_by_mtime(spark, lake, "events") == 0
    assert len(os.listdir(lake.raw_path("events").replace("file:", ""))) == 1


def test_users_glob_is_flat_and_a_failed_replace_changes_nothing(spark):
    lake = I.Lake.fresh(spark, "t-users")
    users = A.users(spark, SF001)
    L.write_users(users.limit(5), lake.landing)
    users.limit(7).write.parquet(f"{lake.landing}/users/archive/old.parquet")
    assert I.replace_load(spark, lake) == 5
    for f in os.listdir(L.users_path(lake.landing).replace("file:", "")):
        if f.endswith(".parquet"):
            with open(os.path.join(L.users_path(lake.landing).replace("file:", ""), f), "wb") as broken:
                broken.write(b"no parquet")
    with pytest.raises(Exception):
        I.replace_load(spark, lake)
    assert I.read_raw(spark, lake, "users").count() == 5
    for _ in range(3):
        L.write_users(users.limit(6), lake.landing)
        assert I.replace_load(spark, lake) == 6
    assert I.read_raw(spark, lake, "users").count() == 6
    assert len(os.listdir(f"{lake.raw}/users".replace("file:", ""))) == I.KEEP_GENERATIONS


def test_bootstrap_refuses_a_lake_with_appended_batches(spark):
    lake = I.Lake.fresh(spark, "t-refuse")
    L.write_batch(_events(spark, 0, 10), lake.landing, "events", "a")
    I.append_incremental(spark, lake, "events")
    with pytest.raises(ValueError):
        I.bootstrap_raw(spark, lake)
    assert I.read_raw(spark, lake, "events").count() == 10


def test_ledger_has_a_row_per_file_and_compacts(spark):
    lake = I.Lake.fresh(spark, "t-ledger")
    for n in range(3):
        L.write_batch(_events(spark, 10 * n, 10 * n + 10).repartition(2), lake.landing, "events", f"{n}")
        I.append_by_mtime(spark, lake, "events")
    before = sorted(map(str, I.read_ledger(spark, lake, "events").collect()))
    assert len(before) == 6 and sum(r.rows_loaded for r in I.read_ledger(spark, lake).collect()) == 30
    assert {r.batch for r in I.read_ledger(spark, lake).collect()} == {"batch_0.parquet", "batch_1.parquet", "batch_2.parquet"}
    assert I.compact_ledger(spark, lake, "events", at=2)
    assert sorted(map(str, I.read_ledger(spark, lake, "events").collect())) == before
    assert not I.compact_ledger(spark, lake, "events", at=2)
    assert I.append_by_mtime(spark, lake, "events") == 0
