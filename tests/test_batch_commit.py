"""Batches count from their manifest on; files are loaded once; generations need no clock."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from saasmart.sources import adapters as A
from saasmart.sources import landing as L
from saasmart.streaming import ingest as I
from tests.conftest import SF001


def _events(spark, lo, hi):
    return A.events(spark, SF001).where((F.col("id") >= lo) & (F.col("id") < hi))


def _local(path):
    return path.replace("file:", "")


def _stream(spark, lake):
    before = I.read_raw(spark, lake, "events").count() if os.path.exists(_local(lake.raw_path("events"))) else 0
    I.append_incremental(spark, lake, "events")
    return (I.read_raw(spark, lake, "events").count() if os.path.exists(_local(lake.raw_path("events"))) else 0) - before


def _mtime(spark, lake):
    return I.append_by_mtime(spark, lake, "events")


CURSORS = pytest.mark.parametrize("load", [_stream, _mtime])


@CURSORS
def test_a_batch_half_written_is_not_seen(spark, load):
    lake = I.Lake.fresh(spark, "c-half")
    L.open_table(spark, lake.landing, "events")
    whole = f"{lake.root}/elsewhere"
    _events(spark, 0, 20).repartition(2).write.parquet(whole)
    parts = sorted(f for f in os.listdir(_local(whole)) if f.startswith("part-"))
    batch = _local(f"{L.table_dir(lake.landing, 'events')}/batch_a.parquet")
    os.makedirs(batch)
    shutil.copy(f"{_local(whole)}/{parts[0]}", batch)
    assert load(spark, lake) == 0
    shutil.copy(f"{_local(whole)}/{parts[1]}", batch)
    assert load(spark, lake) == 0
    L.commit_batch(spark, lake.landing, "events", "a")
    assert [load(spark, lake) for _ in range(2)] == [20, 0]


def test_a_committed_batch_that_lacks_a_file_is_not_seen(spark):
    lake = I.Lake.fresh(spark, "c-lacks")
    path = _local(L.write_batch(_events(spark, 0, 20).repartition(2), lake.landing, "events", "a"))
    part = sorted(f for f in os.listdir(path) if f.startswith("part-"))[0]
    shutil.move(f"{path}/{part}", f"{_local(lake.root)}/{part}")
    assert _mtime(spark, lake) == 0
    shutil.move(f"{_local(lake.root)}/{part}", f"{path}/{part}")
    assert _mtime(spark, lake) == 20


def test_manifest_states_files_rows_and_sizes(spark):
    lake = I.Lake.fresh(spark, "c-states")
    tags = ["x", "y", "z"]
    df = _events(spark, 0, 30).withColumn("batch", F.expr("cast(id % 2 as int)"))
    assert len(L.land_batches(df, lake.landing, "events", tags)) == 2  # number 2 has no rows, and so no batch
    lines = spark.read.schema(L.MANIFEST_SCHEMA).json(L.manifest_glob(lake.landing, "events")).collect()
    assert {r.batch for r in lines} == {"batch_x.parquet", "batch_y.parquet"}
    for r in lines:
        path = f"{L.table_dir(lake.landing, 'events')}/{r.file}"
        assert os.path.getsize(_local(path)) == r.bytes and spark.read.parquet(path).count() == r.rows
        assert r.files == sum(x.batch == r.batch for x in lines)
    with pytest.raises(FileExistsError):
        L.write_batch(_events(spark, 0, 1), lake.landing, "events", "x")


@CURSORS
def test_a_landing_cut_short_is_landed_again(spark, load, monkeypatch):
    lake = I.Lake.fresh(spark, "c-cut")
    with monkeypatch.context() as m:
        m.setattr(L, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            L.write_batch(_events(spark, 0, 9), lake.landing, "events", "a")
    assert load(spark, lake) == 0
    L.write_batch(_events(spark, 0, 20), lake.landing, "events", "a")
    assert load(spark, lake) == 20


def test_a_batch_seen_while_it_grows_is_loaded_file_by_file(spark):
    """A table folder that was never opened: no manifests, each file once."""
    lake = I.Lake.fresh(spark, "c-grows")
    whole = f"{lake.root}/elsewhere"
    _events(spark, 0, 20).repartition(2).write.parquet(whole)
    parts = sorted(f for f in os.listdir(_local(whole)) if f.startswith("part-"))
    batch = _local(f"{L.table_dir(lake.landing, 'events')}/batch_a.parquet")
    os.makedirs(batch)
    loaded = []
    for n, part in enumerate(parts):
        shutil.copy(f"{_local(whole)}/{part}", batch)
        os.utime(f"{batch}/{part}", (1_700_000_000 + 60 * n,) * 2)
        loaded += [_mtime(spark, lake), _mtime(spark, lake)]
    assert loaded == [10, 0, 10, 0] and I.read_raw(spark, lake, "events").count() == 20
    # opening commits what is there; what is loaded stays so
    L.write_batch(_events(spark, 20, 25), lake.landing, "events", "b")
    assert _mtime(spark, lake) == 5
    assert _stream(spark, lake) == 0 and I.read_raw(spark, lake, "events").count() == 25


@CURSORS
def test_a_crash_between_rows_and_ledger(spark, load, monkeypatch):
    """Another batch comes before the retry: no row is lost or there twice."""
    lake = I.Lake.fresh(spark, "c-crash")
    L.write_batch(_events(spark, 0, 20).repartition(2), lake.landing, "events", "a")
    real = I._load

    def crash(df, path, *rest):
        df.drop(I._FILE, I._MTIME).write.mode("overwrite").parquet(path)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(I, "_load", crash)
        with pytest.raises(Exception):
            load(spark, lake)
    assert I._load is real
    L.write_batch(_events(spark, 20, 25), lake.landing, "events", "b")
    load(spark, lake)
    assert I.read_raw(spark, lake, "events").count() == 25
    assert I.read_raw(spark, lake, "events").select("id").distinct().count() == 25


@CURSORS
def test_a_plain_file_is_whole(spark, load):
    lake = I.Lake.fresh(spark, "c-plain")
    L.write_batch(_events(spark, 0, 20), lake.landing, "events", "a")
    one = f"{lake.root}/one"
    _events(spark, 20, 30).coalesce(1).write.parquet(one)
    part = next(f for f in os.listdir(_local(one)) if f.startswith("part-"))
    shutil.copy(f"{_local(one)}/{part}", _local(f"{L.table_dir(lake.landing, 'events')}/batch_b c+d.parquet"))
    assert [load(spark, lake) for _ in range(2)] == [30, 0]


def test_stream_refuses_files_that_differ_from_their_manifest(spark):
    lake = I.Lake.fresh(spark, "c-differ")
    path = _local(L.write_batch(_events(spark, 0, 20).coalesce(1), lake.landing, "events", "a"))
    other = f"{lake.root}/other"
    _events(spark, 0, 7).coalesce(1).write.parquet(other)
    target = next(f for f in os.listdir(path) if f.startswith("part-"))
    source = next(f for f in os.listdir(_local(other)) if f.startswith("part-"))
    os.remove(f"{path}/.{target}.crc") if os.path.exists(f"{path}/.{target}.crc") else None
    shutil.copy(f"{_local(other)}/{source}", f"{path}/{target}")
    with pytest.raises(Exception, match="rows"):
        I.append_incremental(spark, lake, "events")
    assert I.read_ledger(spark, lake, "events").isEmpty()


def test_a_replace_counts_with_the_clock_set_back(spark, monkeypatch):
    lake, users = I.Lake.fresh(spark, "c-clock"), A.users(spark, SF001)

    class Clock(dt.datetime):
        hours = 0

        @classmethod
        def now(cls, tz=None):
            cls.hours -= 5
            return dt.datetime(2026, 1, 1, tzinfo=tz) + dt.timedelta(hours=cls.hours)

    monkeypatch.setattr(I.dt, "datetime", Clock)
    for n in (5, 6, 7, 4):
        L.write_users(users.limit(n), lake.landing)
        assert I.replace_load(spark, lake) == n
        assert I.read_raw(spark, lake, "users").count() == n
    assert I.generation(spark, lake, "users") == "r0000000004"
    assert len(os.listdir(_local(f"{lake.raw}/users"))) == I.KEEP_GENERATIONS


def test_two_writers_never_claim_one_number(spark):
    from concurrent.futures import ThreadPoolExecutor
    lake = I.Lake.fresh(spark, "c-claim")
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: I._claim(spark, lake, "users"), range(16)))
    assert sorted(numbers) == sorted(set(numbers)) and len(numbers) == 16
