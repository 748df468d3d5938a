"""Sessionization: hand fixtures, forced hot-key splitting, skewed keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saasmart.operators.sessionize import sessionize, sessionize_plain
from saasmart.plans import registry
from tests.conftest import SF01

SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
])

D0 = dt.datetime(2025, 10, 1)


def at(h=0, m=0, s=0):
    return D0 + dt.timedelta(hours=h, minutes=m, seconds=s)


def numbers(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = sessionize(df, **kw).orderBy("user_id", F.col("event_timestamp").asc_nulls_last(),
                                       "event_id")
    return [r.session_number for r in out.collect()]


CASES = {
    "single": ([(1, 1, at())], [1]),
    "gap_under": ([(1, 1, at()), (2, 1, at(0, 29, 59))], [1, 1]),
    "gap_equal": ([(1, 1, at()), (2, 1, at(0, 30))], [1, 1]),
    "gap_over": ([(1, 1, at()), (2, 1, at(0, 30, 1))], [1, 2]),
    "chain": ([(1, 1, at()), (2, 1, at(0, 20)), (3, 1, at(0, 40)), (4, 1, at(1, 30))],
              [1, 1, 1, 2]),
    "tie": ([(1, 1, at()), (7, 1, at(1)), (8, 1, at(1))], [1, 2, 2]),
    "null_ts": ([(1, 1, at()), (2, 1, None)], [1, 1]),
    "two_nulls": ([(1, 1, at()), (2, 1, None), (3, 1, None)], [1, 1, 2]),
}


@pytest.mark.parametrize("name", sorted(CASES))
@pytest.mark.parametrize("slice_rows", [None, 1])
def test_hand_fixtures(spark, name, slice_rows):
    rows, expected = CASES[name]
    assert numbers(spark, rows, slice_rows=slice_rows) == expected


def test_second_user_interleaved(spark):
    rows = [(1, 1, at()), (2, 2, at(0, 10)), (3, 1, at(0, 50))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.event_id: r.session_number for r in sessionize(df).collect()}
    assert got == {1: 1, 2: 1, 3: 2}


def _as_set(df):
    return sorted((tuple(r) for r in df.select(
        "event_id", "user_id", "prev_event_at", "is_new_session", "session_number").collect()),
                  key=repr)


@pytest.mark.parametrize("slice_rows", [3, 17, 64])
def test_split_matches_plain_on_events(spark, slice_rows):
    ev = registry.stg_events(spark, SF01)
    assert _as_set(sessionize(ev, slice_rows=slice_rows)) == _as_set(sessionize_plain(ev))


def test_one_key_holds_a_third(spark):
    ev = registry.stg_events(spark, SF01)
    # Every third event moves to user 1 (with its own timestamps), so user 1
    # holds a third of all rows, interleaved in time.
    skewed = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(1))
                           .otherwise(F.col("user_id")))
    got = sessionize(skewed, slice_rows=200)
    assert _as_set(got) == _as_set(sessionize_plain(skewed))
    # the hot key really was cut into several slices
    hot = skewed.where(F.col("user_id") == 1).count()
    assert hot > 3000


def test_null_keys_and_duplicates(spark):
    rows = [(1, None, at()), (2, None, at(1)), (3, None, at(1)), (4, 5, at()), (4, 5, at()),
            (5, 5, None), (6, 5, at(2))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _as_set(sessionize(df, slice_rows=1)) == _as_set(sessionize_plain(df))


def test_dst_gap_session_zone(spark):
    """Wall-clock cells stay ordered in a zone with a DST gap (NTZ values)."""
    base = dt.datetime(2025, 3, 9, 1, 0)
    rows = [(i, 1, base + dt.timedelta(minutes=7 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert _as_set(sessionize(df, slice_rows=3)) == _as_set(sessionize_plain(df))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _burst_frame(spark, same_ts):
    rows = []
    for i in range(300):  # the burst: one timestamp, or 300 seconds apart by 1 s
        t = at(5) if same_ts else at(5, 0, i)
        rows.append((1000 + i, 1, t))
    for i in range(120):  # the rest of the hot key, spread over a day
        rows.append((i, 1, at(0, 12 * i)))
    rows += [(5000 + i, 2, at(0, 7 * i)) for i in range(30)]  # a small key
    rows += [(6000, 1, None), (6001, 1, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("same_ts", [True, False])
def test_bursts_are_cut_and_exact(spark, same_ts):
    df = _burst_frame(spark, same_ts)
    out = sessionize(df, slice_rows=40)
    assert _as_set(out) == _as_set(sessionize_plain(df))
    # no slice of the split plan holds more than the limit, bar copies / NULL ts
    from saasmart.operators import sessionize as ss
    sizes = _slice_sizes(spark, df, 40)
    assert max(sizes) <= 40 * 2, sizes


def _slice_sizes(spark, df, limit):
    """Row counts of the (key, slice) groups the window would see."""
    from saasmart.operators import sessionize as ss
    captured = {}
    orig = ss._refine

    def spy(*args):
        out = orig(*args)
        captured["labeled"] = out
        return out
    ss._refine = spy
    try:
        ss.sessionize(df, slice_rows=limit)
    finally:
        ss._refine = orig
    lab = captured["labeled"].where(F.col("event_timestamp").isNotNull())
    return [r[0] for r in lab.groupBy("user_id", ss._SLICE).count().select("count").collect()]


def test_copy_group_of_a_third_is_collapsed_and_exact(spark):
    rows = [(77, 1, at(3)) for _ in range(200)]               # one record copied 200 times
    rows += [(i, 1, at(0, 5 * i)) for i in range(100)]        # the rest of the hot key
    rows += [(500 + i, 2, at(0, 9 * i)) for i in range(300)]  # other keys
    rows += [(78, 1, at(3)), (76, 1, at(3))]                  # ties beside the copies
    df = spark.createDataFrame(rows, SCHEMA)
    got = sessionize(df, slice_rows=40)
    assert got.count() == len(rows)
    assert _as_set(got) == _as_set(sessionize_plain(df))


def test_null_timestamp_rows_of_a_hot_key_are_cut(spark):
    rows = [(1000 + i, 1, None) for i in range(300)]          # NULL timestamps, distinct ids
    rows += [(None, 1, None), (None, 1, None)]                 # NULL ts and NULL tiebreak
    rows += [(i, 1, at(0, 9 * i)) for i in range(100)]         # the rest of the hot key
    rows += [(5000 + i, 2, at(0, 7 * i)) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _as_set(sessionize(df, slice_rows=40)) == _as_set(sessionize_plain(df))
    from saasmart.operators import sessionize as ss
    captured = {}
    orig = ss._refine

    def spy(*a):
        captured["l"] = orig(*a)
        return captured["l"]
    ss._refine = spy
    try:
        ss.sessionize(df, slice_rows=40)
    finally:
        ss._refine = orig
    nulls = captured["l"].where(F.col("event_timestamp").isNull())
    sizes = [r[0] for r in nulls.groupBy("user_id", ss._SLICE).count().select("count").collect()]
    assert max(sizes) <= 80 and len(sizes) > 1


@pytest.mark.parametrize("seeds,continued", [((1000, 2800), 49995), ((1000, 2801), 0)])
def test_generated_near_pairs(spark, seeds, continued):
    """Two batches whose seeds differ by 1,800 s: every event has a partner 30 min later."""
    from saasmart.plans.staging import stg_events
    from saasmart.sources import synth
    ev = stg_events(synth.events(spark, list(seeds)).drop("batch"))
    out = sessionize(ev)
    assert out.where(F.col("is_new_session") == 0).count() == continued
    assert out.count() == 2 * 50000


@pytest.mark.parametrize("limit", [1, 50])
def test_array_labels_when_long_labels_could_overflow(spark, limit, monkeypatch):
    """Force the array encoding (tiny bound) at the start or after the first level."""
    from saasmart.operators import sessionize as ss
    monkeypatch.setattr(ss._Labels, "LIMIT", limit)
    rows = [(77, 1, at(3)) for _ in range(120)]                  # copy group
    rows += [(1000 + i, 1, at(5)) for i in range(150)]           # single-timestamp burst
    rows += [(i, 1, at(0, 5 * i)) for i in range(100)]
    rows += [(500 + i, 2, at(0, 9 * i)) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _as_set(ss.sessionize(df, slice_rows=40)) == _as_set(sessionize_plain(df))


def test_null_timestamp_copy_group_is_collapsed_and_exact(spark):
    rows = [(9, 1, None) for _ in range(150)]                   # one NULL-ts record copied
    rows += [(5, 1, None), (10, 1, None), (None, 1, None)]       # neighbours in tiebreak order
    rows += [(i, 1, at(0, 7 * i)) for i in range(100)]
    rows += [(800 + i, 2, at(0, 3 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sessionize(df, slice_rows=40)
    assert got.count() == len(rows)
    assert _as_set(got) == _as_set(sessionize_plain(df))


def test_string_tiebreak_hot_key(spark):
    schema = T.StructType([T.StructField("event_id", T.StringType()),
                           T.StructField("user_id", T.LongType()),
                           T.StructField("event_timestamp", T.TimestampNTZType())])
    rows = [(f"e{i:04d}", 1, at(2)) for i in range(120)]           # tie burst
    rows += [(f"n{i:04d}", 1, None) for i in range(90)]            # NULL timestamps
    rows += [(f"c{i:04d}", 1, at(0, 4 * i)) for i in range(100)]
    rows += [("same", 1, at(4)) for _ in range(60)]                # copies
    df = spark.createDataFrame(rows, schema)

    def keyed(d):
        return sorted((tuple(r) for r in d.select(
            "event_id", "user_id", "prev_event_at", "is_new_session", "session_number")
            .collect()), key=repr)
    assert keyed(sessionize(df, slice_rows=30)) == keyed(sessionize_plain(df))
