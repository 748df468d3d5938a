"""Property: the split form equals the one-window form on arbitrary inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from saasmart.operators.sessionize import sessionize, sessionize_plain
from tests.test_sessionize import SCHEMA, _as_set

BASE = dt.datetime(2025, 10, 1)
TEXT_SCHEMA = T.StructType([T.StructField("event_id", T.StringType()), *SCHEMA.fields[1:]])


def rows_strategy(max_minute):
    return st.lists(st.tuples(
        st.integers(min_value=0, max_value=40),                        # event id (repeats)
        st.one_of(st.none(), st.integers(min_value=0, max_value=3)),   # user (NULL allowed)
        st.one_of(st.none(), st.integers(min_value=0, max_value=max_minute)),  # minute
    ), min_size=1, max_size=80)


def _check(spark, rows, slice_rows):
    data = [(i, u, None if m is None else BASE + dt.timedelta(minutes=m)) for i, u, m in rows]
    df = spark.createDataFrame(data, SCHEMA)
    assert _as_set(sessionize(df, slice_rows=slice_rows)) == _as_set(sessionize_plain(df))


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy(240), slice_rows=st.integers(1, 8))
def test_split_equals_plain(spark, rows, slice_rows):
    _check(spark, rows, slice_rows)


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy(3), slice_rows=st.integers(1, 6))
def test_split_equals_plain_with_many_ties(spark, rows, slice_rows):
    _check(spark, rows, slice_rows)


WIDE_IDS = st.sampled_from([-(2**63), -(2**63) + 1, -9 * 10**18, -1, 0, 1, 9 * 10**18, 2**63 - 2, 2**63 - 1])


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(WIDE_IDS, st.integers(0, 1), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=40),
       slice_rows=st.integers(1, 4))
def test_split_equals_plain_with_wide_ids(spark, rows, slice_rows):
    _check(spark, rows, slice_rows)


TEXT_IDS = st.one_of(st.none(), st.text(alphabet="ab\u00e9\U0001f600", max_size=4))


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(TEXT_IDS, st.integers(0, 1), st.one_of(st.none(), st.none(), st.integers(0, 2))),
                     min_size=1, max_size=40, unique=True),
       slice_rows=st.integers(1, 4))
def test_split_equals_plain_with_text_ids(spark, rows, slice_rows):
    data = [(i, u, None if m is None else BASE + dt.timedelta(minutes=m)) for i, u, m in rows]
    df = spark.createDataFrame(data, TEXT_SCHEMA)
    assert _as_set(sessionize(df, slice_rows=slice_rows)) == _as_set(sessionize_plain(df))


def test_null_timestamps_with_uuids_are_cut(spark):
    import uuid

    from saasmart.operators import sessionize as ss
    rng = __import__("random").Random(4)
    data = [(str(uuid.UUID(int=rng.getrandbits(128))), 1, None) for _ in range(200)]
    df = spark.createDataFrame(data, TEXT_SCHEMA)
    heavy = ss.heavy_cells(df.selectExpr("*", "0L as _ss_slice"), "_ss_slice", 20)
    assert heavy.count() == 1 and not heavy.first()["_copy"]
    got = sessionize(df, slice_rows=20)
    assert _as_set(got) == _as_set(sessionize_plain(df))
