"""Whitening against exact integers and dense linear algebra."""

import random
from fractions import Fraction

import numpy as np
import pytest

from saasmart.llm import whitening as w
from saasmart.llm.queries import QUERIES
from tests.conftest import SF01


def integers(vector):
    if not vector or any(c is None or not np.isfinite(c) for c in vector):
        return None
    return tuple(int(v) for v in np.floor(256 * np.array(vector, dtype=np.float64)))


def check(found, rows, components=4):
    """``found``: (id, component, n, deviation, whitened, explained, error) rows of ``rows``: (id, vector)."""
    xs = [(i, integers(v)) for i, v in rows]
    xs = [(i, x) for i, x in xs if x is not None]
    fit = sorted({x for _, x in xs})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    cov = np.cov(np.array(fit, dtype=np.float64).T, bias=True).reshape(d, d)
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(components, d)
    assert len(found) == len(xs) * k
    deviation = sorted((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in xs for _ in range(k))
    assert sorted((r[0], r[3]) for r in found) == deviation
    assert {r[2] for r in found} == {n}
    assert len({r[6] for r in found}) == 1 and found[0][6] <= 1e-4
    by_component = {c: sorted((r[0], r[4]) for r in found if r[1] == c) for c in range(1, k + 1)}
    first = {}
    for i, x in xs:
        first.setdefault(x, i)
    for c, own in by_component.items():
        assert np.allclose({r[5] for r in found if r[1] == c}.pop(), values[c - 1] / values.sum(), rtol=1e-4)
        unit = {i: v for i, v in own}
        of_fit = np.array([unit[i] for i in first.values()])
        assert abs(of_fit.mean()) < 1e-9 and abs((of_fit ** 2).mean() - 1) < 1e-6
    if n > 1:  # whitened values are a linear map of the centred vectors, of variance e along unit vectors
        x = np.array(fit, dtype=np.float64) - mean
        for c in by_component:
            y = np.array([dict(by_component[c])[first[f]] for f in fit])
            a, *_ = np.linalg.lstsq(x, y, rcond=None)
            assert np.allclose(x @ a, y, atol=1e-6)
            assert np.allclose(cov @ a, values[c - 1] * a, atol=1e-6 * values[0])


def rows_of(df, key="vec_id"):
    return [(r[key], r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in df.collect()]


def whitened(df):
    return rows_of(w.whiten(df, w.fit(df)).select("vec_id", "found.*"))


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    check(rows_of(QUERIES["op12_whitening"](spark, SF01)), rows)


@pytest.mark.parametrize("scale", [1, 1 << 20, 1 << 45])
def test_cross_products_are_exact(scale):
    rng = np.random.default_rng(scale % 97)
    for rows in (1, 63, 64, 65, 500):
        x = rng.integers(-scale, scale, size=(rows, 7))
        x[:, 3] = 5
        own = x.astype(object)
        assert (w.cross_products(x) == own.T @ own).all()


def test_limbs_give_the_number_back():
    rng = random.Random(2)
    for value in [0, 1, -1, (1 << 40) - 1, 1 << 40, -(1 << 40), -(1 << 40) - 1] + [rng.randint(-(1 << 130), 1 << 130) for _ in range(200)]:
        limbs = list(w._limbs(value))
        assert sum(part << (40 * place) for place, part in limbs) == value and all(abs(part) <= 1 << 40 for _, part in limbs)


def test_packing_keeps_vectors_apart():
    x = np.array([[0, 1], [-128, 127], [128, 0], [40000, -1], [1 << 40, 3], [1, 0], [1, 256]])
    packed = [b""] * len(x)
    for rows, data in w._pack(x):
        for row, value in zip(rows, data):
            packed[row] = value
    assert (w._unpack(packed) == x).all() and len(set(packed)) == len(x)
    assert [p[0] for p in packed] == [0, 0, 1, 2, 3, 0, 1]


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(w, "RUN", 50)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 6)) * [4, 3, 2, 1, 0.5, 0.1]
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[7].tolist()) for i in range(200)]
    rows += [(2000, None), (2001, []), (2002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2003, [float("nan")] * 6), (2004, [float("inf")] + [0.0] * 5),
             (2005, [-0.0] * 6), (2005, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as found", "2 as n", "3 as _whitened", "4 as packed")
    for n in (1, 7):
        model = w.fit(df.repartition(n))
        out = w.whiten(df.repartition(n), model, into="out").select("vec_id", "out.*")
        check(rows_of(out), rows)
    ragged = df.select("vec_id", "embedding").union(spark.createDataFrame([(3000, [1.0, 2.0])], "vec_id long, embedding array<double>"))
    check(whitened(ragged), rows)


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e9, 5.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])]
    found = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert len(found) == 8 and {r[3] for r in found if r[0] == 0} == {None} and all(np.isfinite(r[4]) for r in found)


def test_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    same = whitened(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema))
    assert [(r[1], r[2], r[3], r[4], r[5], r[6]) for r in sorted(same)] == [(1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)] * 2
    flat = sorted(whitened(spark.createDataFrame([(1, [0.5, 1.0]), (2, [1.5, 1.0])], schema)))
    assert [round(abs(r[4]), 12) for r in flat] == [1.0, 0.0, 1.0, 0.0] and flat[0][6] < 1e-9
    assert whitened(spark.createDataFrame([], schema)) == [] == whitened(spark.createDataFrame([(1, None)], schema))
