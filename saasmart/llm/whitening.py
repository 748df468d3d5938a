"""Embedding whitening from an exact, bit-sliced scatter matrix.

An entry c becomes the integer x = floor(256 c). Each distinct x vector counts once: the
vectors are packed into as few bytes as they need, which makes equal vectors equal bytes,
and those are grouped; a vector that a third of all rows have is one row per task.

Scatter: a task takes its vectors in runs of ``RUN``. In a run each dimension is shifted by
its least value, so that all are counts from zero, and each bit of each dimension, across
the run's rows, is packed into 64-bit words: a bit plane. The sum of y_i y_j over the rows
is the sum over planes a of i and b of j of 2**(a + b) times the bits set in both. The
shift is taken back in integers, and the sums leave the task as 40-bit limbs, which Spark
adds up in decimals. So cross-products and sums are exact at any number of rows.

The driver holds the d x d matrix: n P - S S' is centred as integers, divided by n**2 and
given to ``eigh``. Whitened values project x - S/n onto a component over the root of its
eigenvalue. ``identity_error`` follows from the components and the exact covariance.

Defined results: rows whose vector is null, empty or holds a null or non-finite entry are
left out, as are vectors whose length isn't the table's most frequent one (the longer of
equals). Entries beyond 2**52 after scaling count as that. ``deviation`` is null where it
doesn't fit a long. A component without variance (all of one, where the fit list has one
vector) has whitened 0, and ``identity_error`` leaves it out; ``explained`` is 0 where there
is no variance at all. Repeated rows get a row each, null ids too; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import free_name

SCALE = 256.0
COMPONENTS = 4
#: Vectors of one run of bit planes.
RUN = 4096
#: Largest size of an integer entry: the integers that doubles hold exactly.
LARGEST = 1 << 52
LIMB = 40


def _integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x vectors) of the rows of a list column that are whole and finite, by length."""
    column = column.cast(pa.list_(pa.float64()))
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    c = column.flatten().to_numpy(zero_copy_only=False)  # a null entry is not a number
    start = np.cumsum(size) - size
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(c))))
    whole = (size > 0) & (bad[start + size] == bad[start])
    for length in np.unique(size[whole]):
        rows = np.flatnonzero(whole & (size == length))
        with np.errstate(over="ignore"):
            x = np.floor(SCALE * c[start[rows][:, None] + np.arange(length)])
        yield rows, np.clip(x, -LARGEST, LARGEST).astype(np.int64)


_KINDS = [np.dtype(k) for k in ("<i1", "<i2", "<i4", "<i8")]


def _pack(x: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(rows, bytes): each vector in the narrowest integers that hold it, after one byte that names them."""
    low, high = x.min(axis=1), x.max(axis=1)
    fits = np.array([(np.iinfo(t).min <= low) & (high <= np.iinfo(t).max) for t in _KINDS])
    narrowest = fits.argmax(axis=0)
    for kind in np.unique(narrowest):
        rows = np.flatnonzero(narrowest == kind)
        data = x[rows].astype(_KINDS[kind]).tobytes()
        size = len(data) // len(rows)
        yield rows, [bytes([kind]) + data[at:at + size] for at in range(0, len(data), size)]


def _unpack(vectors: list[bytes]) -> np.ndarray:
    """Vectors of one length, in any order of kinds."""
    kinds = np.array([v[0] for v in vectors])
    d = (len(vectors[0]) - 1) // _KINDS[kinds[0]].itemsize
    out = np.empty((len(vectors), d), dtype=np.int64)
    for kind in np.unique(kinds):
        rows = np.flatnonzero(kinds == kind)
        out[rows] = np.frombuffer(b"".join(vectors[r][1:] for r in rows), _KINDS[kind]).reshape(-1, d)
    return out


def packed(vector: Column) -> Column:
    """The integer vector as bytes; null for one that is left out."""
    @F.arrow_udf(T.BinaryType())
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out: list[bytes | None] = [None] * len(column)
            for rows, x in _integers(column):
                for some, data in _pack(x):
                    for row, value in zip(rows[some].tolist(), data):
                        out[row] = value
            yield pa.array(out, pa.binary())

    return run(vector)


def planes(y: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Of counts (rows x dimensions): for each bit, the dimensions that have it and their planes as words."""
    rows, d = y.shape
    padded = np.zeros((d, -(-rows // 64) * 64), dtype=np.uint64)
    padded[:, :rows] = y.T
    out = []
    for bit in range(int(y.max(initial=0)).bit_length()):
        own = ((padded >> np.uint64(bit)) & np.uint64(1)).astype(bool)
        dims = np.flatnonzero(own.any(axis=1))
        out.append((bit, dims, np.packbits(own[dims], axis=1, bitorder="little").view(np.uint64)))
    return out


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that each plane of ``a`` has in common with each of ``b``."""
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for p, plane in enumerate(a):
        out[p] = np.bitwise_count(plane & b).sum(axis=1, dtype=np.uint32)
    return out


def cross_products(x: np.ndarray) -> np.ndarray:
    """The matrix of the sums of x_i x_j over the rows, as Python integers."""
    rows, d = x.shape
    shift = x.min(axis=0)
    by_weight: dict[int, np.ndarray] = {}
    sliced = planes(x - shift)
    for k, (bit, dims, words) in enumerate(sliced):
        for other_bit, other_dims, other_words in sliced[k:]:
            sums = by_weight.setdefault(bit + other_bit, np.zeros((d, d), dtype=np.int64))
            both = _both(words, other_words)
            sums[np.ix_(dims, other_dims)] += both
            if other_bit != bit:
                sums[np.ix_(other_dims, dims)] += both.T
    out = np.zeros((d, d), dtype=object)
    for weight, sums in by_weight.items():
        out += sums.astype(object) << weight
    # x = y + shift
    low = shift.astype(object)
    total = _total(x) - rows * low
    return out + np.outer(total, low) + np.outer(low, total) + rows * np.outer(low, low)


def _total(x: np.ndarray) -> np.ndarray:
    """Sums over the rows as Python integers: of the low and of the high half."""
    low = (x & 0xFFFFFFFF).sum(axis=0).astype(object)
    return low + ((x >> 32).sum(axis=0).astype(object) << 32)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """The integer in pieces of LIMB bits, the last with the sign."""
    place = 0
    while not -(1 << LIMB) <= value < 1 << LIMB:
        yield place, value & ((1 << LIMB) - 1)
        value >>= LIMB
        place += 1
    yield place, value


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, j, limb, part): sums of a task's vectors; row (-1, -1) counts them, rows (-1, j) are sums of x_j."""
    count, total, cross = 0, None, None
    for batch in batches:
        vectors = batch.column(0).to_pylist()
        for first in range(0, len(vectors), RUN):
            x = _unpack(vectors[first:first + RUN])
            if total is None:
                total, cross = np.zeros(x.shape[1], dtype=object), np.zeros((x.shape[1],) * 2, dtype=object)
            count += len(x)
            total += _total(x)
            cross += cross_products(x)
    if not count:
        return
    d = len(total)
    values = [(-1, -1, count), *((-1, j, total[j]) for j in range(d)), *((i, j, cross[i, j]) for i in range(d) for j in range(i, d))]
    rows = [(i, j, limb, part) for i, j, value in values for limb, part in _limbs(int(value))]
    i, j, limb, part = zip(*rows)
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(limb, pa.int32()), pa.array(part, pa.int64())],
                                     names=["i", "j", "limb", "part"])


@dataclass(frozen=True)
class Whitener:
    """What whitening needs: count, exact sums, and components by falling variance."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray     # a component a row
    scales: np.ndarray      # one over the root of the variance, 0 without variance
    explained: np.ndarray
    identity_error: float

    @property
    def dimension(self) -> int:
        return len(self.sums)


def solve(n: int, sums: list[int], cross: np.ndarray, components: int = COMPONENTS) -> Whitener:
    """Components of the exact sums and cross-products of n integer vectors."""
    s = np.array(sums, dtype=object)
    centred = n * cross - np.outer(s, s)
    square = n * n
    # the quotient of integers is the nearest double
    cov = np.array([[int(v) / square for v in row] for row in centred], dtype=np.float64)
    trace = sum(int(centred[k, k]) for k in range(len(s))) / square
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order].T
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    vectors = vectors * np.where(signs == 0, 1, signs)[:, None]
    real = values > len(s) * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    scales = np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), 0.0)
    some = vectors[real] * scales[real][:, None]
    error = np.abs(some @ cov @ some.T - np.eye(len(some))).max(initial=0.0)
    explained = np.where(real, values, 0.0) / trace if trace > 0 else np.zeros(len(values))
    return Whitener(n, tuple(int(v) for v in sums), vectors, scales, explained, float(error))


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitener | None:
    """Components of the table's distinct integer vectors; None without any vector.

    The driver gets the d(d + 1)/2 sums, not rows.
    """
    every = vectors.select(packed(F.col(vector)).alias("packed")).where("packed is not null").distinct()
    dimension = F.expr("cast((length(packed) - 1) / shiftleft(1, cast(conv(hex(substring(packed, 1, 1)), 16, 10) as int)) as int)")
    lengths = every.groupBy(dimension.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first() \
        if _ragged(vectors, vector) else None
    if lengths is not None:
        every = every.where(dimension == lengths.d)
    found = every.mapInArrow(_sums, "i int, j int, limb int, part long") \
        .groupBy("i", "j", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect()
    if not found:
        return None
    exact: dict[tuple[int, int], int] = {}
    for r in found:
        exact[r.i, r.j] = exact.get((r.i, r.j), 0) + (int(r.part) << (LIMB * r.limb))
    d = 1 + max(j for _, j in exact)
    cross = np.zeros((d, d), dtype=object)
    for (i, j), value in exact.items():
        if i >= 0:
            cross[i, j] = cross[j, i] = value
    return solve(exact[-1, -1], [exact[-1, j] for j in range(d)], cross, components)


def _ragged(vectors: DataFrame, vector: str) -> bool:
    """If the vectors' lengths differ; reads the lengths alone."""
    ends = vectors.select(F.size(vector).alias("n")).where("n > 0").agg(F.min("n").alias("low"), F.max("n").alias("high")).first()
    return ends.low != ends.high


RESULT = T.ArrayType(T.StructType([
    T.StructField("component", T.IntegerType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType())]))
_FIELDS = RESULT.elementType.names


def _whitened(x: np.ndarray, model: Whitener) -> tuple[list, np.ndarray]:
    """Deviation of each row (None beyond a long) and its whitened values."""
    largest = (np.abs(x).max(initial=0) + 1) * model.n + max(abs(s) for s in model.sums)
    if int(largest) ** 2 * x.shape[1] < 1 << 63:
        away = model.n * x - np.array(model.sums, dtype=np.int64)
        deviation = (away * away).sum(axis=1).tolist()
    else:
        away = model.n * x.astype(object) - np.array(model.sums, dtype=object)
        deviation = [v if v < 1 << 63 else None for v in (away * away).sum(axis=1).tolist()]
    # the division of the exact difference is the only rounding before the projection
    return deviation, (away / model.n).astype(np.float64) @ (model.vectors * model.scales[:, None]).T


def whiten(vectors: DataFrame, model: Whitener | None, vector: str = "embedding", into: str = "found") -> DataFrame:
    """The rows that aren't left out, one per component, with a struct ``into``.

    It has component, n, deviation, whitened, explained and identity_error.
    """
    columns = vectors.columns
    whole = free_name(columns, "_whitened")

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows, x = next(((r, x) for r, x in _integers(column) if x.shape[1] == model.dimension), (np.zeros(0, np.int64), None))
            k = len(model.explained)
            count = np.zeros(len(column), dtype=np.int32)
            count[rows] = k
            deviation, values = _whitened(x, model) if len(rows) else ([], np.zeros(0))
            yield pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32)), pa.StructArray.from_arrays(
                    [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array([v for v in deviation for _ in range(k)], pa.int64()),
                     pa.array(values.ravel()), pa.array(np.tile(model.explained, len(rows)))], names=_FIELDS))

    found = F.lit(None).cast(RESULT) if model is None else run(F.col(vector))
    one = free_name([*columns, whole], "_one")
    rows = vectors.withColumn(whole, found).select(*columns, F.explode(whole).alias(one))
    fixed = (F.lit(None), F.lit(None)) if model is None else (F.lit(model.n), F.lit(model.identity_error))
    return rows.select(*columns, F.struct(
        F.col(f"{one}.component").alias("component"), fixed[0].cast("long").alias("n"), F.col(f"{one}.deviation").alias("deviation"),
        F.col(f"{one}.whitened").alias("whitened"), F.col(f"{one}.explained").alias("explained"),
        fixed[1].cast("double").alias("identity_error")).alias(into))

