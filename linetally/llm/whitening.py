"""Embedding whitening from a bit-sliced scatter.

Entries become integers ``x = floor(256 * c)``; each distinct vector counts once. For
a batch of vectors, every dimension is shifted by its least value in the batch,
and its bit planes are packed across the rows into 64-bit words. The dot product
of two dimensions is then a sum of ``2^(p + q) * popcount(plane p AND plane q)``,
exact in integers, and the shift is taken back out. Batches add up to the sums ``S`` and cross
products ``C`` of all rows; ``n * C - S S'`` is n^2 times their covariance, centred
while still an integer. Only then is it divided, correctly rounded, and given to ``eigh``.

How it runs. The distinct vectors are written once (a partial
aggregate leaves one of each in every task before the shuffle, so copies are no hot
key). A map over them emits one partial scatter a task: d (d + 1) / 2 numbers
for d dimensions, summed by Spark as decimals. The driver gets the summed scatter, whose size
follows from d alone, and keeps up to ``components`` vectors of d numbers; a second map
applies them to all rows. No number depends on how rows are spread over tasks: scatter,
deviations and the sums behind ``identity_error`` are sums of integers.

Results for odd input: rows whose vector is null or holds null or non-finite entries
are left out; repeated rows have a result each; rows with a null id have one, too.
Vectors of different length have no covariance: the length that most usable rows have
(of equally many, the greatest) is the table's, and rows of another have no
result, nor have empty vectors, which have no component. With fewer dimensions than ``components`` there
are as many components as dimensions. A component on which the fit list does not vary
(an eigenvalue below 1e-12 of the trace) cannot be scaled: ``whitened`` is null, and it
does not count in ``identity_error``. Entries of 2^45 and beyond (in x), and deviations beyond a long,
fail the job. Other columns come along unless they have the name of a result; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import carried

SCALE = 256
COMPONENTS = 4
#: Entries beyond this magnitude (of x) are an error: sums over the rows of a batch stay exact.
LIMIT = 1 << 45
#: Rows whose bits are packed at a time: a bound on a task's memory.
STEP = 16_384
#: Eigenvalues below this share of the trace have no direction to scale.
FLAT = 1e-12
#: Binary digits kept of whitened values where they are summed, so that sums have no order.
FIXED = 40

MADE = ("component", "n", "deviation", "whitened", "explained", "identity_error")
_EXACT = pa.decimal128(38, 0)


def usable(vector: Column) -> Column:
    """Not null, with finite entries only."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def quantised(vector: Column) -> Column:
    """``floor(256 * c)`` of each entry, as long."""
    def one(c: Column) -> Column:
        x = F.floor(c * F.lit(float(SCALE)))
        return F.when(F.abs(c) >= float(LIMIT // SCALE), F.raise_error(F.lit("entry too large")).cast("long")).otherwise(x)

    return F.transform(vector, one)


def bit_planes(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bit planes of the columns of ``u`` (no entry negative): words (planes x
    words), and each plane's dimension and bit."""
    rows, dims = u.shape
    bits = max(1, int(u.max(initial=0)).bit_length())
    words = -(-rows // 64)
    planes, of, at = [], [], []
    full = np.zeros((dims, words * 64), np.uint8)
    for p in range(bits):
        full[:, :rows] = ((u >> p) & 1).T
        some = np.flatnonzero(full.any(axis=1))
        planes.append(np.packbits(full[some], axis=1).view(np.uint64))
        of.append(some)
        at.append(np.full(len(some), p))
    return np.concatenate(planes), np.concatenate(of), np.concatenate(at)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums (d) and cross products (d x d) of the rows of ``x``, as Python integers."""
    low = x.min(axis=0)
    u = x - low
    planes, of, at = bit_planes(u)
    met = np.zeros((len(planes), len(planes)), np.int64)
    for k in range(len(planes)):
        met[k, k:] = np.bitwise_count(planes[k] & planes[k:]).sum(axis=1, dtype=np.int64)
    met = met + np.triu(met, 1).T
    weight = np.zeros((x.shape[1], len(planes)), object)
    weight[of, np.arange(len(planes))] = [1 << int(p) for p in at]
    if len(at) and 2 * int(at.max()) + 2 + len(x).bit_length() < 62:
        weight = weight.astype(np.int64)
    cross = (weight @ met @ weight.T).astype(object)
    sums = u.sum(axis=0).astype(object)
    low = low.astype(object)
    n = len(x)
    cross = cross + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)
    return sums + n * low, cross


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dims)


def exact_moments(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """``n``, ``S`` and ``C`` of the distinct vectors (column ``x``). An action; the driver gets d (d + 3) / 2 + 1 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                x = _matrix(batch.column(0)[at: at + STEP], dims)
                s, c = scatter(x)
                n, sums, cross = n + len(x), sums + s, cross + c
        if n:
            i, j = np.triu_indices(dims)
            keys = [np.concatenate([i, np.arange(dims), [-1]]), np.concatenate([j, np.full(dims, -1), [-1]])]
            values = [*cross[i, j], *sums, n]
            yield pa.RecordBatch.from_arrays([*[pa.array(k, pa.int32()) for k in keys],
                                              pa.array([Decimal(int(v)) for v in values], _EXACT)], names=["i", "j", "v"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, v decimal(38,0)")
    total = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    n, sums, cross = 0, [0] * dims, np.zeros((dims, dims), object)
    for i, j, v in total:
        if j >= 0:
            cross[i, j] = cross[j, i] = int(v)
        elif i >= 0:
            sums[i] = int(v)
        else:
            n = int(v)
    return n, sums, cross


@dataclass
class Whitening:
    """Mean (``sums / n``), components (unit rows, by falling eigenvalue), eigenvalues and their
    shares of the trace; the scale of a flat component is None."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: list[float]
    explained: list[float]
    scales: list[float | None]
    identity_error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values (rows x components); NaN on flat components. Each row is summed by itself."""
        centred = x - np.array([s / self.n for s in self.sums])
        out = np.empty((len(x), len(self.vectors)))
        for k, (v, scale) in enumerate(zip(self.vectors, self.scales)):
            out[:, k] = (centred * v).sum(axis=1) / scale if scale else np.nan
        return out

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if most * most * max(1, x.shape[1]) < 1 << 62 else object
        d = x.astype(kind) * self.n - np.array(self.sums, kind)
        return [int(v) for v in (d * d).sum(axis=1)]


def fit(n: int, sums: Sequence[int], cross: np.ndarray, components: int = COMPONENTS) -> Whitening:
    """Components of the covariance: centred as integers, divided once, then ``eigh``."""
    s = np.array([int(v) for v in sums], object)
    centred = n * cross - np.outer(s, s)
    cov = np.array([[int(v) / (n * n) for v in row] for row in centred], float).reshape(len(s), len(s))
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(sum(int(v) for v in np.diag(centred)) / (n * n))
    kept = [max(0.0, float(values[k])) for k in order]
    return Whitening(n, [int(v) for v in sums], vectors[:, order].T.copy(), kept, [e / trace if trace else 0.0 for e in kept],
                     [math.sqrt(e) if trace and e > FLAT * trace else None for e in kept])


def measured_error(distinct: DataFrame, dims: int, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on its
    rows: means first, then products of centred values, both as sums of fixed-point integers. Two actions."""
    live = [k for k, s in enumerate(model.scales) if s]
    if not live:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.project(_matrix(batch.column(0), dims))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in live], names=[f"w{k}" for k in live])

    whitened = materialize(distinct.select("x").mapInArrow(run, ", ".join(f"w{k} double" for k in live)), "whitening-fit")
    fixed = lambda c: F.sum((c * F.lit(2.0**FIXED)).cast("decimal(38,0)"))
    unit = model.n * 2**FIXED
    means = [int(v) / unit for v in whitened.agg(*[fixed(F.col(f"w{k}")).alias(f"m{k}") for k in live]).first()]
    centred = {k: F.col(f"w{k}") - F.lit(m) for k, m in zip(live, means)}
    pairs = [(a, b) for a in live for b in live if a <= b]
    sums = whitened.agg(*[fixed(centred[a] * centred[b]).alias(f"p{a}_{b}") for a, b in pairs]).first()
    return max(abs(int(v) / unit - (a == b)) for (a, b), v in zip(pairs, sums))


def fit_vectors(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors (column ``x``) of ``rows``. Writes them; a few actions."""
    distinct = materialize(rows.select("x").distinct(), "whitening-distinct")
    n, sums, cross = exact_moments(distinct, dims)
    model = fit(n, sums, cross, components)
    model.identity_error = measured_error(distinct, dims, model)
    return model


def whiten(vectors: DataFrame, vector: str = "embedding", columns: Sequence[str] | None = None,
           components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component: ``columns`` of ``vectors`` (default all but the vector),
    ``component`` (from 1, by falling eigenvalue), ``n``, ``deviation``, ``whitened``, ``explained`` and
    ``identity_error``; input columns of these names are replaced."""
    keep = [c for c in carried(vectors, MADE, columns) if columns is not None or c != vector]
    kept = [F.col(f"`{c}`") for c in keep]
    entries = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.where(usable(entries)).select(*kept, quantised(entries).alias("x"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = ", ".join([kinds] * bool(kinds) + ["component int", "n long", "deviation long", "whitened double", "explained double",
                                                "identity_error double"])
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None or not common["d"]:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = common["d"]
    rows = rows.where(F.size("x") == dims)
    model = fit_vectors(rows, dims, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(batch.num_columns - 1), dims)
            c, m = len(model.vectors), batch.num_rows
            index = pa.array(np.repeat(np.arange(m), c))
            w = model.project(x).ravel()
            made = [np.tile(np.arange(1, c + 1, dtype=np.int32), m), np.full(m * c, model.n), np.repeat(model.deviations(x), c)]
            yield pa.RecordBatch.from_arrays(
                [*[col.take(index) for col in batch.columns[:-1]], *map(pa.array, made), pa.array(w, mask=np.isnan(w)),
                 pa.array(np.tile(model.explained, m)), pa.array([model.identity_error] * (m * c), pa.float64())],
                names=[*keep, *MADE])

    return rows.mapInArrow(run, schema)
