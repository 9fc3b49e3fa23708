"""Embedding whitening by incremental eigendecomposition.

Every task reads its vectors once and keeps one spectrum (count, mean,
eigenvalues, eigenvectors): a vector is a centred rank-one update of it, solved
through the secular equation with deflation (``secular``). The tasks' spectra
are combined by further rank-one updates, ``fan`` of them a group and round, so
no task and never the driver holds more than a few spectra. The combined basis
is then refined: one pass adds up the covariance seen in it (centred before
multiplying), and the small matrix's eigenvectors turn the basis (Rayleigh-Ritz
over the whole basis, as neighbouring eigenvalues may lie close together). What
reaches the driver is one square matrix of the vectors' length, whatever the
number of rows.

Vectors are taken as integers, ``floor(scale * c) + shift``, so sums and
deviations are exact. Centred rows come from ``n * x - sum``, which is exact.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are left out; vectors of each length are a fit list of their own (with
their own n and components); entries beyond 2**40 / scale in magnitude count as
that bound; a component without variance (fewer vectors than directions, equal
vectors) has a null ``whitened``, and a fit list without any variance null
``explained`` and ``identity_error``; a deviation of more than 38 digits is
null; repeated rows and null ids are rows like others; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from quarry.llm.secular import Spectrum
from quarry.llm.store import keep

BOUND = 1 << 40
PARTIAL = "part long, size int, n long, sums array<decimal(38,0)>, mean array<double>, values array<double>, matrix binary"
ROWS = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double")


@dataclass(frozen=True)
class Params:
    components: int = 8
    scale: float = 1024.0
    shift: int = 100_000
    flat: float = 1e-12  # share of the largest eigenvalue up to which a component has no variance
    fan: int = 16        # partial results that one task combines at once


@dataclass
class Model:
    """One fit list: count, exact sums, and per component the direction, its
    share of the variance, and the divisor (0: no variance)."""
    n: int
    sums: list[int]
    directions: np.ndarray
    explained: np.ndarray
    deviation: np.ndarray


def _entries(batch: pa.RecordBatch, p: Params):
    """(rows, integer vectors) of the usable vectors of each length."""
    col = batch.column("embedding")
    size = np.asarray(pc.fill_null(pc.list_value_length(col), 0)).astype(np.int64)
    flat = np.asarray(pc.fill_null(col.flatten(), float("nan")))
    at = np.concatenate([[0], np.cumsum(size)])
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = (size > 0) & (odd[at[1:]] == odd[at[:-1]])
    for s in np.unique(size[good]):
        rows = np.flatnonzero(good & (size == s))
        x = np.floor(p.scale * flat[at[rows][:, None] + np.arange(s)])
        yield rows, np.clip(x, -BOUND, BOUND).astype(np.int64) + p.shift


def _partial(size, n, sums=None, mean=None, values=None, matrix=None, part=None) -> pa.RecordBatch:
    kind = pa.schema([("part", pa.int64()), ("size", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0))),
                      ("mean", pa.list_(pa.float64())), ("values", pa.list_(pa.float64())), ("matrix", pa.binary())])
    part = TaskContext.get().partitionId() if part is None else part
    row = [part, size, n, None if sums is None else [Decimal(int(x)) for x in sums], mean, values,
           None if matrix is None else np.ascontiguousarray(matrix, dtype=np.float64).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, kind)], schema=kind)


def _fit(batches, p: Params):
    spectra: dict[int, Spectrum] = {}
    sums: dict[int, list[int]] = {}
    for batch in batches:
        for _, x in _entries(batch, p):
            s = spectra.setdefault(x.shape[1], Spectrum(x.shape[1]))
            total = sums.setdefault(x.shape[1], [0] * x.shape[1])
            sums[x.shape[1]] = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
            for row in (x - p.shift).astype(np.float64):
                s.add(row)
    for size, s in spectra.items():
        yield _partial(size, s.n, sums[size], s.mean, s.values, s.vectors)


def _join_spectra(table: pa.Table) -> pa.Table:
    total, sums = None, None
    for r in table.sort_by("was").to_pylist():
        s = Spectrum.of(r["n"], np.array(r["mean"]), np.array(r["values"]), np.frombuffer(r["matrix"]).reshape(r["size"], -1))
        if total is None:
            total, sums = s, r["sums"]
        else:
            total.merge(s)
            sums = [a + b for a, b in zip(sums, r["sums"])]
    return pa.Table.from_batches([_partial(r["size"], total.n, sums, total.mean, total.values, total.vectors, r["part"])])


def _join_sums(table: pa.Table) -> pa.Table:
    """Matrices of sums of products around their own means: Chan's combination."""
    n, mean, matrix = 0, 0.0, 0.0
    for r in table.sort_by("was").to_pylist():
        m, k = np.array(r["mean"]), len(r["mean"])
        away, both = m - mean, n + r["n"]
        matrix = matrix + np.frombuffer(r["matrix"]).reshape(k, k) + np.outer(away, away) * (n * r["n"] / both)
        mean, n = mean + away * (r["n"] / both), both
    return pa.Table.from_batches([_partial(r["size"], n, None, mean, None, matrix, r["part"])])


def _combined(parts: DataFrame, join, name: str, p: Params) -> list:
    """One row for each length: neighbouring parts are joined, ``fan`` a group and round."""
    parts = keep(parts, name)
    while not parts.groupBy("size").agg(F.count("*").alias("k")).where("k > 1").isEmpty():
        parts = keep(parts.withColumn("was", F.col("part")).withColumn("part", F.floor(F.col("part") / p.fan))
                     .groupBy("size", "part").applyInArrow(join, PARTIAL), name)
    return parts.collect()


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: in 64 bits where they hold it, else in Python's integers."""
    if n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums), default=0) < 1 << 62:
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _products(batches, bases: dict, p: Params):
    """Sums of products of the rows seen in ``bases`` (length: n, sums, directions)."""
    state: dict[int, tuple] = {}
    for batch in batches:
        for _, x in _entries(batch, p):
            size = x.shape[1]
            n, sums, basis = bases[size]
            y = (_centred(x, n, sums).astype(np.float64) / n) @ basis
            m = y.mean(axis=0)
            c = y - m
            at, mean, matrix = state.get(size, (0, np.zeros(len(m)), np.zeros((len(m), len(m)))))
            away, both = m - mean, at + len(y)
            state[size] = (both, mean + away * (len(y) / both), matrix + c.T @ c + np.outer(away, away) * (at * len(y) / both))
    for size, (n, mean, matrix) in state.items():
        yield _partial(size, n, None, mean, None, matrix)


def _covariances(rows: DataFrame, bases: dict, name: str, p: Params) -> dict[int, np.ndarray]:
    parts = rows.mapInArrow(lambda it: _products(it, bases, p), PARTIAL)
    return {r["size"]: np.frombuffer(r["matrix"]).reshape(len(r["mean"]), -1) / r["n"]
            for r in _combined(parts, _join_sums, name, p)}


def fit(vectors: DataFrame, p: Params = Params(), col: str = "embedding") -> dict[int, Model]:
    """A model for each length of vectors."""
    rows = vectors.select(F.col(col).cast("array<double>").alias("embedding"))
    found = _combined(rows.mapInArrow(lambda it: _fit(it, p), PARTIAL), _join_spectra, "whitening-spectra", p)
    bases = {}
    for r in found:
        basis, _ = np.linalg.qr(np.frombuffer(r["matrix"]).reshape(r["size"], -1)[:, ::-1])
        bases[r["size"]] = (r["n"], [int(x) for x in r["sums"]], basis)
    models = {}
    for size, seen in _covariances(rows, bases, "whitening-ritz", p).items():
        n, sums, basis = bases[size]
        values, turn = np.linalg.eigh(seen)
        top = np.argsort(-values, kind="stable")[:p.components]
        e, trace = np.maximum(values[top], 0), float(np.trace(seen))
        there = e > p.flat * max(e[0], 0)
        models[size] = Model(n, sums, basis @ turn[:, top], e / trace if trace > 0 else np.full(len(top), np.nan),
                             np.where(there, np.sqrt(e), 0))
    return models


def _whitened(y: np.ndarray, m: Model) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(m.deviation > 0, (y.astype(np.float64) / m.n) @ m.directions / m.deviation, np.nan)


def identity_errors(vectors: DataFrame, models: dict[int, Model], p: Params = Params(), col: str = "embedding") -> dict[int, float]:
    """For each length the largest entry of the whitened vectors' covariance
    minus the identity, over the components that have variance."""
    bases = {s: (m.n, m.sums, m.directions[:, m.deviation > 0] / m.deviation[m.deviation > 0])
             for s, m in models.items() if (m.deviation > 0).any()}
    rows = vectors.select(F.col(col).cast("array<double>").alias("embedding")).where(F.size("embedding").isin(*bases))
    return {s: float(np.abs(c - np.eye(len(c))).max())
            for s, c in _covariances(rows, bases, "whitening-identity", p).items()} if bases else {}


def _apply(batches, models: dict[int, Model], errors: dict[int, float], p: Params):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.float64(), pa.float64(), pa.float64()]
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for batch in batches:
        for rows, x in _entries(batch, p):
            m = models[x.shape[1]]
            y = _centred(x, m.n, m.sums)
            k = len(m.deviation)
            if y.dtype != object and len(y) and int(np.abs(y).max()) ** 2 * x.shape[1] < 1 << 62:
                squares = pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                sums = [int(s) for s in (y.astype(object) ** 2).sum(axis=1)]
                squares = pa.array([Decimal(s) if s < 10 ** 38 else None for s in sums], pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(len(rows)), k))
            full = lambda v: pa.array(np.tile(v, len(rows)), from_pandas=True)
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip((
                batch.column("vec_id").take(pa.array(rows)).take(each), full(np.arange(1, k + 1)), full(np.full(k, m.n)),
                squares.take(each), pa.array(_whitened(y, m).ravel(), from_pandas=True), full(m.explained),
                full(np.full(k, errors.get(x.shape[1], np.nan)))), kinds)], names)


def whiten(vectors: DataFrame, p: Params = Params(), id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error):
    a row for each usable vector and component."""
    models = fit(vectors, p, col)
    errors = identity_errors(vectors, models, p, col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(col).cast("array<double>").alias("embedding"))
    return rows.mapInArrow(lambda it: _apply(it, models, errors, p), ROWS)
