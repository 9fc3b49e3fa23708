"""Embedding near-dedup by collision counting on one-dimensional projections.

Every vector is scaled to length 1 and projected on ``count`` random directions.
For two vectors of cosine c the projections differ by a normal variable with
standard deviation sqrt(2 - 2 c), so at the threshold a window of ``width`` such
deviations around a query's projection holds the other one with a known chance;
the count that a pair must reach is the largest that pairs at the threshold miss
with less than ``miss`` probability. Pairs that reach it are verified by their
cosine in double precision.

To keep this from being all pairs, vectors first meet in the cells of ``tables``
grids, each over a few further projections; the number of projections grows with
the logarithm of the number of vectors, so a cell's expected size stays the
same, and the number of tables follows from ``recall`` at the threshold. In a
cell the members are sorted on one projection and each is compared with those in
its window. Exactly equal vectors are one vector with a multiplicity. A cell
with more than ``cell`` members is cut into blocks whose pairs are separate
tasks, so none is dropped and none meets in one task as a whole. A pair that
shares several cells counts in the first of them.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different lengths do not link; rows
with one vec_id are one vector (of several different ones the largest counts);
a null vec_id is passed on without links, kept; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, comb, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.components import components, forest
from quarry.llm.store import keep


@dataclass(frozen=True)
class Params:
    cosine: float = 0.9
    count: int = 16       # projections whose collisions are counted
    width: float = 2.0    # half-width of a window, in standard deviations at the threshold
    miss: float = 1e-3    # share of pairs at the threshold that the count may miss
    recall: float = 0.99  # chance that a pair at the threshold shares a cell
    grid: float = 2.0     # width of a grid cell; a projection of a random vector has deviation 1
    cell: int = 2048      # members of a cell that are compared in one task
    seed: int = 41

    @property
    def spread(self) -> float:
        return sqrt(2 - 2 * self.cosine)


def same_cell(spread: float, grid: float) -> float:
    """Chance that two projections with a normal difference share a cell of a
    randomly shifted grid."""
    a = grid / spread
    return erf(a / sqrt(2)) - 2 / (sqrt(2 * pi) * a) * (1 - exp(-a * a / 2))


def plan(n: int, p: Params) -> tuple[int, int, int]:
    """(projections of a grid, tables, collisions needed) for ``n`` vectors."""
    k = max(1, ceil(log(max(n / p.cell, 2)) / -log(same_cell(sqrt(2), p.grid))))
    tables = ceil(log(1 - p.recall) / log(1 - same_cell(p.spread, p.grid) ** k))
    hit, need, lost = erf(p.width / sqrt(2)), 0, 0.0
    for c in range(p.count + 1):
        lost += comb(p.count, c) * hit ** c * (1 - hit) ** (p.count - c)
        if lost >= p.miss:
            need = c
            break
    return k, tables, need


def _matrix(col: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in col), dtype=np.float64).reshape(-1, size)


def _units(batches):
    """Length, and the vector scaled to length 1, of every usable row."""
    for batch in batches:
        ids, size, unit = [], [], []
        for i, v in zip(batch.column("vec_id"), batch.column("embedding")):
            v = v.values
            if v is None or len(v) == 0 or v.null_count:
                continue
            x = np.asarray(v, dtype=np.float64)
            top = np.abs(x).max()
            if not np.isfinite(top) or top == 0:
                continue
            x = x / top
            ids.append(i.as_py())
            size.append(len(x))
            unit.append((x / sqrt(float(x @ x)) + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(size, pa.int32()), pa.array(unit, pa.binary())],
                                         ["vec_id", "size", "unit"])


def _directions(size: int, n: int, p: Params) -> np.ndarray:
    return np.random.default_rng([p.seed, size]).normal(size=(size, n))


def _cells(batches, k: int, tables: int, p: Params):
    """The number of each vector's cell in every table."""
    for batch in batches:
        size = np.asarray(batch.column("size"))
        cells = np.zeros((len(size), tables), dtype=np.int64)
        for s in np.unique(size):
            rows = np.flatnonzero(size == s)
            x = _matrix(batch.column("unit").take(pa.array(rows)), int(s))
            d = _directions(int(s), p.count + 1 + k * tables, p)[:, p.count + 1:]
            shift = np.random.default_rng([p.seed, int(s), 1]).uniform(0, p.grid, k * tables)
            at = np.floor((x @ d + shift) / p.grid).astype(np.int64).reshape(len(rows), tables, k)
            code = np.full((len(rows), tables), int(s), dtype=np.int64)
            for i in range(k):
                code = code * 1_000_003 + at[:, :, i]
            cells[rows] = code
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), batch.column("n"), batch.column("size"), batch.column("unit"),
             pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * tables, pa.int32()), pa.array(cells.ravel()))],
            ["rep", "n", "size", "unit", "cells"])


def _compare(table: pa.Table, need: int, p: Params) -> pa.Table:
    """Links within one cell, or between two blocks of one: (a, n, b) with the
    links of a (b null), and (a, null, b) of a spanning forest."""
    table = table.combine_chunks()
    t, i, j = (table[c][0].as_py() for c in ("t", "i", "j"))
    size = table["size"][0].as_py()
    rep, weight, block = (table[c].to_numpy() for c in ("rep", "n", "block"))
    x = _matrix(table["unit"].combine_chunks() if isinstance(table["unit"], pa.ChunkedArray) else table["unit"], size)
    cells = table["cells"].combine_chunks()
    cells = np.asarray(cells.flatten()).reshape(len(rep), -1)[:, :t]
    proj = (x @ _directions(size, p.count + 1, p)[:, :p.count + 1]).astype(np.float32)
    order = np.argsort(proj[:, p.count], kind="stable")
    rep, weight, block, x, cells, proj = rep[order], weight[order], block[order], x[order], cells[order], proj[order]
    sort, reach, window = proj[:, p.count], np.float32(3 * p.spread + 1e-5), np.float32(p.width * p.spread)
    links = np.zeros(len(rep), dtype=np.int64)
    a_parts, b_parts = [], []
    for q in range(0, len(rep), 128):
        r = min(q + 128, len(rep))
        hi = int(np.searchsorted(sort, sort[r - 1] + reach, side="right"))
        # each pair once: the later one in the order stands right of the diagonal
        fits = np.arange(q, hi)[None, :] > np.arange(q, r)[:, None]
        if i != j:
            fits &= block[q:r, None] != block[None, q:hi]
        for c in range(t):
            fits &= cells[q:r, c, None] != cells[None, q:hi, c]
        if not fits.any():
            continue
        hits = np.zeros(fits.shape, dtype=np.int8)
        for c in range(p.count):
            hits += np.abs(proj[q:r, c, None] - proj[None, q:hi, c]) <= window
        u, v = np.nonzero(fits & (hits >= need))
        u, v = u + q, v + q
        for s in range(0, len(u), 50_000):
            uu, vv = u[s:s + 50_000], v[s:s + 50_000]
            near = np.einsum("ij,ij->i", x[uu], x[vv]) >= p.cosine
            uu, vv = uu[near], vv[near]
            np.add.at(links, uu, weight[vv])
            np.add.at(links, vv, weight[uu])
            a, b = forest(rep[uu], rep[vv])
            a_parts.append(a)
            b_parts.append(b)
    a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a_parts, b_parts))
    a, b = forest(a, b)
    some = np.flatnonzero(links)
    none = lambda n: pa.nulls(n, pa.int64())
    return pa.table({"a": pa.array(np.concatenate([rep[some], a])),
                     "n": pa.concat_arrays([pa.array(links[some]), none(len(a))]),
                     "b": pa.concat_arrays([none(len(some)), pa.array(b)])})


def links(vectors: DataFrame, p: Params = Params(), id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(col).cast("array<double>").alias("embedding"))
    units = keep(rows.where("vec_id IS NOT NULL").mapInArrow(_units, "vec_id long, size int, unit binary")
                 .groupBy("vec_id").agg(F.max(F.struct("size", "unit")).alias("u")).select("vec_id", "u.*"), "vectors-units")
    classes = units.groupBy("size", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    total = units.count()
    k, tables, need = plan(total, p)
    classes = keep(classes.mapInArrow(lambda it: _cells(it, k, tables, p),
                                      "rep long, n long, size int, unit binary, cells array<long>"), "vectors-classes")
    big = (classes.select(F.posexplode("cells").alias("t", "cell")).groupBy("t", "cell").agg(F.count("*").alias("members"))
           .where(F.col("members") > p.cell).withColumn("blocks", F.ceil(F.col("members") / p.cell).cast("int")).drop("members"))
    met = (classes.select("*", F.posexplode("cells").alias("t", "cell")).join(big, ["t", "cell"], "left")
           .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
           .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("t", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                   "block", "rep", "n", "size", "unit", "cells"))
    # dealt anew: a join by (t, cell) would leave all block pairs of a cell in one task
    met = met.repartition("t", "cell", "i", "j")
    found = keep(met.groupBy("t", "cell", "i", "j").applyInArrow(lambda g: _compare(g, need, p), "a long, n long, b long"),
                 "vectors-links")
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n_links"))
    label = components(found.where("b IS NOT NULL").select("a", "b"), "vectors")
    each = (classes.select("rep", "n").join(counts, "rep", "left").join(label.withColumnRenamed("vertex", "rep"), "rep", "left")
            .select("rep", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                    F.coalesce("component", "rep").alias("component")))
    member = units.join(classes.select("size", "unit", "rep"), ["size", "unit"]).select("vec_id", "rep")
    known = member.join(each, "rep").select("vec_id", "n_links", "component")
    out = (rows.where("vec_id IS NOT NULL").select("vec_id").distinct().join(known, "vec_id", "left")
           .union(rows.where("vec_id IS NULL").select("vec_id", F.lit(None).cast("long"), F.lit(None).cast("long"))))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component", "vec_id").alias("component_id"),
                      F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
