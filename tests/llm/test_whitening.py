"""Whitening against a plain eigendecomposition, and on odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.llm import queries, whitening
from quarry.llm.secular import Spectrum, roots
from quarry.llm.store import read_table

KIND = "vec_id long, embedding array<double>, n int, part string, size long"


def plain(x):
    """n, exact deviations, eigenvalues falling, eigenvectors of integer rows."""
    n, s = len(x), [int(v) for v in x.sum(axis=0)]
    dev = [sum((n * int(v) - t) ** 2 for v, t in zip(r, s)) for r in x]
    c = x - np.array(s, dtype=float) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    return n, dev, e[::-1], v[:, ::-1], c


def check(got, ids, x, k=8):
    n, dev, e, v, c = plain(x)
    k = min(k, x.shape[1])
    assert len(got) == len(ids) * k
    by = {(r.vec_id, r.component): r for r in got}
    for j in range(k):
        w = np.array([by[i, j + 1].whitened for i in ids])
        want = c @ v[:, j] / math.sqrt(e[j])
        assert min(np.abs(w - want).max(), np.abs(w + want).max()) < 1e-7
        assert all(by[i, j + 1].explained == pytest.approx(e[j] / e.sum(), rel=1e-9) for i in ids)
    assert all(by[i, 1].n == n and int(by[i, 1].deviation) == d for i, d in zip(ids, dev))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_secular_roots_interlace():
    rng = np.random.default_rng(1)
    for _ in range(200):
        m = int(rng.integers(1, 12))
        d = np.sort(rng.uniform(0, 1, m)).cumsum() * 10.0 ** rng.integers(-6, 6)
        w = rng.uniform(0, 1, m) ** 6 * 10.0 ** rng.integers(-6, 6) + 1e-12
        x, gap = roots(d, w)
        assert (x >= d).all() and (x[:-1] <= d[1:]).all()
        assert x.sum() == pytest.approx(d.sum() + w.sum(), rel=1e-9)


@pytest.mark.parametrize("size", [1, 2, 7, 40])
def test_spectrum_of_rows_and_merges(size):
    rng = np.random.default_rng(size)
    x = np.floor(rng.normal(size=(300, size)) * 50)
    x[50:120] = x[3]  # copies
    x[:, -1] = x[:, 0]  # a direction without variance
    parts = []
    for rows in np.array_split(x, 3):
        parts.append(Spectrum(size))
        for r in rows:
            parts[-1].add(r)
    total = parts[0]
    for s in parts[1:]:
        total.merge(s)
    c = x - x.mean(axis=0)
    assert np.abs(total.vectors.T @ total.vectors - np.eye(size)).max() < 1e-12
    assert np.abs(total.vectors * total.values @ total.vectors.T - c.T @ c).max() < 1e-11 * max(total.values[-1], 1)


def test_whitening_equals_eigendecomposition(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 24)) * np.linspace(3, 0.2, 24)
    x[100:300] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [1.0, None] * 12), (903, [float("nan")] * 24), (904, [float("inf")] * 24), (905, [2.0, 3.0])]
    frame = spark.createDataFrame([(*r, 1, "p", 2) for r in rows], KIND).repartition(9)
    for p in (whitening.Params(), whitening.Params(fan=2)):
        got = whitening.whiten(frame, p).collect()
        check([r for r in got if r.vec_id < 600], range(600), np.floor(1024 * x) + 100_000)
        one = [r for r in got if r.vec_id == 905]  # a length of its own, a single vector
        assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [
            (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
        assert {r.vec_id for r in got} == {*range(600), 905}


def test_whitening_odd_tables(spark):
    table = lambda rows: spark.createDataFrame([(i, v, 1, "p", 2) for i, v in rows], KIND)
    assert whitening.whiten(table([(1, None)])).count() == 0
    assert whitening.whiten(table([(1, None)]).where("false")).count() == 0
    got = whitening.whiten(table([(None, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 5.0])])).collect()
    assert len(got) == 8 and sum(r.vec_id is None for r in got) == 2
    assert all((r.whitened is None) == (r.component == 2) for r in got) and all(r.explained in (0, 1) for r in got)
    big = whitening.whiten(table([(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [3e8, 1.0])])).collect()
    x = np.array([[1 << 40, 0], [-(1 << 40), 0], [int(3e8 * 1024), 1024]], dtype=object)
    want = [sum((3 * int(v) - int(s)) ** 2 for v, s in zip(r, x.sum(axis=0))) for r in x]
    assert [int(r.deviation) for r in sorted(big, key=lambda r: r.vec_id) if r.component == 1] == want


def test_whitening_query(spark):
    rows = read_table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding").collect()
    x = np.floor(1024 * np.array([r.embedding for r in rows], dtype=np.float64)) + 100_000
    out = queries.op11_whitening(spark, SF_SMALL)
    assert dict(out.dtypes)["deviation"] == "bigint"
    check(out.collect(), [r.vec_id for r in rows], x)
