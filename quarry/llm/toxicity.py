"""Toxicity: a factorization machine over hashed terms.

A text is the set of its terms (letter and digit runs, A-Z lower-cased) and of
the first 4 and 5 bytes of longer ones, which endings do not change; each is
hashed to one of ``2**hash_bits`` columns. The model is

    b + sum_i w_i + sum_{i<j} <v_i, v_j>     over the columns present,

so a pair of terms (an insult and the mention of a group) has a weight of its
own that additive weights cannot give. Columns are picked and weights learned
from at most ``max_rows`` labelled texts; scoring reads every text whole.

Defined results: null text is an empty text; an empty text scores the bias;
without labelled rows of both kinds every score is 0.0; a null id is scored and
never learned from; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.store import id_text, keep, one_each
from quarry.llm.textbytes import LOWER_CODE, TERM, WORDS, distinct, mix, pieces, word_ranges

STEMS = (4, 5)  # bytes of a term that count as its stem


@dataclass
class Params:
    hash_bits: int = 26      # columns that a term is hashed to
    max_rows: int = 12_000   # labelled texts learned from: the smallest by a hash of the id
    max_columns: int = 4096  # columns with a weight for being telling by themselves, by G-test
    common: int = 512        # further columns, the commonest: a term may tell only together with another
    min_rows: int = 4        # learned texts that a column must occur in
    rank: int = 8            # length of the vectors v_i
    epochs: int = 14
    rate: float = 0.08
    decay: float = 2e-4
    positive: float = 3.0    # weight of a toxic text's loss, the rarer label
    seed: int = 5


@dataclass
class Machine:
    columns: np.ndarray  # sorted hashed columns
    w: np.ndarray
    v: np.ndarray
    bias: float
    hash_bits: int

    def raw(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores before the logistic function of rows given as distinct columns."""
        rows = len(at) - 1
        if len(self.columns) == 0 or len(value) == 0:
            return np.full(rows, self.bias)
        k = np.minimum(np.searchsorted(self.columns, value), len(self.columns) - 1)
        hit = np.flatnonzero(self.columns[k] == value)
        row = np.searchsorted(at, hit, side="right") - 1
        return self._sum(k[hit], row, rows)

    def _sum(self, k: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        out = self.bias + np.bincount(row, self.w[k], rows)
        for f in range(self.v.shape[1]):
            x = self.v[k, f]
            out += 0.5 * (np.bincount(row, x, rows) ** 2 - np.bincount(row, x * x, rows))
        return out


def hashed(data: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed columns of each text, and the rows' offsets."""
    start, end, at = word_ranges(data, off, TERM[data])
    sums = WORDS.sums(data, LOWER_CODE)
    parts, rows = [WORDS.of(sums, start, end)], [np.repeat(np.arange(len(at) - 1), np.diff(at))]
    for n in STEMS:
        long = end - start > n
        parts.append(mix(WORDS.of(sums, start[long], start[long] + n) + np.uint64(n)))
        rows.append(rows[0][long])
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return distinct(np.concatenate(parts)[order] >> np.uint64(64 - bits),
                    np.searchsorted(row[order], np.arange(len(at))))


def _columns(batches, bits: int):
    """The distinct hashed columns of each labelled text."""
    for batch in batches:
        for rows, data, off in pieces(batch, "text"):
            value, at = hashed(data, off, bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[rows.start:rows.stop], batch.column("label")[rows.start:rows.stop],
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(value.astype(np.int32)))],
                ["doc_id", "label", "columns"])


def _picked(batches, cols: np.ndarray):
    """The same lists with the picked columns only, as their numbers."""
    for batch in batches:
        c = batch.column("columns")
        value, at = np.asarray(c.flatten()), np.concatenate([[0], np.cumsum(np.diff(np.asarray(c.offsets)))])
        k = np.minimum(np.searchsorted(cols, value), max(len(cols) - 1, 0))
        hit = cols[k] == value if len(cols) else np.zeros(len(value), dtype=bool)
        to = np.concatenate([[0], np.cumsum(hit)])[at]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"),
             pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(k[hit].astype(np.int32)))],
            ["doc_id", "label", "columns"])


def _telling(rows: DataFrame, p: Params) -> np.ndarray:
    """Sorted columns that tell the labels apart best (G-test on presence), and
    the commonest of the others, which may matter in pairs only."""
    total, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < positive < total:
        return np.zeros(0, np.int64)
    share = positive / total
    n, pos = F.col("n"), F.col("pos")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g = (part(pos, n * share) + part(n - pos, n * (1 - share)) + part(positive - pos, (total - n) * share)
         + part(total - n - positive + pos, (total - n) * (1 - share)))
    seen = (rows.select("label", F.explode("columns").alias("c")).groupBy("c")
            .agg(F.count("*").alias("n"), F.sum("label").alias("pos")).where(n >= p.min_rows)
            .where(n < total).select("c", "n", g.alias("g")))
    seen = keep(seen, "toxicity-columns")
    best = (seen.where("g >= 5.4")  # half of chi-square's 0.1 % point for one degree of freedom
            .orderBy(F.desc("g"), "c").limit(p.max_columns).select("c"))
    often = seen.where("g < 5.4").orderBy(F.desc("n"), "c").limit(p.common).select("c")
    return np.sort(np.array([r["c"] for r in best.union(often).collect()], dtype=np.int64))


def learn(y: np.ndarray, k: np.ndarray, start: np.ndarray, cols: np.ndarray, p: Params) -> Machine:
    """Fit by mini-batch Adagrad on the logistic loss; row i has the columns
    numbered ``k[start[i]:start[i + 1]]``."""
    if len(y) == 0 or y.min() == y.max():
        return Machine(np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, p.rank)), -745.0, p.hash_bits)
    rng = np.random.default_rng(p.seed)
    m = Machine(cols.astype(np.uint64), np.zeros(len(cols)), rng.normal(0, 0.02, (len(cols), p.rank)),
                float(np.log(y.mean() / (1 - y.mean()))), p.hash_bits)
    if len(cols) == 0:
        return m
    gw, gv, gb = np.full(len(cols), 1e-3), np.full(m.v.shape, 1e-3), 1e-3
    for _ in range(p.epochs):
        order = rng.permutation(len(y))
        for a in range(0, len(y), 256):
            some = order[a:a + 256]
            n = start[some + 1] - start[some]
            row = np.repeat(np.arange(len(some)), n)
            kk = k[np.repeat(start[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
            miss = (1 / (1 + np.exp(-m._sum(kk, row, len(some)))) - y[some]) * np.where(y[some] == 1, p.positive, 1) / len(some)
            gb += miss.sum() ** 2
            m.bias -= p.rate * miss.sum() / np.sqrt(gb)
            used, inv = np.unique(kk, return_inverse=True)
            d = np.bincount(inv, miss[row], len(used)) + p.decay * m.w[used]
            gw[used] += d * d
            m.w[used] -= p.rate * d / np.sqrt(gw[used])
            for f in range(p.rank):
                x = m.v[kk, f]
                sums = np.bincount(row, x, len(some))
                d = np.bincount(inv, miss[row] * (sums[row] - x), len(used)) + p.decay * m.v[used, f]
                gv[used, f] += d * d
                m.v[used, f] -= p.rate * d / np.sqrt(gv[used, f])
    return m


def fit(docs: DataFrame, labels: DataFrame, learned_from, p: Params = Params(), label: str = "toxic") -> Machine:
    """Learn from the labelled rows for which ``learned_from(doc_id)`` holds.

    ``max_rows`` bounds what reaches the driver; the rows are those whose id has
    the smallest hash, whatever the partitioning, and one row for each id (of
    several the one whose text has the smallest hash)."""
    bits = p.hash_bits
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0)).where(learned_from(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_rows))
    rows = keep(one_each(id_text(docs).join(F.broadcast(chosen), "doc_id")).select("doc_id", "label", "text")  # at most max_rows (id, label)
                .mapInArrow(lambda it: _columns(it, bits), "doc_id long, label double, columns array<int>"), "toxicity-terms")
    cols = _telling(rows, p)
    some = (rows.mapInArrow(lambda it: _picked(it, cols), rows.schema).toPandas()
            .sort_values("doc_id", kind="stable", ignore_index=True))  # max_rows short lists
    size = np.array([len(c) for c in some["columns"]], dtype=np.int64)
    k = np.concatenate([np.asarray(c, dtype=np.int64) for c in some["columns"]] or [np.zeros(0, np.int64)])
    return learn(some["label"].to_numpy(dtype=float), k, np.concatenate([[0], np.cumsum(size)]).astype(np.int64), cols, p)


def _run(batches, shared, threshold=None):
    m = shared.value
    for batch in batches:
        out = []
        for _, data, off in pieces(batch, "text"):
            value, at = hashed(data, off, m.hash_bits)
            with np.errstate(over="ignore"):
                out.append(1 / (1 + np.exp(-m.raw(value, at))))
        y = np.concatenate(out) if out else np.zeros(0)
        if threshold is not None:
            yield batch.filter(pa.array(y < threshold))
        else:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(y)], ["doc_id", "score"])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # at most max_columns * (rank + 2) numbers
    return id_text(docs).mapInArrow(lambda it: _run(it, shared), "doc_id long, score double")


def passing(docs: DataFrame, machine: Machine, threshold: float) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return docs.mapInArrow(lambda it: _run(it, shared, threshold), docs.schema)
