"""Quality: Bradley-Terry ranking learned from preference pairs.

Each text has a strength ``theta . x`` of surface features x. A pair (better,
worse) of labelled texts is won with probability sigmoid(theta . (x_b - x_w));
theta is fitted by Newton steps on the logistic loss of the feature differences
with a ridge term. The accepting threshold is a quantile of the learned texts'
strengths: the share of label-0 texts lies below it. ``score`` maps that
threshold to ``cut``.

Defined results: null text is an empty text (all features 0); without labelled
rows of both kinds every score is 0.5; a null id is scored and never learned
from; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.store import id_text, one_each
from quarry.llm.textbytes import SPACE, mix, per_row, pieces, words


@dataclass
class Params:
    max_rows: int = 20_000   # labelled texts learned from: the smallest by a hash of the id
    max_pairs: int = 200_000  # preference pairs drawn from them
    ridge: float = 1e-3
    steps: int = 25
    cut: float = 0.3         # score that the threshold is mapped to
    seed: int = 3


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


CLASSES = {
    "upper": _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "lower": _class("abcdefghijklmnopqrstuvwxyz"),
    "digit": _class("0123456789"), "stop": _class(".!?"), "comma": _class(",;:"),
    "mark": _class("#$%&*+=<>@^_~|\\/{}[]"), "bar": _class("|"), "wide": np.arange(256) >= 128, "space": SPACE,
}
FEATURES = [f"{c}_share" for c in CLASSES] + [
    "log_bytes", "log_words", "word_bytes", "distinct_words", "top_word", "repeated_next", "repeated_pairs",
    "line_words", "marked_words"]


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` (and their squares) for each text."""
    rows = len(off) - 1
    size = np.diff(off).astype(float)
    per = np.maximum(size, 1)
    x = []
    row_of = np.repeat(np.arange(rows), np.diff(off))
    for inside in CLASSES.values():
        x.append(np.bincount(row_of[inside[data]], minlength=rows) / per)
    h, at = words(data, off)
    n = np.diff(at).astype(float)
    some = np.maximum(n, 1)
    word_row = np.repeat(np.arange(rows), np.diff(at))

    def repeats(values, row):
        """Distinct values and the count of the commonest, by row."""
        order = np.lexsort((values, row))
        v, r = values[order], row[order]
        new = np.ones(len(v), dtype=bool)
        new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(v)))
        kinds = np.bincount(r[first], minlength=rows)
        return kinds, per_row(count, np.searchsorted(r[first], np.arange(rows + 1)), np.maximum, 0)

    kinds, top = repeats(h, word_row)
    inner = np.flatnonzero(word_row[1:] == word_row[:-1]) if len(h) else np.zeros(0, int)
    same = np.bincount(word_row[inner], (h[inner] == h[inner + 1]).astype(float), rows) if len(inner) else np.zeros(rows)
    pair_kinds, _ = repeats(mix(h[inner] * np.uint64(3) + h[inner + 1]), word_row[inner])
    lines = np.bincount(row_of[data == 10], minlength=rows) + 1.0
    mark = CLASSES["mark"][data]
    ends = mark.copy()
    ends[:-1] &= SPACE[data[1:]]
    marked = np.bincount(row_of[ends], minlength=rows)
    x += [np.log1p(size), np.log1p(n), size / some, kinds / some, top / some, same / some,
          1 - pair_kinds / np.maximum(n - 1, 1) * (n > 1) - (n <= 1), np.log1p(n / lines), marked / some]
    x = np.stack(x, axis=1)
    return np.concatenate([x, x * x], axis=1)


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    theta: np.ndarray
    threshold: float
    spread: float
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.theta

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (self.strength(x) - self.threshold) / self.spread + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def learn(x: np.ndarray, y: np.ndarray, p: Params) -> Ranking | None:
    """None without texts of both labels."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if len(good) == 0 or len(bad) == 0:
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1
    z = (x - mean) / scale
    rng = np.random.default_rng(p.seed)
    n = min(p.max_pairs, len(good) * len(bad))
    b, w = good[rng.integers(0, len(good), n)], bad[rng.integers(0, len(bad), n)]
    theta = np.zeros(z.shape[1])
    for _ in range(p.steps):
        slope, curve = p.ridge * theta, p.ridge * np.eye(len(theta))
        for a in range(0, n, 20_000):  # the differences are made a block at a time
            d = z[b[a:a + 20_000]] - z[w[a:a + 20_000]]
            win = 1 / (1 + np.exp(-np.clip(d @ theta, -500, 500)))
            slope -= d.T @ (1 - win) / n
            curve += (d * (win * (1 - win) / n)[:, None]).T @ d
        step = np.linalg.solve(curve, slope)
        theta -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    s = z @ theta
    share = len(bad) / len(y)
    near = np.quantile(s, [max(0.0, share - 0.02), share, min(1.0, share + 0.02)])
    return Ranking(mean, scale, theta, float(near[1]), float(max(near[2] - near[0], 1e-6)) / 8, p.cut)


def _rows(batches, names):
    for batch in batches:
        parts = [features(data, off) for _, data, off in pieces(batch, "text")]
        x = np.concatenate(parts) if parts else np.zeros((0, 2 * len(FEATURES)))
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [flat], [*names, "x"])


def fit(docs: DataFrame, labels: DataFrame, learned_from, p: Params = Params(), label: str = "quality") -> Ranking | None:
    """Learn from the labelled rows for which ``learned_from(doc_id)`` holds;
    ``max_rows`` bounds what reaches the driver, one row for each id (of several
    the one whose text has the smallest hash)."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0)).where(learned_from(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_rows))
    rows = (one_each(id_text(docs).join(F.broadcast(chosen), "doc_id")).select("label", "text")  # at most max_rows (id, label)
            .mapInArrow(lambda it: _rows(it, ["label"]), "label double, x array<double>").toPandas())
    if len(rows) == 0:
        return None
    return learn(np.stack(rows["x"].to_numpy()), rows["label"].to_numpy(dtype=float), p)


def score(docs: DataFrame, ranking: Ranking | None) -> DataFrame:
    """(doc_id, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ranking)  # a few vectors of 2 * len(FEATURES)

    def run(batches):
        r = shared.value
        for batch in batches:
            out = [r.score(features(data, off)) if r else np.full(len(off) - 1, 0.5)
                   for _, data, off in pieces(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(out) if out else np.zeros(0))], ["doc_id", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, score double")
