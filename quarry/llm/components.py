"""Connected components of a link table, by large-star and small-star steps.

Every step is a grouped minimum (partial aggregation first) joined back to the
links, so a vertex with a third of all links is never one group's list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.store import keep

ROUNDS = 60


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, smallest vertex reachable) over some links, without the trivial rows."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(ids))
    return ids[far], ids[label[far]]


def _contract(batches):
    """Links of one task's batches replaced by stars with the same components."""
    for batch in batches:
        a, b = forest(batch.column("a").to_numpy(), batch.column("b").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _stars(e: DataFrame) -> bool:
    """Whether every vertex has one link down, to a vertex that has none: then
    the links are the components."""
    ends = e.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("down")),
                                      F.struct(F.col("b").alias("v"), F.lit(0).alias("down")))).alias("x")).select("x.*")
    return ends.groupBy("v").agg(F.sum("down").alias("down"), F.min("down").alias("least")).where(
        "down > 1 OR (down = 1 AND least = 0)").isEmpty()


def components(links: DataFrame, name: str) -> DataFrame:
    """``links``: (a, b) long. Returns (vertex, component): the smallest id
    reachable, for every vertex that has a link to another one."""
    e = (links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
         .mapInArrow(_contract, "a long, b long").distinct())
    e = keep(e, f"{name}-links")
    for _ in range(ROUNDS):
        if _stars(e):
            break
        # large star: the larger neighbours of every vertex move to its smallest neighbour
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        big = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .where("a <> b").distinct())
        # small star: the smaller neighbours of every vertex, and itself, move to the smallest
        low = big.groupBy("a").agg(F.min("b").alias("m"))
        e = keep(big.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), f"{name}-links")
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return e.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(
        e.select(F.col("b"), F.col("b")).distinct())
