"""Joins of rows to their group where one group may hold most rows.

A join shuffles by its keys, so all rows of a key meet in one task, and a key
with a third of all rows makes that task grow with the table.  Here the rows of
a key with more than ``most`` rows are dealt over parts by a hash of the whole
row, and what they are joined to is repeated once for every part of its key.
Such keys are few (at most one in ``most`` rows), so their list is broadcast.
They are found in a share of the rows: how a key is dealt changes no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 100_000  # rows of a key that are joined in one task
SEEN = 1_000  # rows of such a key that are counted, about


def hot_keys(rows: DataFrame, on: list[str], most: int) -> DataFrame:
    """``(*on, _n)``: the keys with more than about ``most`` rows and about how many they have."""
    share = max(1, most // SEEN)
    seen = rows.where(F.pmod(F.monotonically_increasing_id(), F.lit(share)) == 0) if share > 1 else rows
    return seen.groupBy(*on).agg((F.count(F.lit(1)) * share).alias("_n")).where(F.col("_n") > most)


def spread_join(rows: DataFrame, per_key: DataFrame, on: list[str], how: str = "inner", counted: DataFrame | None = None,
                most: int = MOST) -> DataFrame:
    """``rows.join(per_key, on, how)`` for ``how`` inner, left, left_semi or left_anti.

    ``counted`` may name a cheaper table with as many rows per key as ``rows``."""
    counts = hot_keys(rows if counted is None else counted, on, most)
    hot = F.broadcast(counts.select(*on, F.ceil(F.col("_n") / most).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(hot, on, "left").withColumn("_part", F.pmod(F.xxhash64(*rows.columns), parts).cast("int")).drop("_parts")
    repeated = (per_key.join(hot, on, "left")
                .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts"))
    return dealt.join(repeated, [*on, "_part"], how).drop("_part")
