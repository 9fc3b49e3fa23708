"""Keyed, seeded randomness (every draw is a function of seed, purpose, key).

``md5(seed:purpose:key)`` gives the same draw in every engine and under any
partitioning, so samples, splits and augmentations are reproducible and can be
checked by an SQL oracle.  ``F.rand``/``sample``/``randomSplit`` are not used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key(*cols) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string")
                             for c in cols])


def keyed_hash(seed: int, purpose: str, *key_cols) -> Column:
    """Hex md5 of ``seed:purpose:key``; keys are joined with ``|``."""
    return F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), _key(*key_cols)))


def threshold(p: float) -> str:
    """8-hex-digit threshold for a Bernoulli(p) draw on the hash prefix."""
    if p <= 0:
        return "00000000"
    if p >= 1:
        return "100000000"  # compares greater than every 8-digit prefix
    return f"{int(p * 2 ** 32):08x}"


def bernoulli(seed: int, purpose: str, p: float, *key_cols) -> Column:
    """True with probability ``p`` (text comparison of the hash prefix)."""
    if p >= 1:
        return F.lit(True)
    if p <= 0:
        return F.lit(False)
    return F.substring(keyed_hash(seed, purpose, *key_cols), 1, 8) < F.lit(threshold(p))


def weighted_choice(seed: int, purpose: str, weights: list[float], *key_cols) -> Column:
    """Index (0-based) of the chosen weight, by cumulative thresholds."""
    total = float(sum(weights))
    h = F.substring(keyed_hash(seed, purpose, *key_cols), 1, 8)
    acc = 0.0
    expr = None
    for i, w in enumerate(weights[:-1]):
        acc += w / total
        cond = h < F.lit(threshold(acc))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    last = F.lit(len(weights) - 1)
    return last if expr is None else expr.otherwise(last)


def sql_keyed_hash(seed: int, purpose: str, *key_sql: str) -> str:
    """Same hash as :func:`keyed_hash`, as SQL text for oracles (DuckDB/Spark)."""
    parts = ", ".join(f"coalesce(cast({k} AS STRING), '')" for k in key_sql)
    return f"md5(concat('{seed}:{purpose}:', concat_ws('|', {parts})))"
