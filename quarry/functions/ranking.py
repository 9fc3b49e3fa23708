"""Global ranks without pulling a dataset into one task.

A window with no ``partitionBy`` sorts everything in a single task.  Here the
data is range-partitioned on a total order, each task numbers its rows
(``monotonically_increasing_id`` holds the partition id in its upper bits and
the position in the lower 33), and per-partition counts - one small row per
partition - become offsets that are broadcast back.

Range bounds are sampled, and a sample depends on the row order an upstream
shuffle delivers, so the numbered rows are written once to the cluster's
checkpoint folder and both the counts and the numbering read that copy.  A
lost executor then re-reads the copy instead of re-sampling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.spread import hot_keys
from quarry.session import checkpoint_dir, scratch_path

LOW_BITS = 33
SMALL = 20_000  # rows of a group that are ranked in one task


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return max(1, int(conf))


def global_rank(df: DataFrame, order_cols: list, rank_col: str = "rank",
                start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 0-based position in ``order_cols`` order + ``start``.

    ``order_cols`` must be a total order (end with a unique key) for the
    result to be deterministic."""
    return _ranked(df, order_cols, rank_col, start, num_partitions).drop("_pid")


def _ranked(df: DataFrame, order_cols: list, rank_col: str, start: int, num_partitions: int | None) -> DataFrame:
    """:func:`global_rank` with ``_pid``, the number of a row's range."""
    n = _num_partitions(df, num_partitions)
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ordered = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    tagged = ordered.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", LOW_BITS)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a single-task window over it is bounded by n
    offsets = counts.select("_pid", (F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(rank_col, F.coalesce("_off", F.lit(0)) + F.col("_pos") + F.lit(start))
            .drop("_mid", "_pos", "_off"))


def rank_within(df: DataFrame, group_col: str, order_cols: list, rank_col: str = "rank_in_group",
                size_col: str = "group_size", num_partitions: int | None = None, small: int = 0) -> DataFrame:
    """0-based rank inside each group and the group size, without a window
    partitioned by the group (a hot group would land in one task): rank the
    whole set by (group, order), then subtract each group's first rank.
    Groups of up to about ``small`` rows are ranked by a window, which costs one
    shuffle; ``df`` is then read several times, so it should be a written table.

    A group's first rank and size are joined by (range, group), so a task gets no
    more of a hot group than one range holds.  Only the groups at the ends of a
    range can go on in another; these few are totalled apart and broadcast."""
    if small:
        less, more = by_size(df, [group_col], small)
        w = Window.partitionBy(group_col)
        out = (less.withColumn(size_col, F.count(F.lit(1)).over(w))
               .withColumn(rank_col, F.row_number().over(w.orderBy(*order_cols)).cast("long") - 1)
               .select(group_col, *[c for c in df.columns if c != group_col], size_col, rank_col))
        return out if more is None else out.union(rank_within(more, group_col, order_cols, rank_col, size_col, num_partitions))
    r = _ranked(df, [group_col] + list(order_cols), "_gr", 0, num_partitions)
    part = r.groupBy("_pid", group_col).agg(F.min("_gr").alias("_g0"), F.count(F.lit(1)).alias(size_col))
    ends = r.groupBy("_pid").agg(F.min(group_col).alias("_a"), F.max(group_col).alias("_z"))
    ends = ends.select(F.explode(F.array("_a", "_z")).alias(group_col)).distinct()
    whole = (r.join(F.broadcast(ends), group_col, "left_semi").groupBy(group_col)
             .agg(F.min("_gr").alias("_w0"), F.count(F.lit(1)).alias("_wn")))
    bounds = (part.join(F.broadcast(whole), group_col, "left")
              .select("_pid", group_col, F.coalesce("_w0", "_g0").alias("_g0"), F.coalesce("_wn", size_col).alias(size_col)))
    return (r.join(bounds, ["_pid", group_col])
            .withColumn(rank_col, F.col("_gr") - F.col("_g0")).drop("_pid", "_gr", "_g0"))


def by_size(df: DataFrame, group: list[str], small: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups of up to about ``small`` rows, and those of the others if there
    are any. Rows with a null in ``group`` are in neither. The large groups are few: their list is broadcast."""
    path = scratch_path(df.sparkSession, "large")
    hot_keys(df, group, small).select(*group).write.parquet(path)
    large = df.sparkSession.read.schema(df.select(*group).schema).parquet(path)
    df = df.dropna(subset=group)
    if large.isEmpty():
        return df, None
    return df.join(F.broadcast(large), group, "left_anti"), df.join(F.broadcast(large), group, "left_semi")


def fill_forward(df: DataFrame, part_col: str, order_col: str, value_col: str, out_col: str,
                 bucket_size: int = 100_000) -> DataFrame:
    """Latest non-null ``value_col`` at or before each row within ``part_col``
    in ``order_col`` (an integer key) order.

    Windows run per (part, bucket of ``order_col``) - at most ``bucket_size``
    rows each.  Each bucket's running value at its last row is its tail; a
    window over the small per-bucket table carries the last tail forward
    across buckets.  The tails are aggregated from the windowed rows, which
    are already partitioned by (part, bucket), so the input is read once."""
    d = df.withColumn("_b", F.floor(F.col(order_col) / F.lit(bucket_size)))
    w_in = (Window.partitionBy(part_col, "_b").orderBy(order_col)
            .rowsBetween(Window.unboundedPreceding, 0))
    w = d.withColumn("_local", F.last(value_col, ignorenulls=True).over(w_in))
    tails = w.groupBy(part_col, "_b").agg(F.max_by("_local", order_col).alias("_tail"))
    w_carry = (Window.partitionBy(part_col).orderBy("_b")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = tails.withColumn("_carry", F.last("_tail", ignorenulls=True).over(w_carry))
    return (w.join(carry.select(part_col, "_b", "_carry"), [part_col, "_b"], "left")
            .withColumn(out_col, F.coalesce("_local", "_carry"))
            .drop("_b", "_local", "_carry"))
