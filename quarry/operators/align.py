"""Aligning the rows of two unordered results by similarity.

Rows are compared as sets of canonical cells. The most similar rows of the two
sides are paired first (Jaccard), equal sets before all others, and rows that
share no value with any row left come last in their own order; positions without
a partner never count as equal, so their order does not matter for E15.

No pair's rows are compared with each other one by one. For two rows of sizes a
and b that share exactly s values the similarity is s / (a + b - s), so the
search goes through the levels (s, a + b) from the most similar down. At a level
every kind of row that remains (rows of a side with the same values) posts its
s-subsets; kinds of the two sides that meet at a subset share it and, as all
higher levels are settled, nothing more. Each kind settles on one of the subsets
that both sides post, the k-th row of one side at a subset takes the k-th of the
other, and this repeats until no subset of the level has rows of both sides. A
value that a third of all rows share so costs one row per row, never one per
pair of rows.

Two things keep the subsets few. Only values that remain on both sides of a pair
count (unique values of unmatched rows go at once, and their kinds fall
together). And where kinds have so many values that their subsets outnumber the
pairs of kinds that share a rare value, the subsets come from a join on the
rarest values instead (a prefix of ``size - s + 1`` values, rarest first, holds
one of any s): both give the same subsets with rows on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarry.functions.ranking import SMALL, rank_within
from quarry.functions.spread import spread_join
from quarry.session import scratch_path


def ordered_pairs(pairs: DataFrame, gold: str = "gold_sql", pred: str = "pred_sql") -> DataFrame:
    """``(pair_id, ordered)``: whether either query text asks for an order."""
    both = F.lower(F.concat_ws(" ", F.col(gold), F.col(pred)))
    return pairs.select("pair_id", F.contains(both, F.lit("order by")).alias("ordered"))


def _kept(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "align")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbered(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """0-based rank inside a group of a written table, however large it is."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in group])
    return rank_within(df.withColumn("_g", key), "_g", order, out, "_n", small=SMALL).drop("_g", "_n")


def _useful(rows: DataFrame) -> DataFrame:
    """Rows with the values that the other side of their pair still has; rows
    without such a value are left out."""
    v = rows.select("pair_id", "side", "row_no", "size", F.explode("vals").alias("v"))
    shared = (v.groupBy("pair_id", "v").agg(F.max((F.col("side") == "gold").cast("int")).alias("g"),
                                            F.max((F.col("side") == "pred").cast("int")).alias("p"))
              .where("g = 1 AND p = 1").select("pair_id", "v"))
    return (spread_join(v, shared, ["pair_id", "v"]).groupBy("pair_id", "side", "row_no", "size")
            .agg(F.array_sort(F.collect_list("v")).alias("vals")))


def _subsets(vals: Column, s: int) -> Column:
    """All subsets of ``s`` values of a sorted array, each in that order."""
    one = F.transform(vals, lambda v: F.array(v))
    out = one
    for _ in range(s - 1):
        # longer ones by appending a greater value
        out = F.flatten(F.transform(out, lambda sub: F.transform(
            F.filter(vals, lambda v: v > F.element_at(sub, -1)), lambda v: F.array_append(sub, v))))
    return out


def _choose(n: Column, s: int) -> Column:
    """Binomial coefficient, as a double."""
    out = F.lit(1.0)
    for k in range(s):
        out = out * (n - k) / (k + 1)
    return F.when(n < s, 0.0).otherwise(out)


_KIND = ["pair_id", "side", "size", "kind"]


def _rare(kinds: DataFrame, s: int) -> DataFrame:
    """Every kind under its rarest values: as many as hold one of any ``s``."""
    v = kinds.select(*_KIND, "vals", F.explode("vals").alias("v"))
    often = v.groupBy("pair_id", "v").agg(F.count("*").alias("n"))
    return (spread_join(v, often, ["pair_id", "v"]).groupBy(*_KIND, "vals").agg(F.array_sort(F.collect_list(F.struct("n", "v"))).alias("r"))
            .withColumn("v", F.explode(F.transform(F.slice("r", 1, F.size("r") - s + 1), lambda x: x["v"]))).drop("r"))


def _meeting(rare: DataFrame, s: int) -> DataFrame:
    """Kinds and the subsets of ``s`` values that they share with one of the other side."""
    half = lambda name, c: rare.where(F.col("side") == name).select(
        "pair_id", "v", F.struct("size", "kind").alias(c), F.col("vals").alias(f"v{c}"))
    met = half("gold", "g").join(half("pred", "p"), ["pair_id", "v"]).withColumn("sub", F.array_intersect("vg", "vp")).where(F.size("sub") == s)
    side = lambda name, c: met.select("pair_id", F.lit(name).alias("side"), f"{c}.size", f"{c}.kind", "sub")
    return side("gold", "g").union(side("pred", "p")).distinct()


def _posted(kinds: DataFrame, s: int, most: float) -> DataFrame:
    """(pair_id, side, size, kind, sub): every kind's subsets of ``s`` values."""
    kinds = kinds.where(F.size("vals") >= s)
    made = kinds.agg(F.sum(_choose(F.size("vals"), s)).alias("subsets"), F.count("*").alias("n")).first()
    if (made.subsets or 0) > most * max(made.n, 1):
        rare = _kept(_rare(kinds, s))
        sides = rare.groupBy("pair_id", "v").agg(F.count_if(F.col("side") == "gold").alias("g"), F.count_if(F.col("side") == "pred").alias("p"))
        if (sides.agg(F.sum(F.col("g").cast("double") * F.col("p"))).first()[0] or 0) < made.subsets:
            return _meeting(rare, s)
    return kinds.select(*_KIND, F.explode(_subsets(F.col("vals"), s)).alias("sub"))


def _round(rows: DataFrame, s: int, total: int, most: float) -> tuple[DataFrame, DataFrame] | None:
    """Row pairs of one level that are settled in one round, and the rows that had a
    subset with rows of both sides, or None. Sides only lose rows, so no other row gets
    such a subset in a later round of the level."""
    rows = rows.withColumn("kind", F.md5(F.to_json("vals")))
    kinds = _kept(rows.select(*_KIND, "vals").distinct())
    gold = F.col("side") == "gold"
    posted = _kept(_posted(kinds, s, most).withColumn("sub", F.md5(F.to_json("sub")))
                   .withColumn("a", F.when(gold, F.col("size")).otherwise(total - F.col("size"))))
    both = (posted.groupBy("pair_id", "sub", "a").agg(F.max(gold.cast("int")).alias("g"), F.max((~gold).cast("int")).alias("p"))
            .where("g = 1 AND p = 1").select("pair_id", "sub", "a"))
    chosen = _kept(spread_join(posted, both, ["pair_id", "sub", "a"]).groupBy(*_KIND).agg(F.min(F.struct("sub", "a")).alias("c"))
                   .select(*_KIND, "c.sub", "c.a"))
    if chosen.isEmpty():
        return None
    tried = _kept(spread_join(rows, chosen, _KIND))
    nth = _numbered(tried.drop("vals"), ["pair_id", "side", "sub", "a"], ["row_no"], "nth")
    side = lambda name: nth.where(F.col("side") == name).select(
        "pair_id", "sub", "a", "nth", F.col("row_no").alias(f"{name}_no"))
    pairs = _kept(side("gold").join(side("pred"), ["pair_id", "sub", "a", "nth"]).select("pair_id", "gold_no", "pred_no"))
    return pairs, tried.drop("kind", "sub", "a")


def similar_rows(rows: DataFrame, most: float = 64) -> DataFrame:
    """``(pair_id, gold_no, pred_no)``: rows of the two sides paired from the most
    similar down, as long as they share a value. ``most``: subsets a kind of row
    may post on average before the join on rare values is weighed against them."""
    sets = _kept(rows.select("pair_id", "side", "row_no", F.array_sort(F.array_distinct(F.transform("cells", F.md5))).alias("vals"))
                 .withColumn("size", F.size("vals")).withColumn("sub", F.md5(F.to_json("vals"))))
    nth = _numbered(sets.where("size > 0").select("pair_id", "side", "row_no", "sub"), ["pair_id", "side", "sub"], ["row_no"], "nth")
    equal = (nth.where("side = 'gold'").select("pair_id", "sub", "nth", F.col("row_no").alias("gold_no"))
             .join(nth.where("side = 'pred'").select("pair_id", "sub", "nth", F.col("row_no").alias("pred_no")), ["pair_id", "sub", "nth"]))
    found = [_kept(equal.select("pair_id", "gold_no", "pred_no"))]

    def rest(rows, pairs):
        done = pairs.select("pair_id", F.explode(F.array(
            F.struct(F.lit("gold").alias("side"), F.col("gold_no").alias("row_no")),
            F.struct(F.lit("pred").alias("side"), F.col("pred_no").alias("row_no")))).alias("x")).select("pair_id", "x.*")
        return rows.join(done, ["pair_id", "side", "row_no"], "left_anti")

    left = _kept(_useful(_kept(rest(sets.drop("sub"), found[0]))))
    passed: set = set()
    while True:
        # (a, b, useful values of a, of b) bound what a level can hold
        sides = {side: left.where(F.col("side") == side).groupBy("size").agg(F.max(F.size("vals")).alias("m")).collect()
                 for side in ("gold", "pred")}
        levels = {(s, g["size"] + p["size"]) for g in sides["gold"] for p in sides["pred"] for s in range(1, min(g.m, p.m) + 1)}
        # equal sets are settled
        levels = sorted({x for x in levels - passed if 2 * x[0] < x[1]}, key=lambda x: (-x[0] / (x[1] - x[0]), -x[0], x[1]))
        if not levels:
            break
        s, total = levels[0]
        settled, open_ = None, left
        while (step := _round(open_, s, total, most)) is not None:
            pairs, tried = step
            found.append(pairs)
            settled = pairs if settled is None else settled.union(pairs)
            open_ = _kept(rest(tried, pairs))
        passed.add((s, total))
        if settled is not None:
            left = _kept(_useful(_kept(rest(left, settled))))
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def align_similar(rows: DataFrame, positions: DataFrame, most: float = 64) -> DataFrame:
    """An alignment ``(pair_id, side, row_no, pos)`` for E15: a predicted row takes
    the position of its gold row, the others follow the gold rows in their own
    order. ``positions``: (pair_id, side, row_no, pos) in the original order."""
    pairs = similar_rows(rows, most)
    pos = _kept(positions.select("pair_id", "side", "row_no", "pos"))
    gold = pos.where("side = 'gold'")
    at = gold.select("pair_id", F.col("row_no").alias("gold_no"), "pos")
    paired = pairs.join(at, ["pair_id", "gold_no"]).select("pair_id", F.lit("pred").alias("side"), F.col("pred_no").alias("row_no"), "pos")
    sizes = gold.groupBy("pair_id").agg(F.count("*").alias("n"))
    # beyond all gold positions: never equal to one
    rest = pos.where("side = 'pred'").join(paired.select("pair_id", "row_no"), ["pair_id", "row_no"], "left_anti")
    rest = (spread_join(rest, sizes, ["pair_id"], "left", counted=rows.where("side = 'pred'"))
            .select("pair_id", F.lit("pred").alias("side"), "row_no", (F.coalesce("n", F.lit(0)) + F.col("pos")).alias("pos")))
    return gold.union(paired).union(rest)
