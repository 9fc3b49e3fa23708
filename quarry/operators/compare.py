"""Comparing predicted and gold result sets for a whole corpus.

Results are stored as rows ``(pair_id, side, row_no, cells)`` - ``cells`` an
``array<string>`` of canonical cells (``quarry.functions.cells``) - plus one
header per (pair, side) ``(pair_id, side, n_rows, n_cols)`` so that empty
results do not vanish.  All pairs are scored by the same few aggregations; no
pair's rows are collected into one task or to the driver:

* set and bag equality: one aggregation on ``(pair_id, row_key)`` with
  map-side combine, then one per pair.
* column permutations (E6, E9): only for pairs not already decided.  Columns
  get classes that no permutation can change (the bag of their values, refined
  by the rows the values stand in); a gold column can only take a predicted
  column of its class.  Classes of one column are settled at once; tied columns
  are assigned one per step, as rows ``(pair, partial assignment)``, and an
  assignment survives a step only if both sides' bags of the assigned cells are
  equal.  The search is exact and has no limit on candidates.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.cells import NULL_CELL
from quarry.functions.ranking import SMALL, by_size, rank_within
from quarry.functions.spread import spread_join
from quarry.functions.sqltext import text_key
from quarry.session import scratch_path

ROWS_SCHEMA = "pair_id long, side string, row_no long, cells array<string>"
HEADS_SCHEMA = "pair_id long, side string, n_rows long, n_cols int"


def row_key(cells: Column) -> Column:
    """Unambiguous row identity: md5 of the JSON array of canonical cells."""
    return F.md5(F.to_json(cells))


def heads_from_rows(rows: DataFrame, pairs: DataFrame, n_cols: dict | None = None,
                    default_cols: int | None = None) -> DataFrame:
    """Headers for every (pair, side); widths of empty sides come from
    ``default_cols`` when the runner gave none."""
    per = rows.groupBy("pair_id", "side").agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.max(F.size("cells")).alias("_w"))
    sides = pairs.select("pair_id", F.explode(F.array(F.lit("gold"), F.lit("pred"))).alias("side"))
    return (sides.join(per, ["pair_id", "side"], "left")
            .select("pair_id", "side", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
                    F.coalesce("_w", F.lit(default_cols)).cast("int").alias("n_cols")))


def _pair_heads(heads: DataFrame) -> DataFrame:
    g = F.col("side") == "gold"
    return heads.groupBy("pair_id").agg(
        F.max(F.when(g, F.col("n_rows"))).alias("gn"), F.max(F.when(~g, F.col("n_rows"))).alias("pn"),
        F.max(F.when(g, F.col("n_cols"))).alias("gw"), F.max(F.when(~g, F.col("n_cols"))).alias("pw"))


def identity_match(rows: DataFrame) -> DataFrame:
    """Per pair: ``same_set`` (every row on both sides) and ``same_bag``
    (every row as often on both sides), columns in their given order."""
    k = rows.select("pair_id", "side", row_key(F.col("cells")).alias("row_key"))
    per_key = k.groupBy("pair_id", "row_key").agg(
        F.sum(F.when(F.col("side") == "gold", 1).otherwise(0)).alias("ng"),
        F.sum(F.when(F.col("side") == "pred", 1).otherwise(0)).alias("np"))
    return per_key.groupBy("pair_id").agg(
        F.min((F.col("ng") > 0) & (F.col("np") > 0)).alias("same_set"),
        F.min(F.col("ng") == F.col("np")).alias("same_bag"))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written once under the shared checkpoint folder: read by several branches."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_DEC = T.DecimalType(38, 0)


def column_classes(rows: DataFrame, rounds: int = 2) -> DataFrame:
    """Per (pair, side, col): ``fp``, a hash that equal columns of equal
    results share whatever their order, and ``lab``, a hash of the column row
    by row (equal labels mean interchangeable columns).

    ``fp`` starts as the bag of the column's values; each round adds, to every
    value, the bag of (class, value) of the row it stands in."""
    c = rows.select("pair_id", "side", "row_no", F.posexplode("cells").alias("col", "cv"))

    def classed(x, *parts):
        return x.groupBy("pair_id", "side", "col").agg(
            F.sum(F.xxhash64(*parts).cast(_DEC)).cast("string").alias("fp"),
            F.sum(F.xxhash64("row_no", "cv").cast(_DEC)).cast("string").alias("lab"))

    fp = classed(c, "cv")
    for _ in range(rounds):
        j = spread_join(c, fp.select("pair_id", "side", "col", "fp"), ["pair_id", "side", "col"])
        row = j.groupBy("pair_id", "side", "row_no").agg(F.sum(F.xxhash64("fp", "cv").cast(_DEC)).cast("string").alias("rs"))
        fp = classed(j.join(row, ["pair_id", "side", "row_no"]), "fp", "cv", "rs")
    return fp


def _bags_equal(state: DataFrame, rows: DataFrame) -> DataFrame:
    """The assignments under which both sides have the same bag of rows, over
    the columns assigned so far."""
    cells = lambda f: row_key(F.transform("done", lambda a: F.element_at("cells", a[f] + 1)))
    gold = F.col("side") == "gold"
    keys = (spread_join(rows, state.select("pair_id", "cand", "done"), ["pair_id"])
            .select("pair_id", "cand", F.when(gold, cells("g")).otherwise(cells("p")).alias("k"),
                    F.when(gold, 1).otherwise(-1).alias("n")))
    wrong = (keys.groupBy("pair_id", "cand", "k").agg(F.sum("n").alias("n")).where("n <> 0")
             .select("pair_id", "cand").distinct())
    return state.join(wrong, ["pair_id", "cand"], "left_anti")


def permutation_match(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """E6/E9 for ``pairs``: ``(pair_id, perm_eq)``; exact."""
    r = _kept(spread_join(rows, pairs.select("pair_id"), ["pair_id"], "left_semi"), "perm_rows")
    col = F.struct(F.col("col").cast("int").alias("col"), "fp", "lab")
    per = column_classes(r).groupBy("pair_id").agg(  # two short arrays per pair
        F.array_sort(F.collect_list(F.when(F.col("side") == "gold", col))).alias("g"),
        F.array_sort(F.collect_list(F.when(F.col("side") == "pred", col))).alias("p"))
    classes = lambda c: F.array_sort(F.transform(c, lambda x: x["fp"]))
    per = per.where(classes("g") == classes("p"))
    alone = lambda x: F.size(F.filter("g", lambda y: y["fp"] == x["fp"])) == 1
    state = per.select(
        "pair_id", F.lit("").alias("cand"),
        F.transform(F.filter("g", alone), lambda x: F.struct(
            x["col"].alias("g"), F.filter("p", lambda y: y["fp"] == x["fp"])[0]["col"].alias("p"))).alias("done"),
        F.filter("g", lambda x: ~alone(x)).alias("todo"), "p")
    state = _kept(_bags_equal(state, r), "perm_state")
    found = state.where(F.size("todo") == 0).select("pair_id").distinct()
    while True:
        state = state.where(F.size("todo") > 0).join(found, "pair_id", "left_anti")
        if state.isEmpty():
            break
        x = F.col("todo")[0]
        fits = F.filter("p", lambda y: (y["fp"] == x["fp"]) & ~F.exists("done", lambda a: a["p"] == y["col"]))
        # of predicted columns that are equal row by row, the first stands for all
        state = state.withColumn("fits", fits).select("*", F.inline(F.array(F.struct(F.col("fits").alias("open"))))).drop("fits")
        state = state.withColumn("y", F.explode(F.filter("open", lambda y: ~F.exists(
            "open", lambda z: (z["lab"] == y["lab"]) & (z["col"] < y["col"])))))
        state = state.select(
            "pair_id", F.concat_ws(",", "cand", F.col("y.col").cast("string")).alias("cand"),
            F.concat("done", F.array(F.struct(x["col"].alias("g"), F.col("y.col").alias("p")))).alias("done"),
            F.slice("todo", 2, F.size("todo")).alias("todo"), "p")
        state = _kept(_bags_equal(state, r), "perm_state")
        found = _kept(found.union(state.where(F.size("todo") == 0).select("pair_id")).distinct(), "perm_found")
    return pairs.select("pair_id").join(found.withColumn("perm_eq", F.lit(True)), "pair_id", "left").select(
        "pair_id", F.coalesce("perm_eq", F.lit(False)).alias("perm_eq"))


def score_pairs(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """E5 + E6: ``(pair_id, ex_bird, ex_eq)`` for every pair.

    ``ex_bird``: the two row sets are equal (column order matters, row order
    and duplicates do not).  ``ex_eq``: some column permutation makes the row
    bags equal; both empty counts as equal for both metrics."""
    h = _pair_heads(heads)
    base = h.join(identity_match(rows), "pair_id", "left")
    both_empty = (F.col("gn") == 0) & (F.col("pn") == 0)
    ex_bird = (F.when(both_empty, 1).when((F.col("gn") == 0) | (F.col("pn") == 0), 0)
               .when(F.col("same_set"), 1).otherwise(0))
    eq_pre = (F.when(both_empty, F.lit(1)).when(F.col("gn") != F.col("pn"), F.lit(0))
              .when(F.col("gw") != F.col("pw"), F.lit(0)).when(F.col("same_bag"), F.lit(1))
              .when(F.col("gw") <= 1, F.lit(0)))
    base = _kept(base.select("pair_id", ex_bird.alias("ex_bird"), eq_pre.alias("eq_pre")), "scores")
    perm = permutation_match(rows, base.where(F.col("eq_pre").isNull()).select("pair_id"))
    return base.join(perm, "pair_id", "left").select(
        "pair_id", F.col("ex_bird").cast("int").alias("ex_bird"),
        F.coalesce("eq_pre", F.col("perm_eq").cast("int")).cast("int").alias("ex_eq"))


def with_order(rows: DataFrame, heads: DataFrame, ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and headers for E6 and E7 where the order counts: the rows of the pairs
    that ``ordered(pair_id, ordered)`` names carry their position as one more cell,
    which no value equals, so equality of sets and bags (under any permutation of
    the columns: the position's column only fits itself) is equality in order."""
    flags = ordered.where("ordered").select("pair_id").distinct().withColumn("_o", F.lit(True))
    placed = spread_join(positions(rows), flags, ["pair_id"], "left", counted=rows).withColumn("cells", F.when(
        F.col("_o"), F.array_append("cells", F.concat(F.lit("#:"), F.col("pos").cast("string")))).otherwise(F.col("cells")))
    wider = heads.join(flags, "pair_id", "left").withColumn("n_cols", F.when(F.col("_o"), F.col("n_cols") + 1).otherwise(F.col("n_cols")))
    return placed.select(*rows.columns), wider.select(*heads.columns)


def bag_equal(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """E8 (multiset equality, columns as given): ``(pair_id, bag_eq)``."""
    h = _pair_heads(heads)
    return (h.join(identity_match(rows), "pair_id", "left")
            .select("pair_id", F.when((F.col("gn") == 0) & (F.col("pn") == 0), 1)
                    .when(F.col("gn") != F.col("pn"), 0)
                    .when(F.col("same_bag"), 1).otherwise(0).alias("bag_eq")))


def unordered_rows_equal(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """E7 (``quick_rej``): the sets of rows with cells sorted are equal."""
    sorted_rows = rows.withColumn("cells", F.array_sort("cells"))
    return (identity_match(sorted_rows).join(_pair_heads(heads), "pair_id", "right")
            .select("pair_id", F.when((F.col("gn") == 0) & (F.col("pn") == 0), 1)
                    .when(F.col("same_set"), 1).otherwise(0).alias("quick_ok")))


def has_null(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Per (pair, side): empty result or any NULL cell."""
    nulls = rows.groupBy("pair_id", "side").agg(
        F.max(F.exists("cells", lambda c: c == NULL_CELL)).alias("_n"))
    return (heads.join(nulls, ["pair_id", "side"], "left")
            .select("pair_id", "side", ((F.col("n_rows") == 0) | F.coalesce("_n", F.lit(False)))
                    .alias("has_null")))


def row_jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two value sets; two empty sets give 1.0."""
    u = F.size(F.array_union(a, b))
    return F.when(u == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)).cast("double") / u)


def positions(rows: DataFrame, small: int = SMALL) -> DataFrame:
    """0-based row position per (pair, side) in ``row_no`` order; rows of one number
    have all their positions. ``rows`` is read several times."""
    less, more = by_size(rows.dropna(subset=["row_no"]), ["pair_id", "side"], small)
    w = Window.partitionBy("pair_id", "side").orderBy("row_no")
    first, twins = F.rank().over(w).cast("long") - 1, F.count(F.lit(1)).over(w.rangeBetween(0, 0))
    cols = ["pair_id", "side", "row_no", *[c for c in rows.columns if c not in ("pair_id", "side", "row_no")]]
    out = less.withColumn("_first", first).withColumn("_twins", twins).select(*cols, F.explode(F.sequence("_first", F.col("_first") + F.col("_twins") - 1)).alias("pos"))
    if more is None:
        return out
    k = more.select("pair_id", "side", "row_no", F.concat_ws("|", F.col("pair_id").cast("string"), "side").alias("_ps"))
    r = rank_within(k, "_ps", ["row_no"], "pos", "_n")  # keys only: the cells do not travel to be ranked
    return out.union(more.join(r.drop("_ps", "_n"), ["pair_id", "side", "row_no"]).select(*cols, "pos"))


def frame_similarity(rows: DataFrame, heads: DataFrame, ordered: DataFrame | None = None,
                     aligned: DataFrame | None = None) -> DataFrame:
    """Jaccard over (row position, value) between the two sides.

    ``ordered(pair_id, ordered)`` says which pairs keep the original row order
    (either query text contains ``order by``); others use the
    alignment ``aligned(pair_id, side, row_no, pos)`` (E14)."""
    pos = positions(rows)
    if aligned is not None:
        at = aligned.select("pair_id", "side", "row_no", F.col("pos").alias("_apos"))
        if ordered is not None:
            at = spread_join(at, ordered.where("ordered").select("pair_id"), ["pair_id"], "left_anti")
        pos = (pos.join(at, ["pair_id", "side", "row_no"], "left")
               .select("pair_id", "side", F.coalesce("_apos", "pos").alias("pos"), "cells"))
    # a position's values of both sides side by side: no value travels alone
    side = lambda name: F.array_distinct(F.flatten(F.collect_list(F.when(F.col("side") == name, F.col("cells")))))
    met = pos.groupBy("pair_id", "pos").agg(side("gold").alias("g"), side("pred").alias("p"))
    inter = F.size(F.array_intersect("g", "p")).cast("long")
    per = met.groupBy("pair_id").agg(F.sum(inter).alias("inter"), F.sum(F.size("g") + F.size("p") - inter).alias("uni"))
    pairs = heads.select("pair_id").distinct()
    return (pairs.join(per, "pair_id", "left")
            .select("pair_id", F.when(F.coalesce("uni", F.lit(0)) == 0, F.lit(1.0))
                    .otherwise(F.col("inter") / F.col("uni")).alias("df_sim")))


def align_rows(rows: DataFrame) -> DataFrame:
    """A row alignment ``(pair_id, side, row_no, pos)`` for unordered
    results.  Rows with the same set of values are paired first, the k-th such
    row of one side with the k-th of the other; the rows left over are paired
    in their own order; what a longer side has beyond that follows.  All of it
    is ranks and joins on (pair, row key), so no pair's rows meet in one task."""
    pos = positions(rows).select("pair_id", "side", "row_no", "pos",
                                 F.md5(F.to_json(F.array_sort(F.array_distinct("cells")))).alias("k"))
    twin = rank_within(_kept(pos.withColumn("_g", F.concat_ws("|", F.col("pair_id").cast("string"), "side", "k")), "positions"),
                       "_g", ["pos"], "nth", "_n", small=SMALL).drop("_g", "_n")
    gold = twin.where("side = 'gold'").drop("side")
    pred = twin.where("side = 'pred'").drop("side")
    both = (gold.select("pair_id", "k", "nth", F.col("pos").alias("at"), F.col("row_no").alias("gr"))
            .join(pred.select("pair_id", "k", "nth", F.col("row_no").alias("pr")), ["pair_id", "k", "nth"], "full_outer"))
    both = _kept(both, "aligned")
    paired = both.where("gr IS NOT NULL AND pr IS NOT NULL")

    def left(of, side):
        rest = both.where(f"{of} IS NOT NULL AND {'pr' if of == 'gr' else 'gr'} IS NULL").select("pair_id", F.col(of).alias("row_no"), "at")
        return rank_within(rest.withColumn("_g", F.col("pair_id").cast("string")), "_g", ["row_no"], "i", "_n").drop("_g", "_n")

    g, p = left("gr", "gold"), left("pr", "pred")
    sizes = rows.where("side = 'gold'").groupBy("pair_id").agg(F.count("*").alias("n"))
    rest = p.drop("at").join(g.select("pair_id", "i", "at"), ["pair_id", "i"], "left")
    rest = (spread_join(rest, sizes, ["pair_id"], "left", counted=p)
            .select("pair_id", F.lit("pred").alias("side"), "row_no",
                    F.coalesce("at", F.coalesce("n", F.lit(0)) + F.col("i")).cast("long").alias("pos")))
    golds = both.where("gr IS NOT NULL").select("pair_id", F.lit("gold").alias("side"), F.col("gr").alias("row_no"), F.col("at").alias("pos"))
    return golds.union(paired.select("pair_id", F.lit("pred").alias("side"), F.col("pr").alias("row_no"), F.col("at").alias("pos"))).union(rest)


def sql_text_key(sql: Column) -> Column:
    """E11 re-aimed: normalised SQL text; literals are compared as they are."""
    return text_key(sql)


def sql_text_match(gold: Column, pred: Column) -> Column:
    return (sql_text_key(gold) == sql_text_key(pred)).cast("int")


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity (prefix weight 0.1, up to 4 characters,
    boost only above 0.7)."""
    return pd.Series(_jw_all(a.tolist(), b.tolist()), dtype="float64")


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points as a matrix (padded with 0) and the lengths."""
    n = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.zeros((len(texts), int(n.max(initial=1))), dtype=np.uint32)
    out[np.arange(out.shape[1]) < n[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return out, n


def _jw_all(a: list, b: list, cells: int = 1 << 22) -> np.ndarray:
    """Row by row similarities, NaN where a side is null; all rows of a run are
    matched together, one character position at a time."""
    out = np.full(len(a), np.nan)
    rows = [i for i in range(len(a)) if a[i] is not None and b[i] is not None]
    rows.sort(key=lambda i: max(len(a[i]), len(b[i])))  # rows of like lengths share a matrix
    at = 0
    while at < len(rows):
        step = max(1, cells // max(1, len(a[rows[at]]), len(b[rows[at]])))
        part = rows[at:at + step]
        while len(part) > 1 and len(part) * max(len(a[part[-1]]), len(b[part[-1]])) > cells:
            part = part[:len(part) // 2]
        out[part] = _jw_rows([a[i] for i in part], [b[i] for i in part])
        at += len(part)
    return out


def _jw_rows(a: list[str], b: list[str]) -> np.ndarray:
    x, n = _characters(a)
    y, m = _characters(b)
    window = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    free = np.arange(y.shape[1]) < m[:, None]
    hit, j = np.zeros(x.shape, dtype=bool), np.arange(y.shape[1])
    for i in range(x.shape[1]):
        fits = free & (y == x[:, i, None]) & (np.abs(j - i) <= window[:, None]) & (i < n)[:, None]
        there = fits.any(axis=1)
        first = fits.argmax(axis=1)
        hit[:, i] = there
        free[there, first[there]] = False
    used = (j < m[:, None]) & ~free
    matches = hit.sum(axis=1)
    # the matched characters of both sides in order, side by side
    left, right = x[hit], y[used]
    row = np.repeat(np.arange(len(a)), matches)
    swapped = np.bincount(row[left != right], minlength=len(a))
    with np.errstate(divide="ignore", invalid="ignore"):
        # half the out-of-order matches, rounded down
        jaro = np.where(matches > 0, (matches / n + matches / m + (matches - swapped // 2) / matches) / 3, 0.0)
    width = min(4, x.shape[1], y.shape[1])
    same = (x[:, :width] == y[:, :width]) & (np.arange(width) < np.minimum(n, m)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1) if width else np.zeros(len(a), dtype=np.int64)
    out = np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)
    return np.where((n == 0) & (m == 0), 1.0, out)


def _jw(s1, s2) -> float | None:
    """Similarity of one pair."""
    return None if s1 is None or s2 is None else float(_jw_all([s1], [s2])[0])
