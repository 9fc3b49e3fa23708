"""Scoring queries (E5-E19) over F4 (and F1/F2 for the text match)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.cells import cells_array
from quarry.functions.spread import spread_join
from quarry.operators import align
from quarry.operators import compare as C
from quarry.operators import metrics as M
from quarry.plans.fixtures import (CUSTOMER_PAIR, F2_SQL, F4_SQL, F5_SQL, altered_pairs, pair_texts, replies,
                                   result_pairs)
from quarry.session import written
from quarry.sources.tables import load

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def f4_rows(spark: SparkSession, sf_dir: str):
    """F4 as stored results: rows with canonical cells, and headers."""
    w = result_pairs(spark, sf_dir)
    rows = w.select("pair_id", "side", "row_no", cells_array(w, ["c0", "c1"]).alias("cells"))
    pairs = rows.select("pair_id").distinct()
    return rows, C.heads_from_rows(rows, pairs, default_cols=2)


F5_HEAD = f"""WITH cells AS ({F4_SQL}),
perms AS (
 SELECT pair_id, side, 0 AS perm, c0, c1 FROM cells
 UNION ALL SELECT pair_id, side, 1 AS perm, c0, c1 FROM cells WHERE side = 'gold'
 UNION ALL SELECT pair_id, side, 1 AS perm, c1 AS c0, c0 AS c1 FROM cells WHERE side = 'pred'),
per_row AS (
 SELECT pair_id, perm, c0, c1,
  sum(CASE WHEN side = 'gold' THEN 1 ELSE 0 END) AS ng, sum(CASE WHEN side = 'pred' THEN 1 ELSE 0 END) AS np
 FROM perms GROUP BY pair_id, perm, c0, c1),
per_perm AS (
 SELECT pair_id, perm,
  min(CASE WHEN ng > 0 AND np > 0 THEN 1 ELSE 0 END) AS same_set, min(CASE WHEN ng = np THEN 1 ELSE 0 END) AS same_bag
 FROM per_row GROUP BY pair_id, perm),
f5 AS (SELECT pair_id, max(CASE WHEN perm = 0 THEN same_set ELSE 0 END) AS ex_bird, max(same_bag) AS ex_eq
 FROM per_perm GROUP BY pair_id)"""


@register("ex_set", F5_HEAD + "\nSELECT CAST(pair_id AS BIGINT) AS pair_id, CAST(ex_bird AS INTEGER) AS ex_bird FROM f5")
def ex_set_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, heads = f4_rows(spark, sf_dir)
    return C.score_pairs(rows, heads).select("pair_id", "ex_bird")


@register("ex_bag_perm", F5_HEAD + "\nSELECT CAST(pair_id AS BIGINT) AS pair_id, CAST(ex_eq AS INTEGER) AS ex_eq FROM f5")
def ex_bag_perm_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, heads = f4_rows(spark, sf_dir)
    return C.score_pairs(rows, heads).select("pair_id", "ex_eq")


@register("bag_equal", F5_HEAD + """
, per_pair AS (SELECT pair_id, min(CASE WHEN perm = 0 THEN same_bag END) AS b FROM per_perm GROUP BY pair_id)
SELECT CAST(pair_id AS BIGINT) AS pair_id, CAST(b AS INTEGER) AS bag_eq FROM per_pair""")
def bag_equal_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, heads = f4_rows(spark, sf_dir)
    return C.bag_equal(rows, heads)


@register("quick_reject", f"""WITH cells AS ({F4_SQL}),
u AS (SELECT pair_id, side, least(c0, c1) AS a, greatest(c0, c1) AS b FROM cells),
k AS (SELECT pair_id, a, b, max(CASE WHEN side = 'gold' THEN 1 ELSE 0 END) AS g,
  max(CASE WHEN side = 'pred' THEN 1 ELSE 0 END) AS p FROM u GROUP BY pair_id, a, b)
SELECT CAST(pair_id AS BIGINT) AS pair_id, CAST(min(g * p) AS INTEGER) AS quick_ok FROM k GROUP BY pair_id""")
def quick_reject_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, heads = f4_rows(spark, sf_dir)
    return C.unordered_rows_equal(rows, heads)


@register("has_null", f"""WITH cells AS ({F4_SQL}), sides AS (
 SELECT pair_id, s AS side FROM (SELECT DISTINCT pair_id FROM cells), (VALUES ('gold'), ('pred')) t(s))
SELECT CAST(sides.pair_id AS BIGINT) AS pair_id, sides.side,
 coalesce(count(cells.row_no) = 0 OR bool_or(cells.c0 IS NULL OR cells.c1 IS NULL), true) AS has_null
FROM sides LEFT JOIN cells ON sides.pair_id = cells.pair_id AND sides.side = cells.side
GROUP BY sides.pair_id, sides.side""")
def has_null_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, heads = f4_rows(spark, sf_dir)
    return C.has_null(rows, heads)


@register("row_jaccard", f"""WITH cells AS ({F4_SQL}),
g AS (SELECT pair_id, row_no, list_distinct([c0, c1]) AS a FROM cells WHERE side = 'gold'),
p AS (SELECT pair_id, row_no, list_distinct([c0, c1]) AS b FROM cells WHERE side = 'pred')
SELECT CAST(g.pair_id AS BIGINT) AS pair_id, CAST(g.row_no AS BIGINT) AS row_no,
 round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS jaccard
FROM g JOIN p ON g.pair_id = p.pair_id AND g.row_no = p.row_no""")
def row_jaccard_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = result_pairs(spark, sf_dir)
    vals = w.select("pair_id", "side", "row_no", F.array_distinct(F.array("c0", "c1")).alias("v"))
    g = vals.where(F.col("side") == "gold").select("pair_id", "row_no", F.col("v").alias("a"))
    p = vals.where(F.col("side") == "pred").select("pair_id", "row_no", F.col("v").alias("b"))
    return g.join(p, ["pair_id", "row_no"]).select(
        "pair_id", "row_no", F.round(C.row_jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"))


@register("frame_similarity", f"""WITH cells AS ({F4_SQL}),
pos AS (SELECT pair_id, side, row_number() OVER (PARTITION BY pair_id, side ORDER BY row_no) - 1 AS pos, c0, c1 FROM cells),
v AS (SELECT DISTINCT pair_id, side, pos, 's:' || c0 AS cv FROM pos UNION SELECT pair_id, side, pos, 's:' || c1 FROM pos),
g AS (SELECT * FROM v WHERE side = 'gold'), p AS (SELECT * FROM v WHERE side = 'pred'),
j AS (SELECT coalesce(g.pair_id, p.pair_id) AS pair_id, g.cv IS NOT NULL AND p.cv IS NOT NULL AS both_
 FROM g FULL OUTER JOIN p ON g.pair_id = p.pair_id AND g.pos = p.pos AND g.cv = p.cv)
SELECT CAST(a.pair_id AS BIGINT) AS pair_id,
 CASE WHEN count(j.pair_id) = 0 THEN 1.0 ELSE round(sum(CASE WHEN both_ THEN 1 ELSE 0 END) / count(j.pair_id), 6) END AS df_sim
FROM (SELECT DISTINCT pair_id FROM cells) a LEFT JOIN j ON j.pair_id = a.pair_id GROUP BY a.pair_id""")
def frame_similarity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, heads = f4_rows(spark, sf_dir)
    ordered = heads.select("pair_id", F.lit(True).alias("ordered")).distinct()
    fs = C.frame_similarity(rows, heads, ordered=ordered)
    return fs.select("pair_id", F.round("df_sim", 6).alias("df_sim"))


@register("frame_similarity_aligned", f"""WITH cells AS ({F4_SQL}),
-- no pair has rows left over on both sides, so what is shared are the equal sets
k AS (SELECT pair_id, least(c0, c1) AS a, greatest(c0, c1) AS b, count(*) FILTER (WHERE side = 'gold') AS g,
 count(*) FILTER (WHERE side = 'pred') AS p, CASE WHEN least(c0, c1) = greatest(c0, c1) THEN 1 ELSE 2 END AS w FROM cells GROUP BY pair_id, a, b, w)
SELECT CAST(pair_id AS BIGINT) AS pair_id, round(sum(w * least(g, p)) / sum(w * greatest(g, p)), 6) AS df_sim FROM k GROUP BY pair_id""")
def frame_similarity_aligned_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E14 + E15 without an ``order by``: rows with equal value sets first (pytest
    compares it with a direct Python rendering of the rule)."""
    rows, heads = f4_rows(spark, sf_dir)
    fs = C.frame_similarity(rows, heads, aligned=C.align_rows(rows))
    return fs.select("pair_id", F.round("df_sim", 6).alias("df_sim"))


@register("frame_similarity_mixed", f"""WITH cells AS ({F5_SQL}),
pos AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY row_no) - 1 AS pos FROM cells WHERE pair_id % 4 IN (1, 2)),
v AS (SELECT pair_id, side, pos, unnest([c0, c1, c2, c3]) AS cv FROM pos),
g AS (SELECT * FROM v WHERE side = 'gold'), p AS (SELECT * FROM v WHERE side = 'pred'),
ordered AS (SELECT coalesce(g.pair_id, p.pair_id) AS pair_id, count(g.cv) FILTER (WHERE p.cv IS NOT NULL) / count(*) AS df_sim
 FROM g FULL OUTER JOIN p ON g.pair_id = p.pair_id AND g.pos = p.pos AND g.cv = p.cv GROUP BY ALL),
-- without an order every predicted row meets the gold row it was made from, or one that shares as much
shared AS (SELECT pair_id, CASE WHEN kind <= 3 THEN 4 WHEN kind <= 5 THEN 3 WHEN kind = 6 THEN 2 ELSE 1 END AS both_
 FROM cells WHERE side = 'pred' AND pair_id % 4 NOT IN (1, 2)),
golds AS (SELECT pair_id, count(*) AS n FROM cells WHERE side = 'gold' AND pair_id % 4 NOT IN (1, 2) GROUP BY pair_id),
aligned AS (SELECT golds.pair_id, coalesce(sum(both_), 0) / (4 * n + coalesce(sum(4 - both_), 0)) AS df_sim
 FROM golds LEFT JOIN shared USING (pair_id) GROUP BY golds.pair_id, n)
SELECT CAST(pair_id AS BIGINT) AS pair_id, round(df_sim, 6) AS df_sim FROM ordered
UNION ALL SELECT CAST(pair_id AS BIGINT), round(df_sim, 6) FROM aligned""")
def frame_similarity_mixed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E14 + E15: the query texts say whether a pair keeps its order; the others
    are aligned by similarity."""
    w = altered_pairs(spark, sf_dir)
    # read by every step: written once
    rows = written(w.select("pair_id", "side", "row_no", cells_array(w, ["c0", "c1", "c2", "c3"]).alias("cells")), "rows")
    pairs = rows.select("pair_id").distinct()
    ordered = written(align.ordered_pairs(pair_texts(pairs)), "ordered")
    free = written(spread_join(rows, ordered.where("NOT ordered"), ["pair_id"], "left_semi"), "free")
    heads = C.heads_from_rows(rows, pairs, default_cols=4)
    fs = C.frame_similarity(rows, heads, ordered=ordered, aligned=align.align_similar(free, C.positions(free)))
    return fs.select("pair_id", F.round("df_sim", 6).alias("df_sim"))


ORDERED_HEAD = f"""WITH cells AS ({F4_SQL}),
placed AS (SELECT pair_id, side, c0, c1, CASE WHEN pair_id % 2 = 0 THEN row_number() OVER (PARTITION BY pair_id, side
  ORDER BY CASE WHEN side = 'pred' AND pair_id % 3 = 0 THEN -row_no ELSE row_no END) ELSE 0 END AS pos FROM cells),
perms AS (SELECT pair_id, side, 0 AS perm, c0, c1, pos FROM placed
 UNION ALL SELECT pair_id, side, 1, c0, c1, pos FROM placed WHERE side = 'gold'
 UNION ALL SELECT pair_id, side, 1, c1, c0, pos FROM placed WHERE side = 'pred'),
per_row AS (SELECT pair_id, perm, c0, c1, pos, count(*) FILTER (WHERE side = 'gold') = count(*) FILTER (WHERE side = 'pred') AS same
 FROM perms GROUP BY pair_id, perm, c0, c1, pos),
eq AS (SELECT pair_id, max(same_bag) AS ex_eq FROM (SELECT pair_id, perm, min(same::INT) AS same_bag FROM per_row GROUP BY pair_id, perm) GROUP BY pair_id),
keys AS (SELECT pair_id, least(c0, c1) AS a, greatest(c0, c1) AS b, pos, bool_or(side = 'gold') AND bool_or(side = 'pred') AS same
 FROM placed GROUP BY ALL),
quick AS (SELECT pair_id, min(same::INT) AS quick_ok FROM keys GROUP BY pair_id)"""


@register("ex_ordered", ORDERED_HEAD + """
SELECT CAST(pair_id AS BIGINT) AS pair_id, CAST(ex_eq AS INTEGER) AS ex_eq, CAST(quick_ok AS INTEGER) AS quick_ok FROM eq JOIN quick USING (pair_id)""")
def ex_ordered_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 and E7 where even pairs keep their order; every third prediction comes
    in the opposite order."""
    rows, heads = f4_rows(spark, sf_dir)
    turned = (F.col("side") == "pred") & (F.col("pair_id") % 3 == 0)
    rows = rows.withColumn("row_no", F.when(turned, -F.col("row_no")).otherwise(F.col("row_no")))
    ordered = rows.select("pair_id", (F.col("pair_id") % 2 == 0).alias("ordered")).distinct()
    rows, heads = C.with_order(rows, heads, ordered)
    return C.score_pairs(rows, heads).select("pair_id", "ex_eq").join(C.unordered_rows_equal(rows, heads), "pair_id")


def _score_table(spark, sf_dir):
    rows, heads = f4_rows(spark, sf_dir)
    s = C.score_pairs(rows, heads)
    db = load(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("pair_id"),
                                              F.col("r_name").alias("region"))
    name = F.coalesce("region", F.when(F.col("pair_id") < CUSTOMER_PAIR, "bulk").otherwise("customers"))
    return s.join(db, "pair_id", "left").withColumn("db_name", name).drop("region").withColumn("executable", F.lit(1))


@register("accuracy", F5_HEAD + """
SELECT count(*) AS n, round(100.0 * sum(ex_eq) / count(*), 6) AS ex_eq_acc,
 round(100.0 * sum(ex_bird) / count(*), 6) AS ex_bird_acc, round(100.0 * count(*) / count(*), 6) AS executable_acc
FROM f5""")
def accuracy_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.accuracy(_score_table(spark, sf_dir))


@register("accuracy_by_db", F5_HEAD + """
, s AS (SELECT coalesce(r_name, CASE WHEN pair_id < 1000 THEN 'bulk' ELSE 'customers' END) AS db_name, ex_eq, ex_bird,
 1 AS executable FROM f5 LEFT JOIN region ON r_regionkey = pair_id)
SELECT coalesce(db_name, 'ALL') AS db_name, count(*) AS n,
 count(*) FILTER (WHERE ex_eq = 1) AS ex_eq_n, round(100.0 * count(*) FILTER (WHERE ex_eq = 1) / count(*), 2) AS ex_eq_pct,
 count(*) FILTER (WHERE ex_bird = 1) AS ex_bird_n, round(100.0 * count(*) FILTER (WHERE ex_bird = 1) / count(*), 2) AS ex_bird_pct,
 count(*) FILTER (WHERE executable = 1) AS executable_n,
 round(100.0 * count(*) FILTER (WHERE executable = 1) / count(*), 2) AS executable_pct
FROM s GROUP BY ROLLUP (db_name)""")
def accuracy_by_db_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.summary_by(_score_table(spark, sf_dir), "db_name")


SQL_KEY = r"""regexp_replace(regexp_replace(regexp_replace(array_to_string(list_transform(string_split(
  regexp_replace(regexp_replace(regexp_replace({x}, '(?s)/\*.*?\*/', ' ', 'g'), '--[^\n]*', ' ', 'g'), '[`\[\]]', '"', 'g'),
  ''''), lambda p, i: CASE WHEN i % 2 = 1 THEN lower(regexp_replace(p, '\s+', ' ', 'g')) ELSE p END), ''''),
  '\s*;\s*$', '', 'g'), '\s*([(),=<>+*/-])\s*', '\1', 'g'), '^\s+|\s+$', '', 'g')"""


@register("sql_text_match", f"""WITH f2 AS ({F2_SQL})
SELECT idx, CASE WHEN {SQL_KEY.format(x='sql')} = {SQL_KEY.format(x='pred_sql')} THEN 1 ELSE 0 END AS text_match
FROM f2""")
def sql_text_match_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    f2 = replies(spark, sf_dir)
    return f2.select("idx", C.sql_text_match(F.col("sql"), F.col("pred_sql")).alias("text_match"))


@register("name_similarity", """
SELECT a.p_partkey, a.p_name AS name_a, b.p_name AS name_b,
 round(jaro_winkler_similarity(a.p_name, b.p_name), 6) AS jw
FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1""")
def name_similarity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaro-Winkler similarity of each part name with the next part's
    name - a scalar on two strings, one partner per row (no pairs within a
    group, no cross join)."""
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    a = p.select("p_partkey", F.col("p_name").alias("name_a"))
    b = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("name_b"))
    j = a.join(b, "p_partkey")
    return j.select("p_partkey", "name_a", "name_b",
                    F.round(C.jaro_winkler("name_a", "name_b"), 6).alias("jw"))
