"""Execution queries (E1-E4, E22) and the JSON round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import execute as X
from quarry.operators import metrics as M
from quarry.operators.corpus import normalize_records
from quarry.plans.fixtures import F1_SQL, F2_SQL, replies, samples
from quarry.session import scratch_path
from quarry.sources.tables import TABLE_NAMES, load, register_views

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


GOLD = ("SELECT o_orderstatus, COUNT(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey "
        "WHERE c_nationkey = {k} GROUP BY o_orderstatus")
VARIANTS = [
    GOLD,
    ("SELECT COUNT(*) AS n, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey "
     "WHERE c_nationkey = {k} GROUP BY o_orderstatus"),
    GOLD.replace("{k}", "{k1}"),
    GOLD.replace("SELECT", "SELEC"),
    GOLD + " ORDER BY o_orderstatus",
]


def nation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pair per nation: the gold query counts its orders by status; the
    prediction is one of five variants (same, columns swapped, neighbour
    nation, syntax error, extra ORDER BY)."""
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("pair_id"), "n_name")
    k = F.col("pair_id").cast("string")
    k1 = (F.col("pair_id") + 1).cast("string")

    def fill(t):
        parts = t.replace("{k1}", "\u0002").replace("{k}", "\u0001")
        out = []
        buf = ""
        for ch in parts:
            if ch in "\u0001\u0002":
                if buf:
                    out.append(F.lit(buf))
                    buf = ""
                out.append(k if ch == "\u0001" else k1)
            else:
                buf += ch
        if buf:
            out.append(F.lit(buf))
        return F.concat(*out)
    v = F.col("pair_id") % len(VARIANTS)
    pred = None
    for i, t in enumerate(VARIANTS):
        pred = F.when(v == i, fill(t)) if pred is None else pred.when(v == i, fill(t))
    return n.select("pair_id", F.col("n_name").alias("db"), pred.alias("pred_sql"), fill(GOLD).alias("gold_sql"))


def _views(spark, sf_dir):
    """Every nation's "database" is the same set of tables here, so the views
    are registered once and no per-database switch is needed."""
    register_views(spark, sf_dir, TABLE_NAMES)
    return None


PAIRS_ORACLE = """
WITH g AS (SELECT c_nationkey AS k, o_orderstatus AS s, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
nat AS (SELECT n_nationkey AS k FROM nation),
x AS (SELECT nat.k,
  (SELECT count(*) FROM g WHERE g.k = nat.k) AS gn,
  (SELECT count(*) FROM (SELECT s, n FROM g WHERE g.k = nat.k EXCEPT SELECT s, n FROM g WHERE g.k = nat.k + 1)) = 0
  AND (SELECT count(*) FROM (SELECT s, n FROM g WHERE g.k = nat.k + 1 EXCEPT SELECT s, n FROM g WHERE g.k = nat.k)) = 0
  AS same_next FROM nat)
SELECT CAST(k AS BIGINT) AS pair_id,
 CAST(CASE k % 5 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN CAST(same_next AS INT) WHEN 3 THEN 0 ELSE 1 END AS INTEGER) AS ex_eq,
 CAST(CASE k % 5 WHEN 0 THEN 1 WHEN 1 THEN CASE WHEN gn = 0 THEN 1 ELSE 0 END WHEN 2 THEN CAST(same_next AS INT)
  WHEN 3 THEN 0 ELSE 1 END AS INTEGER) AS ex_bird,
 CAST(CASE WHEN k % 5 = 3 THEN 0 ELSE 1 END AS INTEGER) AS executable
FROM x"""


@register("run_pairs", PAIRS_ORACLE)
def run_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = nation_pairs(spark, sf_dir)
    r = X.evaluate_pairs(spark, pairs, _views(spark, sf_dir), timeout_s=120, threads=4)
    return r.select("pair_id", "ex_eq", "ex_bird", "executable")


# -------------------------------------------- executed feedback (G4, G5) --

STATUS = ("SELECT o_orderstatus, COUNT(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey "
          "WHERE c_nationkey = {k} GROUP BY o_orderstatus ORDER BY o_orderstatus")
LARGEST = "SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = {k} ORDER BY o_orderkey DESC"
BROKEN = "SELECT o_orderstatus FROM no_such_table WHERE c_nationkey = {k}"
WRONG = (LARGEST, BROKEN, STATUS)


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per nation; its prediction lists orders instead of counting them
    (0), names a table that is not there (1), or is right (2), by the key modulo 3."""
    k = F.col("n_nationkey").cast("string")
    fill = lambda t: F.concat(F.lit(t.split("{k}")[0]), k, F.lit(t.split("{k}")[1]))
    pred = F.when(F.col("n_nationkey") % 3 == 0, fill(LARGEST)).when(F.col("n_nationkey") % 3 == 1, fill(BROKEN)).otherwise(fill(STATUS))
    return load(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("pair_id"), F.col("n_nationkey").cast("long").alias("idx"), F.lit("tpch").alias("db"),
        F.concat(F.lit("How many orders of each status has "), "n_name", F.lit("?")).alias("question"), F.lit("").alias("evidence"),
        F.concat(F.lit("orders and customers of "), "n_name").alias("db_schema"), pred.alias("pred_sql"), fill(STATUS).alias("gold_sql"))


def _k(template: str) -> str:
    head, tail = template.split("{k}")
    return f"'{head}' || cast(n_nationkey AS VARCHAR) || '{tail}'"


MISSING = ("[TABLE_OR_VIEW_NOT_FOUND] The table or view `no_such_table` cannot be found. "
           "Verify the spelling and correctness of the schema and catalog.")
ASKED_SQL = f"""counts AS (SELECT c_nationkey AS k, o_orderstatus AS s, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
status AS (SELECT k, string_agg(s || ' | ' || cast(n AS VARCHAR), chr(10) ORDER BY s) AS shown FROM counts GROUP BY k),
keys AS (SELECT c_nationkey AS k, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
 QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderkey DESC) <= 10),
largest AS (SELECT k, string_agg(cast(o_orderkey AS VARCHAR), chr(10) ORDER BY o_orderkey DESC) AS shown FROM keys GROUP BY k),
asked AS (SELECT n_nationkey AS idx, 'How many orders of each status has ' || n_name || '?' AS question, '' AS evidence,
 'orders and customers of ' || n_name AS db_schema, {_k(LARGEST)} AS large_sql, {_k(BROKEN)} AS broken_sql, {_k(STATUS)} AS status_sql,
 coalesce(l.shown, '[]') AS large_info, 'error: {MISSING}' AS broken_info, coalesce(s.shown, '[]') AS status_info
 FROM nation LEFT JOIN largest l ON l.k = n_nationkey LEFT JOIN status s ON s.k = n_nationkey)"""


def _refine_sql():
    from quarry.plans.train_queries import VALS, G, fill_sql
    return f"""WITH {ASKED_SQL}, wrong AS (SELECT *, CASE WHEN idx % 3 = 0 THEN large_sql ELSE broken_sql END AS error_sql,
 CASE WHEN idx % 3 = 0 THEN large_info ELSE broken_info END AS error_info FROM asked
 WHERE idx % 3 = 1 OR idx % 3 = 0 AND (large_info <> '[]' OR status_info <> '[]'))
SELECT CAST(idx AS BIGINT) AS idx, {fill_sql(G.TEMPLATES[('self_refine', 'zh')], VALS)} AS prompt FROM wrong"""


@register("self_refine_executed", _refine_sql())
def self_refine_executed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions are run and scored; the wrong ones are asked again with
    the first rows they returned, or their error."""
    from quarry.operators import feedback, prompts
    pairs = _asked(spark, sf_dir)
    outcomes, rows = X.run_texts(spark, X.pair_texts(pairs), _views(spark, sf_dir), timeout_s=120, batch_size=4)
    scores = X.score_runs(pairs, outcomes, rows, timeout_s=120)
    recs = prompts.self_refine_records(pairs, feedback.refine_outcomes(pairs, scores, feedback.result_texts(outcomes, rows)).drop("pred_sql_res"))
    return recs.select("idx", prompts.prompt_for(F.lit("self_refine"), prompts._values(recs)).alias("prompt"))


def _selection_sql():
    from quarry.plans.train_queries import CAND_VALS, SEL_VALS, G, fill_sql
    return f"""WITH {ASKED_SQL}, c AS (SELECT idx, 1 AS cand_no, large_sql AS sql, large_info AS exec_info FROM asked
 UNION ALL SELECT idx, 2, broken_sql, broken_info FROM asked UNION ALL SELECT idx, 3, status_sql, status_info FROM asked),
b AS (SELECT idx, cand_no, {fill_sql(G.TEMPLATES[('candidate', 'zh')], CAND_VALS)} AS txt FROM c),
per AS (SELECT idx, count(*) AS num, string_agg(txt, chr(10) || chr(10) ORDER BY cand_no) AS candidates,
  string_agg(cast(cand_no AS VARCHAR), '、' ORDER BY cand_no) AS items FROM b GROUP BY idx)
SELECT CAST(asked.idx AS BIGINT) AS idx, {fill_sql(G.TEMPLATES[('selection', 'zh')], SEL_VALS | {'error_sql': "''", 'error_info': "''"})} AS prompt
FROM asked JOIN per ON asked.idx = per.idx"""


@register("candidate_prompt_executed", _selection_sql())
def candidate_prompt_executed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four answers per question, one of them twice, each shown once with
    the first rows it returned."""
    from quarry.operators import feedback, prompts
    asked = _asked(spark, sf_dir)
    k = F.col("idx").cast("string")
    fill = lambda t: F.concat(F.lit(t.split("{k}")[0]), k, F.lit(t.split("{k}")[1]))
    answers = asked.select("idx", "db", F.explode(F.array(*[F.struct(F.lit(i).alias("cand_no"), fill(t).alias("sql"))
                                                             for i, t in enumerate((LARGEST, BROKEN, STATUS, LARGEST), 1)])).alias("a"))
    answers = answers.select("idx", "db", "a.*")
    texts = answers.select(X.text_id(F.col("db"), F.col("sql")).alias("text_id"), "db", "sql").dropDuplicates(["text_id"])
    outcomes, rows = X.run_texts(spark, texts, _views(spark, sf_dir), timeout_s=120, batch_size=4)
    return prompts.selection_prompts(asked, feedback.candidates(answers, feedback.result_texts(outcomes, rows)))


@register("dry_run", """
SELECT CAST(n_nationkey AS BIGINT) AS pair_id, s.side,
 CASE WHEN s.side = 'pred' AND n_nationkey % 5 = 3 THEN NULL ELSE true END AS ok
FROM nation, (VALUES ('pred'), ('gold')) s(side)""")
def dry_run_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = nation_pairs(spark, sf_dir)
    texts = X.pair_texts(pairs)
    ok = X.dry_run(spark, texts, _views(spark, sf_dir), timeout_s=120)
    sides = pairs.select("pair_id", F.explode(F.array(
        F.struct(F.lit("pred").alias("side"), X.text_id(F.col("db"), F.col("pred_sql")).alias("text_id")),
        F.struct(F.lit("gold").alias("side"), X.text_id(F.col("db"), F.col("gold_sql")).alias("text_id"))))
        .alias("s")).select("pair_id", "s.side", "s.text_id")
    return sides.join(ok, "text_id").select("pair_id", "side", "ok")


@register("pack_pairs", f"""WITH f1 AS ({F1_SQL}), f2 AS ({F2_SQL})
SELECT coalesce(f2.idx, f1.idx) AS idx, nullif(f1.db_name, '') AS db, nullif(f2.pred_sql, '') AS pred_sql,
 nullif(f1.sql, '') AS gold_sql,
 CASE WHEN f1.idx IS NULL THEN 'no_gold' WHEN f2.idx IS NULL THEN 'no_pred' ELSE 'ok' END AS pairing
FROM f2 FULL OUTER JOIN f1 ON f1.idx = f2.idx""")
def pack_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    golds = samples(spark, sf_dir).withColumnRenamed("sql", "SQL")
    return M.package_pairs(replies(spark, sf_dir).drop("sql"), golds)


@register("json_roundtrip")
def json_roundtrip_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S3: raw records written as JSON lines, read back with a fixed
    schema, then normalised (C1) - same answer as ``normalize_records``."""
    from quarry.plans.corpus_queries import raw_records
    from quarry.sources.files import RAW_RENAME, RAW_SCHEMA, read_json_lines, write_json_lines
    from pyspark.sql import types as T
    path = scratch_path(spark, "raw_json")
    write_json_lines(raw_records(spark, sf_dir), path, "idx")
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField("idx", T.LongType())])
    raw = read_json_lines(spark, path, schema, RAW_RENAME)
    raw = raw.withColumn("sql", F.coalesce("SQL_upper", "sql")).drop("SQL_upper")
    gen = load(spark, sf_dir, "nation").select(
        F.col("n_name").alias("db_name"), F.concat(F.lit("【DB_ID】 "), F.col("n_name")).alias("db_schema"))
    return normalize_records(raw, gen, bucket_size=5000)


from quarry.plans.corpus_queries import ORACLES as _CORPUS_ORACLES  # noqa: E402

ORACLES["json_roundtrip"] = _CORPUS_ORACLES["normalize_records"]
