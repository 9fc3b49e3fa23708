"""Rule-based field labels (P13, P14, P16) and prediction inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import catalog as CAT
from quarry.operators import metrics as M
from quarry.operators import profile as PRO
from quarry.plans.catalog_queries import COLS, NUMERIC, TPCH_KEYS
from quarry.sources.tables import load, load_many

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


COLS_EV = dict(COLS, events=[("event_id", "BIGINT"), ("ts", "TIMESTAMP"), ("user_id", "BIGINT"),
                             ("event_type", "TEXT"), ("value", "DOUBLE"), ("props", "TEXT")])
CAT_TABLES = ["orders", "lineitem", "customer", "part", "events"]
INTEGRAL_SQL = {"BIGINT", "INTEGER"}


def _category_sql(t, c, ty):
    cate = {"BIGINT": "Number", "INTEGER": "Number", "DOUBLE": "Number", "TEXT": "String",
            "TIMESTAMP": "DateTime"}[ty]
    integral = "true" if ty in INTEGRAL_SQL else "false"
    id_like = "true" if c.lower().endswith("key") or c.lower().endswith("id") else "false"
    dv = (f"(SELECT DISTINCT cast({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL)")
    share = f"(SELECT avg(CASE WHEN regexp_matches(v, '{PRO.DATE_TEXT_RE}') THEN 1.0 ELSE 0.0 END) FROM {dv})"
    ymd = (f"(SELECT bool_and(regexp_matches(v, '^(19|20)\\d{{2}}(0[1-9]|1[0-2])(0[1-9]|[12]\\d|3[01])$')) "
           f"FROM {dv})")
    nd, n = f"count(DISTINCT {c})", f"count({c})"
    repeating = f"({nd} <= 50 AND {nd} * 2 <= {n})"
    unique = f"({nd} = {n} AND {n} > 0)"
    if cate == "Number":
        year_like = f"({integral} AND min({c}) >= 1000 AND max({c}) <= 2999 AND NOT {id_like})"
        date_like = f"({year_like} OR ({integral} AND coalesce({ymd}, false)))"
        rest = (f"CASE WHEN {integral} AND {repeating} AND NOT {id_like} THEN 'Enum' "
                f"WHEN {integral} AND ({unique} OR {id_like}) THEN 'Code' ELSE 'Measure' END")
    elif cate == "String":
        date_like = f"(coalesce({share}, 0) >= 0.9)"
        rest = (f"CASE WHEN {repeating} THEN 'Enum' WHEN max(length({c})) > 30 THEN 'Text' ELSE 'Code' END")
    else:
        date_like, rest = "false", "'Code'"
    if cate == "DateTime":
        cat = "'DateTime'"
    else:
        cat = f"CASE WHEN {n} > 0 AND {date_like} THEN 'DateTime' ELSE {rest} END"
    return (f"SELECT '{t}' AS table_name, '{c}' AS field_name, {cat} AS category, "
            f"CASE WHEN {cat} = 'Measure' THEN 'Measure' ELSE 'Dimension' END AS dim_or_meas FROM {t} "
            f"HAVING count(*) >= 0")


@register("field_category", "\nUNION ALL\n".join(_category_sql(t, c, ty) for t in CAT_TABLES
                                                  for c, ty in COLS_EV[t]))
def field_category_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PRO.field_categories(load_many(spark, sf_dir, CAT_TABLES))


def _grain_sql(t, c):
    m = f"epoch_us({c})"
    units = [(f"{m} % 1000 <> 0", "MICROSECOND"), (f"{m} % 1000000 <> 0", "MILLISECOND"),
             (f"floor({m} / 1000000) % 60 <> 0", "SECOND"), (f"floor({m} / 60000000) % 60 <> 0", "MINUTE"),
             (f"floor({m} / 3600000000) % 24 <> 0", "HOUR"), (f"dayofmonth({c}) <> 1", "DAY"),
             (f"month({c}) <> 1", "MONTH")]
    case = "CASE " + " ".join(f"WHEN bool_or({cond}) THEN '{u}'" for cond, u in units) + \
        f" WHEN count({c}) = 0 THEN NULL ELSE 'YEAR' END"
    return f"SELECT '{t}' AS table_name, '{c}' AS field_name, {case} AS date_min_gran FROM {t}"


@register("date_granularity", "\nUNION ALL\n".join(
    _grain_sql(t, c) for t in ["orders", "lineitem", "events"] for c, ty in COLS_EV[t] if ty == "TIMESTAMP"))
def date_granularity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PRO.date_granularity(load_many(spark, sf_dir, ["orders", "lineitem", "events"]))


COMMENT_TABLES = ["region", "nation", "supplier"]
TABLE_COMMENTS = {"region": "regions", "nation": "the nations of the world"}
FIELD_COMMENTS = {("nation", "n_name"): "nation name"}


def _descriptions(spark, tables):
    prof = PRO.profile(tables, n_examples=0)
    f = prof.select("table_name", "field_name", F.concat(
        F.lit('"'), F.col("field_name"), F.lit(": "), F.col("n_distinct").cast("string"),
        F.lit(" distinct values。"), F.lit('"')).alias("description"))
    t = prof.groupBy("table_name").agg(F.max("n_rows").alias("n")).select(
        "table_name", F.lit(None).cast("string").alias("field_name"),
        F.concat(F.lit("**"), F.col("table_name"), F.lit(" table with "), F.col("n").cast("string"),
                 F.lit(" rows**")).alias("description"))
    return f.unionByName(t)


@register("comment_modes")
def comment_modes_q(spark: SparkSession, sf_dir: str, names=tuple(COMMENT_TABLES)) -> DataFrame:
    tables = load_many(spark, sf_dir, names)
    ct, cf, _ = CAT.build_catalog(spark, "tpch", tables, primary_keys=TPCH_KEYS,
                                  table_comments=TABLE_COMMENTS, field_comments=FIELD_COMMENTS, n_examples=0)
    desc = _descriptions(spark, tables)
    out = None
    for mode in CAT.COMMENT_MODES:
        t, f = CAT.apply_comment_mode(ct, cf, mode, desc)
        part = (t.select(F.lit(mode).alias("mode"), "table_name", F.lit("").alias("field_name"), "comment")
                .unionByName(f.select(F.lit(mode).alias("mode"), "table_name", "field_name", "comment")))
        out = part if out is None else out.unionByName(part)
    return out


def _comment_oracle(names=tuple(COMMENT_TABLES)):
    rows_t, rows_f = [], []
    for t in names:
        tc = TABLE_COMMENTS.get(t, "")
        n = f"(SELECT count(*) FROM {t})"
        gen_t = f"'{t} table with ' || {n} || ' rows'"
        for mode in ["origin", "no_comment", "generation", "merge"]:
            if mode == "origin":
                v = f"'{tc}'"
            elif mode == "no_comment":
                v = "''"
            elif mode == "generation":
                v = gen_t
            else:
                v = f"'{tc}'" if len(tc) >= 10 else gen_t
            rows_t.append(f"SELECT '{mode}' AS mode, '{t}' AS table_name, '' AS field_name, {v} AS comment")
        for c, _ in COLS[t]:
            fc = FIELD_COMMENTS.get((t, c), "")
            gen_f = f"'{c}: ' || (SELECT count(DISTINCT {c}) FROM {t}) || ' distinct values'"
            for mode in ["origin", "no_comment", "generation", "merge"]:
                if mode == "origin":
                    v = f"'{fc}'"
                elif mode == "no_comment":
                    v = "''"
                elif mode == "generation":
                    v = gen_f
                else:
                    v = f"'{fc}'" if fc else gen_f
                rows_f.append(f"SELECT '{mode}', '{t}', '{c}', {v}")
    return "\nUNION ALL\n".join(rows_t + rows_f)


ORACLES["comment_modes"] = _comment_oracle()


@register("prediction_inspect", r"""
WITH c AS (SELECT row_number() OVER (ORDER BY f1.idx) - 1 AS id, f1.question FROM orders o
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey,
  (SELECT o_orderkey AS idx, concat('How many orders did customer ', cast(o_custkey AS string), ' place?') AS question
   FROM orders) f1 WHERE f1.idx = o.o_orderkey)
SELECT id, question AS question_text FROM c""")
def prediction_inspect_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.plans.train_queries import chat_train_q
    c = chat_train_q(spark, sf_dir)
    return M.inspect_predictions(c, "prompt").select("id", "question_text")


# Shapes whose answer is stated, not computed: a text per order, one of these by its key.
LITERAL_SHAPES = [  # (statement, its tidy form, a second statement, whether the two match)
    ("SELECT a -- don't count dups\nFROM t -- x\nWHERE b = 1", "SELECT a \nFROM t \nWHERE b = 1",
     "select A from T where B=1", 1),
    ("SELECT 'a--b' FROM t", "SELECT 'a--b' FROM t", "SELECT 'a--c' FROM t", 0),
    ("SELECT 'a - b', \"x--y\" FROM t", "SELECT 'a - b', \"x--y\" FROM t", "SELECT 'a-b', \"x--y\" FROM t", 0),
    ("SELECT 'it''s -- fine' FROM t -- it's not", "SELECT 'it''s -- fine' FROM t ",
     "SELECT 'it''s -- fine' /* it's */ FROM `t`;", 0),
    ("SELECT [a] FROM t;", "SELECT [a] FROM t;", "select  \"a\"\nfrom t -- it's quoted\n", 1),
    ("SELECT 'A'", "SELECT 'A'", "SELECT 'a'", 0),
]

LITERAL_REPLIES = [  # (last JSON block of a reply, its sql, its ok)
    ("""{'sql': "WHERE n = 'x'", 'ok': True}""", "WHERE n = 'x'", "true"),
    ("""{"sql": "n = 'True'", "ok": false}""", "n = 'True'", "false"),
    ("""{'sql': 'say "hi"', 'ok': None}""", 'say "hi"', None),
    ("""[{'sql': 'a', 'ok': True}, {'sql': 'b', 'ok': False}]""", "a", "true"),
    ("""not json""", None, None),
]


def _sql_case(key, values):
    text = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN {text(v)}" for i, v in enumerate(values)) + " END"


def _shape(key, values):
    out = F.lit(None)
    for i, v in enumerate(values):
        out = F.when(key == i, F.lit(v)).otherwise(out)
    return out


_K = f"o_orderkey % {len(LITERAL_SHAPES)}"


@register("sql_literals", f"""SELECT o_orderkey AS idx, {_sql_case(_K, [s[1] for s in LITERAL_SHAPES])} AS tidy,
 {_sql_case(_K, [s[3] for s in LITERAL_SHAPES])} AS text_match FROM orders""")
def sql_literals_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 and E11 where quotes stand in comments and comment marks in literals."""
    from quarry.operators.augment import sql_tidy
    from quarry.operators.compare import sql_text_match
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx"))
    k = F.col("idx") % len(LITERAL_SHAPES)
    o = o.withColumn("x", _shape(k, [s[0] for s in LITERAL_SHAPES])).withColumn("y", _shape(k, [s[2] for s in LITERAL_SHAPES]))
    return o.select("idx", sql_tidy("x").alias("tidy"), sql_text_match(F.col("x"), F.col("y")).alias("text_match"))


_R = f"o_orderkey % {len(LITERAL_REPLIES)}"


@register("json_literals", f"""SELECT o_orderkey AS idx, {_sql_case(_R, [s[1] for s in LITERAL_REPLIES])} AS first_sql,
 {_sql_case(_R, [s[2] for s in LITERAL_REPLIES])} AS first_ok, CASE {_R} WHEN 3 THEN 2 WHEN 4 THEN 0 ELSE 1 END AS n FROM orders""")
def json_literals_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 on Python-style replies, strings that hold quotes, and lists."""
    from quarry.operators.responses import json_replies
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx"))
    body = _shape(F.col("idx") % len(LITERAL_REPLIES), [s[0] for s in LITERAL_REPLIES])
    o = o.withColumn("all", json_replies(F.concat(F.lit("Here: ```json\n"), body, F.lit("\n```"))))
    return o.select("idx", F.get("all", F.lit(0))["sql"].alias("first_sql"), F.get("all", F.lit(0))["ok"].alias("first_ok"),
                    F.size("all").alias("n"))
