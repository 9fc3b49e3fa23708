"""Reply cleaning queries (R1-R4, A5, T6) over F2 with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import responses as R
from quarry.operators.augment import sql_tidy
from quarry.plans.fixtures import F2_SQL, replies
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


NL = "chr(10)"
FENCE = "'```'"


def _strip(x):
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


R1_SQL = f"""
s1 AS (SELECT idx, CASE WHEN len(regexp_extract_all(x, '(?s)```sql(.*?)```', 1)) > 0
   THEN {_strip("regexp_extract_all(x, '(?s)```sql(.*?)```', 1)[-1]")} ELSE x END AS s FROM src),
s2 AS (SELECT idx, CASE WHEN contains(left(s, 5), {FENCE}) THEN split_part(s, {FENCE}, -1) ELSE s END AS s FROM s1),
s3 AS (SELECT idx, CASE WHEN contains(right(s, 5), {FENCE}) THEN split_part(s, {FENCE}, 1) ELSE s END AS s FROM s2)"""


@register("extract_sql", f"""
WITH f2 AS ({F2_SQL}), src AS (SELECT idx, pred_sql AS x FROM f2), {R1_SQL}
SELECT idx, s AS extracted FROM s3""")
def extract_sql_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies(spark, sf_dir).select("idx", R.extract_sql("pred_sql").alias("extracted"))


def _lines_until(text, stop):
    lines = (f"list_filter(list_transform(string_split({text}, {NL}), lambda l: {_strip('l')}), "
             f"lambda l: length(l) > 0)")
    flags = f"list_transform({lines}, lambda l, i: i > 1 AND ({stop}))"
    p = f"list_position({flags}, true)"
    return (f"array_to_string(CASE WHEN coalesce({p}, 0) > 0 THEN ({lines})[1:greatest({p} - 1, 1)] "
            f"ELSE {lines} END, ' ')")


def _any_in(line, phrases):
    return " OR ".join(f"contains({line}, '{p.replace(chr(39), chr(39) * 2)}')" for p in phrases)


def _starts_kw(x):
    return " OR ".join(f"starts_with(upper({x}), '{k}')" for k in R.SQL_KEYWORDS)


def _clean_sql(variant):
    c = _strip("x")
    sql_block = _strip(f"split_part(split_part({c}, '```sql', 2), {FENCE}, 1)")
    plain = _strip(f"split_part({c}, {FENCE}, 2)")
    if variant == 2:
        lines = _lines_until(c, _any_in("l", R.EXPLANATION_PHRASES))
        tail = ""
    else:
        lines = _lines_until(c, f"({_any_in('lower(l)', R.EXPLANATION_PHRASES_LOWER)}) OR "
                                f"(contains(l, {FENCE}) AND NOT contains(upper(l), 'SELECT'))")
        pos = "CASE " + " ".join(f"WHEN instr(upper({c}), '{k}') > 0 THEN instr(upper({c}), '{k}')"
                                 for k in R.SQL_KEYWORDS) + " ELSE 0 END"
        rest = _strip(f"substr({c}, {pos})")
        lines4 = _lines_until(rest, _any_in("lower(l)", R.EXPLANATION_PHRASES_SHORT))
        tail = f"WHEN {pos} > 0 THEN {lines4}"
    return f"""CASE WHEN x IS NULL OR x = '' THEN x
 WHEN contains({c}, '```sql') THEN {sql_block}
 WHEN contains({c}, {FENCE}) AND ({_starts_kw(plain)}) THEN {plain}
 WHEN {_starts_kw(c)} THEN {lines}
 {tail}
 ELSE {c} END"""


@register("clean_sql", f"""
WITH f2 AS ({F2_SQL}), src AS (SELECT idx, pred_sql AS x FROM f2)
SELECT idx, {_clean_sql(2)} AS cleaned FROM src""")
def clean_sql_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies(spark, sf_dir).select("idx", R.clean_sql("pred_sql").alias("cleaned"))


@register("sql_only", f"""
WITH f2 AS ({F2_SQL}), src AS (SELECT idx, concat('Answer: ', pred_sql) AS x FROM f2
 UNION ALL SELECT idx + 1000000000, pred_sql FROM f2)
SELECT idx, {_clean_sql(3)} AS cleaned FROM src""")
def sql_only_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    f2 = replies(spark, sf_dir)
    src = f2.select("idx", F.concat(F.lit("Answer: "), "pred_sql").alias("x")).unionByName(
        f2.select((F.col("idx") + 1000000000).alias("idx"), F.col("pred_sql").alias("x")))
    return src.select("idx", R.sql_only("x").alias("cleaned"))


@register("sql_tidy", f"""
WITH f2 AS ({F2_SQL}),
a AS (SELECT idx, CASE WHEN contains(pred_sql, '--') THEN array_to_string(list_transform(
   string_split(pred_sql, ''''), lambda p, i: CASE WHEN i % 2 = 1
     THEN regexp_replace(p, '--[^\\n]*(\\n|$)', chr(10), 'g') ELSE p END), '''') ELSE pred_sql END AS s FROM f2),
b AS (SELECT idx, CASE WHEN length(s) - length(replace(s, chr(10), '')) >= 3
   THEN regexp_replace(regexp_replace(s, '\\s+', ' ', 'g'), '^ | $', '', 'g') ELSE s END AS x FROM a),
src AS (SELECT idx, x FROM b), {R1_SQL}
SELECT idx, s AS tidy FROM s3""")
def sql_tidy_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies(spark, sf_dir).select("idx", sql_tidy("pred_sql").alias("tidy"))


def json_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    sql = F.concat(F.lit("SELECT COUNT(*) FROM orders WHERE o_custkey = "), F.col("o_custkey").cast("string"))
    k = F.col("o_orderkey") % 3
    body = (F.when(k == 0, F.concat(F.lit('{"sql": "'), sql, F.lit('", "ok": true}')))
            .when(k == 1, F.concat(F.lit("{'sql': '"), sql, F.lit("', 'ok': True}")))
            .otherwise(F.lit("not json")))
    return o.select(F.col("o_orderkey").alias("idx"),
                    F.concat(F.lit("Result: ```json\n"), body, F.lit("\n```")).alias("reply"))


JSON_SQL = """SELECT o_orderkey AS idx, concat('Result: ```json', chr(10), CASE o_orderkey % 3
  WHEN 0 THEN concat('{"sql": "', 'SELECT COUNT(*) FROM orders WHERE o_custkey = ', cast(o_custkey AS string), '", "ok": true}')
  WHEN 1 THEN concat('{''sql'': ''', 'SELECT COUNT(*) FROM orders WHERE o_custkey = ', cast(o_custkey AS string), ''', ''ok'': True}')
  ELSE 'not json' END, chr(10), '```') AS reply FROM orders"""


@register("json_reply", rf"""
WITH r AS ({JSON_SQL}),
b AS (SELECT idx, regexp_extract_all(replace(reply, chr(10), ''), '(?s)```json(.*?)```', 1) AS blocks FROM r),
c AS (SELECT idx, len(blocks) AS nb, {_strip("blocks[-1]")} AS body FROM b),
d AS (SELECT idx, nb, body, regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '''', '"', 'g'),
  '\bTrue\b', 'true', 'g'), '\bFalse\b', 'false', 'g'), '\bNone\b', 'null', 'g') AS rep FROM c),
j AS (SELECT idx, CASE WHEN nb = 0 THEN '{{}}' WHEN json_valid(body) THEN body WHEN json_valid(rep) THEN rep
  ELSE '{{}}' END AS j FROM d)
SELECT idx, json_extract_string(j, '$.sql') AS j_sql, json_extract_string(j, '$.ok') AS j_ok,
 CAST(len(json_keys(j)) AS INTEGER) AS n_keys FROM j""")
def json_reply_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = json_replies(spark, sf_dir).select("idx", R.json_reply("reply").alias("m"))
    return m.select("idx", F.col("m")["sql"].alias("j_sql"), F.col("m")["ok"].alias("j_ok"),
                    F.size("m").alias("n_keys"))


# ------------------------------------------------------------- streaming --

@register("stream_clean_replies")
def stream_clean_replies_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1, R2 and A5 applied by a Structured Streaming query: F2 replies are
    written to a folder, streamed through the cleaners (``availableNow``) into
    a Parquet sink with its checkpoint in the shared folder, and read back."""
    from quarry.session import scratch_path
    from quarry.streaming.replies import REPLY_SCHEMA, stream_clean
    src, sink = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-sink")
    replies(spark, sf_dir).select(*[f.name for f in REPLY_SCHEMA.fields]).write.parquet(src)
    q = stream_clean(spark, src, sink)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink).select("idx", "extracted", "cleaned", "tidy")


ORACLES["stream_clean_replies"] = f"""
SELECT e.idx, e.extracted, c.cleaned, t.tidy
FROM ({ORACLES['extract_sql'].strip()}) e
JOIN ({ORACLES['clean_sql'].strip()}) c ON c.idx = e.idx
JOIN ({ORACLES['sql_tidy'].strip()}) t ON t.idx = e.idx"""
