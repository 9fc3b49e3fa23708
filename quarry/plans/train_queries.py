"""Prompt, training-set and prediction queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import predict as PR
from quarry.operators import prompts as G
from quarry.operators import responses as R
from quarry.operators import sft as T
from quarry.operators.compare import sql_text_match
from quarry.operators.corpus import chat_inspection, reindex
from quarry.plans.eval_queries import SQL_KEY
from quarry.plans.fixtures import F2_SQL, PROCESSED_SQL, processed, replies
from quarry.plans.response_queries import R1_SQL
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


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def fill_sql(template: str, values: dict[str, str]) -> str:
    """The same template rendered by SQL ``||`` (oracle side)."""
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(_sql_lit(template[pos:m.start()]))
        parts.append(f"coalesce(CAST({values[m.group(1)]} AS VARCHAR), '')")
        pos = m.end()
    if pos < len(template):
        parts.append(_sql_lit(template[pos:]))
    return "(" + " || ".join(parts) + ")"


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
VALS = {"question": "question", "db_schema": STRIP.format("db_schema"), "evidence": "evidence",
        "error_sql": "error_sql", "error_info": "error_info"}


def _records(spark, sf_dir):
    return reindex(processed(spark, sf_dir), ["idx"], 0, "id")


REC_SQL = f"SELECT row_number() OVER (ORDER BY idx) - 1 AS id, * FROM ({PROCESSED_SQL})"


@register("chat_train", f"""WITH r AS ({REC_SQL})
SELECT id, 'nl2sqlite' AS sql_type, {fill_sql(G.TEMPLATES[('nl2sqlite', 'en')], VALS)} AS prompt,
 chr(10) || sql || chr(10) || '```' AS answer FROM r""")
def chat_train_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = G.train_samples(_records(spark, sf_dir), "nl2sqlite", english=True)
    return c.select("id", "sql_type", F.col("conversations")[0]["content"].alias("prompt"),
                    F.col("conversations")[1]["content"].alias("answer"))


@register("chat_test", f"""WITH r AS ({REC_SQL})
SELECT id, 'nl2postgresql' AS sql_type, {fill_sql(G.TEMPLATES[('nl2postgresql', 'zh')], VALS)} AS prompt,
 sql AS answer, sql, db_name FROM r""")
def chat_test_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = G.test_samples(_records(spark, sf_dir), "nl2postgres", english=False)
    return c.select("id", "sql_type", F.col("conversations")[0]["content"].alias("prompt"),
                    F.col("conversations")[1]["content"].alias("answer"), "sql", "db_name")


R1_OF_F2 = f"WITH f2 AS ({F2_SQL}), src AS (SELECT idx, pred_sql AS x FROM f2), {R1_SQL.strip()}"


@register("self_refine", f"""{R1_OF_F2},
o AS (SELECT f2.idx, s3.s AS error_sql, 'result does not match the question' AS error_info
  FROM f2 JOIN s3 ON f2.idx = s3.idx WHERE {SQL_KEY.format(x='f2.sql')} <> {SQL_KEY.format(x='s3.s')}),
r AS ({PROCESSED_SQL})
SELECT r.idx, {fill_sql(G.TEMPLATES[('self_refine', 'zh')], VALS)} AS prompt FROM r JOIN o ON r.idx = o.idx""")
def self_refine_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    f2 = replies(spark, sf_dir).withColumn("pred_sql", R.extract_sql("pred_sql"))
    outcomes = f2.select("idx", "pred_sql", sql_text_match(F.col("sql"), F.col("pred_sql")).alias("ex_eq"),
                         F.lit("result does not match the question").alias("exec_info"))
    recs = G.self_refine_records(processed(spark, sf_dir), outcomes)
    return recs.select("idx", G.prompt_for(F.lit("self_refine"), G._values(recs)).alias("prompt"))


CAND_VALS = {"id": "cand_no", "sql": "sql", "exec_info": "exec_info"}
SEL_VALS = dict(VALS, num="num", candidates="candidates", items="items")


@register("candidate_prompt", f"""{R1_OF_F2},
c AS (SELECT idx, 1 AS cand_no, pred_sql AS sql, '' AS exec_info FROM f2
  UNION ALL SELECT idx, 2, s, '' FROM s3 UNION ALL SELECT idx, 3, sql, '' FROM f2),
b AS (SELECT idx, cand_no, {fill_sql(G.TEMPLATES[('candidate', 'zh')], CAND_VALS)} AS txt FROM c),
per AS (SELECT idx, count(*) AS num, string_agg(txt, chr(10) || chr(10) ORDER BY cand_no) AS candidates,
  string_agg(cast(cand_no AS VARCHAR), '、' ORDER BY cand_no) AS items FROM b GROUP BY idx),
r AS ({PROCESSED_SQL})
SELECT r.idx, {fill_sql(G.TEMPLATES[('selection', 'zh')], SEL_VALS)} AS prompt FROM r JOIN per ON r.idx = per.idx""")
def candidate_prompt_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    f2 = replies(spark, sf_dir)
    c = (f2.select("idx", F.lit(1).alias("cand_no"), F.col("pred_sql").alias("sql"))
         .unionByName(f2.select("idx", F.lit(2).alias("cand_no"), R.extract_sql("pred_sql").alias("sql")))
         .unionByName(f2.select("idx", F.lit(3).alias("cand_no"), "sql"))
         .withColumn("exec_info", F.lit("")))
    return G.selection_prompts(processed(spark, sf_dir), c)


def _chat_sql(prompt, answer, with_opener):
    user = f"'<|im_start|>user' || chr(10) || {prompt} || '<|im_end|>' || chr(10)"
    if with_opener:
        return f"{user} || '<|im_start|>assistant' || chr(10)"
    return f"{user} || '<|im_start|>assistant' || chr(10) || {answer} || '<|im_end|>' || chr(10)"


TOKENS = r"len(regexp_extract_all({}, '(\w+|[^\w\s])', 1))"
CHAT_TRAIN = ORACLES["chat_train"]


@register("label_mask", f"""WITH c AS ({CHAT_TRAIN})
SELECT id, CAST({TOKENS.format(_chat_sql('prompt', 'answer', False))} AS INTEGER) AS n_tokens,
 CAST({TOKENS.format(_chat_sql('prompt', 'answer', True))} AS INTEGER) AS n_masked FROM c""")
def label_mask_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = G.train_samples(_records(spark, sf_dir), "nl2sqlite")
    m = T.label_mask(c)
    return m.select("id", F.size("input_ids").alias("n_tokens"),
                    F.size(F.filter("labels", lambda x: x == T.IGNORE_ID)).alias("n_masked"))


@register("length_batches", f"""WITH c AS ({CHAT_TRAIN}),
n AS (SELECT id, least({TOKENS.format(_chat_sql('prompt', 'answer', False))}, 8192) AS n FROM c),
b AS (SELECT id, n, floor((row_number() OVER (ORDER BY n, id) - 1) / 64) AS batch FROM n)
SELECT id, CAST(batch AS BIGINT) AS batch, CAST(max(n) OVER (PARTITION BY batch) AS INTEGER) AS padded_len FROM b""")
def length_batches_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = G.train_samples(_records(spark, sf_dir), "nl2sqlite")
    b = T.length_batches(T.label_mask(c), 64, "id")
    return b.select("id", F.col("batch").cast("long").alias("batch"), F.size("input_ids").alias("padded_len"))


DIALECT_TYPES = ["nl2sqlite", "nl2postgresql", "nl2mysql", "cypher", "ngql", "nl2sql"]


def _typed(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx"))
    arr = F.array(*[F.lit(x) for x in DIALECT_TYPES])
    return o.withColumn("sql_type", F.element_at(arr, (F.col("idx") % len(DIALECT_TYPES) + 1).cast("int")))


TYPED_SQL = ("SELECT o_orderkey AS idx, [" + ", ".join(f"'{x}'" for x in DIALECT_TYPES)
             + f"][o_orderkey % {len(DIALECT_TYPES)} + 1] AS sql_type FROM orders")


@register("dialect_code", f"""WITH t AS ({TYPED_SQL})
SELECT idx, sql_type, CAST(CASE regexp_replace(lower(sql_type), '^nl2', '')
 WHEN 'postgresql' THEN 0 WHEN 'mysql' THEN 1 WHEN 'sqlite' THEN 2 WHEN 'cypher' THEN 2 WHEN 'ngql' THEN 2
 END AS INTEGER) AS code FROM t""")
def dialect_code_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 with three router slots (codes above 2 are capped)."""
    t = _typed(spark, sf_dir)
    return t.select("idx", "sql_type", T.dialect_code(F.col("sql_type"), 3).alias("code"))


@register("eval_target", f"""WITH t AS ({TYPED_SQL}), r AS ({PROCESSED_SQL})
SELECT r.idx, concat_ws('[sep]', r.db_name, t.sql_type, r.sql) AS target FROM r JOIN t ON r.idx = t.idx""")
def eval_target_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = processed(spark, sf_dir).join(_typed(spark, sf_dir), "idx")
    return r.select("idx", T.eval_target(F.col("db_name"), F.col("sql_type"), F.col("sql")).alias("target"))


@register("seeded_shuffle", f"""SELECT idx, row_number() OVER (ORDER BY md5(concat('42:shuffle:', cast(idx AS VARCHAR))), idx) - 1
 AS shuffle_pos FROM ({PROCESSED_SQL})""")
def seeded_shuffle_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.seeded_shuffle(processed(spark, sf_dir), "idx", 42).select("idx", "shuffle_pos")


@register("strip_prompt", f"""WITH c AS ({CHAT_TRAIN})
SELECT id, substr(prompt || answer, length(prompt) + 1) AS pred_sql FROM c""")
def strip_prompt_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chat_train_q(spark, sf_dir)
    return c.select("id", R.strip_prompt(F.concat("prompt", "answer"), F.col("prompt")).alias("pred_sql"))


@register("resume_todo", f"""{R1_OF_F2}
SELECT f2.idx FROM f2 WHERE f2.idx NOT IN (SELECT idx FROM s3 WHERE length(coalesce(s, '')) > 0)""")
def resume_todo_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    f2 = replies(spark, sf_dir)
    saved = f2.select("idx", R.extract_sql("pred_sql").alias("pred_sql"))
    return PR.resume_todo(f2.select("idx"), saved)


def _stub_predictor(prompts: list[str]) -> list[str]:
    """Plug-in stand-in: answers with the SQL comment of the question."""
    out = []
    for p in prompts:
        q = p.split("【Question】\n")[-1].split("\n")[0] if "【Question】\n" in p else ""
        out.append(f"-- {q}\nSELECT 1")
    return out


@register("predict_stub", f"""WITH r AS ({REC_SQL})
SELECT id, '-- ' || question || chr(10) || 'SELECT 1' AS pred_sql FROM r""")
def predict_stub_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 through ``mapInPandas`` with a stand-in predictor."""
    c = chat_train_q(spark, sf_dir)
    p = PR.batched_predict(c.select("id", "prompt"), _stub_predictor)
    return p.select("id", "pred_sql")


@register("chat_inspect", f"""WITH a AS ({CHAT_TRAIN}), b AS ({ORACLES['chat_test']}),
u AS (SELECT prompt FROM a UNION ALL SELECT prompt FROM b)
SELECT CASE WHEN starts_with(prompt, '你是一名') THEN 'zh' WHEN starts_with(prompt, 'You are') THEN 'en'
 ELSE 'other' END AS language, count(*) AS n_samples FROM u GROUP BY 1""")
def chat_inspect_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _records(spark, sf_dir)
    u = G.train_samples(r, "nl2sqlite").select("conversations").unionByName(
        G.test_samples(r, "nl2postgresql", english=False).select("conversations"))
    return chat_inspection(u)


@register("conversation_mask", r"""WITH c AS (SELECT conv_id, turn, role, text,
  max(turn) FILTER (WHERE role = 'assistant') OVER (PARTITION BY conv_id) AS last_a FROM conversations),
t AS (SELECT conv_id,
  string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS full_,
  string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn)
    FILTER (WHERE turn < last_a) AS prompt_
  FROM c WHERE last_a IS NOT NULL AND turn <= last_a GROUP BY conv_id)
SELECT conv_id, CAST(len(regexp_extract_all(full_, '(\w+|[^\w\s])', 1)) AS INTEGER) AS n_tokens,
 CAST(len(regexp_extract_all(coalesce(prompt_, '') || '<|im_start|>assistant' || chr(10), '(\w+|[^\w\s])', 1)) AS INTEGER) AS n_masked
FROM t""")
def conversation_mask_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on the ``conversations`` table: each conversation up to its last
    assistant turn is one sample whose earlier turns are masked.  Every
    formatted turn ends in white space, so token counts add up turn by turn:
    they are summed per conversation (map-side partial aggregation) instead
    of gathering a conversation's text into one row."""
    conv = load(spark, sf_dir, "conversations")
    last_a = conv.where(F.col("role") == "assistant").groupBy("conv_id").agg(F.max("turn").alias("_la"))
    turns = conv.join(last_a, "conv_id").where(F.col("turn") <= F.col("_la"))
    text = T.chat_text(F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("content"))))
    n = F.size(T.default_tokenize(text))
    opener = F.size(T.default_tokenize(F.lit("<|im_start|>assistant\n")))
    per = turns.groupBy("conv_id").agg(
        F.sum(n).cast("int").alias("n_tokens"),
        F.sum(F.when(F.col("turn") < F.col("_la"), n).otherwise(0)).cast("int").alias("_pm"))
    return per.select("conv_id", "n_tokens", (F.col("_pm") + opener).cast("int").alias("n_masked"))
