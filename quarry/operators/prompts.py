"""Prompt rendering.

Templates are our own wording with the reference's slots (``question``,
``db_schema``, ``evidence``, ``error_sql``, ``error_info``).  A template is
split into literal parts and slots at plan time and rendered with
``concat``, so text inside a value that looks like a slot is never expanded.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.responses import strip_ws

_ASK_EN = ("Read the 【Database Schema】 below and any 【Evidence】 given, then write one {dialect} "
           "query that answers the 【Question】.\n\n【Database Schema】\n{db_schema}\n\n【Evidence】\n"
           "{evidence}\n\n【Question】\n{question}\n\n```sql")
_ASK_ZH = ("请阅读下面的【数据库schema】和给出的【参考信息】，写出一条{dialect}语句来回答【用户问题】。\n\n"
           "【数据库schema】\n{db_schema}\n\n【参考信息】\n{evidence}\n\n【用户问题】\n{question}\n\n```sql")
_GRAPH_ZH = ("请阅读下面的【图数据库schema】和给出的【参考信息】，写出一条{dialect}查询来回答【用户问题】。\n\n"
             "【图数据库schema】\n{db_schema}\n\n【参考信息】\n{evidence}\n\n【用户问题】\n{question}\n\n```{fence}")

TEMPLATES = {
    ("sql", "zh"): "你是一名SQL工程师。" + _ASK_ZH.replace("{dialect}", "SQL"),
    ("nl2sqlite", "zh"): "你是一名SQLite工程师。" + _ASK_ZH.replace("{dialect}", "SQLite"),
    ("nl2mysql", "zh"): "你是一名MySQL工程师。" + _ASK_ZH.replace("{dialect}", "MySQL"),
    ("nl2postgresql", "zh"): "你是一名PostgreSQL工程师。" + _ASK_ZH.replace("{dialect}", "PostgreSQL"),
    ("cypher", "zh"): "你是一名Neo4j工程师。" + _GRAPH_ZH.replace("{dialect}", "Cypher")
    .replace("{fence}", "cypher"),
    ("ngql", "zh"): "你是一名NebulaGraph工程师。" + _GRAPH_ZH.replace("{dialect}", "nGQL")
    .replace("{fence}", "ngql"),
    ("nl2sqlite", "en"): "You are a SQLite engineer. " + _ASK_EN.replace("{dialect}", "SQLite"),
    ("nl2postgresql", "en"): "You are a PostgreSQL engineer. " + _ASK_EN.replace("{dialect}", "PostgreSQL"),
    ("self_refine", "zh"): (
        "【用户问题】\n{question}\n\n【数据库schema】\n{db_schema}\n\n【参考信息】\n{evidence}\n\n"
        "之前写的【SQL】\n{error_sql}\n\n运行后得到【执行结果】\n{error_info}\n\n"
        "这条语句没有答对问题。想一想错在哪里，重新写一条SQLite语句，只输出语句。\n\n```sql"),
    ("candidate", "zh"): "<{id}>\n{sql}\n-- 运行结果：\n{exec_info}",
    ("selection", "zh"): (
        "【用户问题】\n{question}\n\n【数据库schema】\n{db_schema}\n\n【参考信息】\n{evidence}\n\n"
        "有人写了{num}种答案，每种都附上了运行结果的开头：\n\n{candidates}\n\n"
        "哪一种真正回答了问题？只写它的编号（{items}）。"),
}

# --- fixed values: task names accepted by prompt rendering ---
TASKS_BOTH_LANGUAGES = ["nl2sqlite", "nl2postgresql"]
TASKS_ZH_ONLY = ["nl2mysql", "cypher", "self_refine"]
TASK_ALIASES = {"nl2postgres": "nl2postgresql"}
# --- end of fixed values ---

_SLOT = re.compile(r"\{(\w+)\}")


def fill(template: str, values: dict[str, Column]) -> Column:
    """Render ``template`` with column values (NULL values render as '')."""
    parts, pos = [], 0
    for m in _SLOT.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(values[m.group(1)].cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def normalize_task(task: Column) -> Column:
    t = F.lower(task)
    for a, b in TASK_ALIASES.items():
        t = F.when(t == a, F.lit(b)).otherwise(t)
    return t


def prompt_for(task: Column, values: dict[str, Column], english: bool = True) -> Column:
    """G2 prompt text for a per-row task; unknown tasks (e.g. ``nl2sql``,
    quirk Q13) fail the job with a clear message."""
    t = normalize_task(task)
    expr = None
    for name in TASKS_BOTH_LANGUAGES + TASKS_ZH_ONLY:
        lang = "en" if english and name in TASKS_BOTH_LANGUAGES else "zh"
        e = fill(TEMPLATES[(name, lang)], values)
        expr = F.when(t == name, e) if expr is None else expr.when(t == name, e)
    return expr.otherwise(F.raise_error(F.concat(F.lit("unsupported task for prompts: "), task)))


def _values(df: DataFrame) -> dict[str, Column]:
    v = {"question": F.col("question"), "db_schema": strip_ws(F.col("db_schema")),
         "evidence": F.coalesce(F.col("evidence"), F.lit(""))}
    if "pred_sql_res" in df.columns:
        v["error_sql"] = F.col("pred_sql_res")[0]
        v["error_info"] = F.col("pred_sql_res")[1]
    else:
        v["error_sql"] = F.lit("")
        v["error_info"] = F.lit("")
    return v


def _task_col(task) -> Column:
    return F.lit(task) if isinstance(task, str) else task


def train_samples(df: DataFrame, task, english: bool = True, id_col: str = "id") -> DataFrame:
    """``(id, conversations, sql_type)``; the answer is ``\\n{sql}\\n```.``"""
    t = _task_col(task)
    prompt = prompt_for(t, _values(df), english)
    conv = F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")),
                   F.struct(F.lit("assistant").alias("role"),
                            F.concat(F.lit("\n"), F.col("sql"), F.lit("\n```")).alias("content")))
    return df.select(F.col(id_col).alias("id"), conv.alias("conversations"),
                     normalize_task(t).alias("sql_type"))


def test_samples(df: DataFrame, task, english: bool = True, id_col: str = "id") -> DataFrame:
    """As G2 with the bare SQL as answer, plus ``sql`` and ``db_name``."""
    t = _task_col(task)
    prompt = prompt_for(t, _values(df), english)
    conv = F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")),
                   F.struct(F.lit("assistant").alias("role"), F.col("sql").alias("content")))
    return df.select(F.col(id_col).alias("id"), conv.alias("conversations"),
                     normalize_task(t).alias("sql_type"), "sql", "db_name")


def self_refine_records(records: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Records whose prediction scored ``ex_eq = 0`` get
    ``pred_sql_res = [wrong SQL, execution text]``."""
    wrong = outcomes.where(F.col("ex_eq") == 0).select(
        "idx", F.array(F.col("pred_sql"), F.coalesce("exec_info", F.lit(""))).alias("pred_sql_res"))
    return records.join(wrong, "idx")


def selection_prompts(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """One prompt per record with its numbered candidates
    ``candidates(idx, cand_no, sql, exec_info)``; a record's candidates are
    its ensemble's answers (a few rows), gathered in ``cand_no`` order."""
    block = fill(TEMPLATES[("candidate", "zh")],
                 {"id": F.col("cand_no"), "sql": F.col("sql"), "exec_info": F.col("exec_info")})
    per = (candidates.select("idx", "cand_no", block.alias("txt"))
           .groupBy("idx").agg(F.array_sort(F.collect_list(F.struct("cand_no", "txt"))).alias("c")))
    per = per.select("idx", F.size("c").alias("num"),
                     F.array_join(F.transform("c", lambda x: x["txt"]), "\n\n").alias("candidates"),
                     F.array_join(F.transform("c", lambda x: x["cand_no"].cast("string")), "、").alias("items"))
    j = records.join(per, "idx")
    v = _values(records)
    v.update({"num": F.col("num"), "candidates": F.col("candidates"), "items": F.col("items")})
    return j.select("idx", fill(TEMPLATES[("selection", "zh")], v).alias("prompt"))
