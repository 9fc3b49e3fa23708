"""Accuracy summaries and evaluation bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLAGS = ["ex_eq", "ex_bird", "executable"]


def accuracy(scores: DataFrame, flags=FLAGS) -> DataFrame:
    """``100 * sum / num`` for each flag, over all rows."""
    return scores.agg(F.count(F.lit(1)).alias("n"),
                      *[F.round(100.0 * F.sum(f) / F.count(F.lit(1)), 6).alias(f"{f}_acc")
                        for f in flags])


def summary_by(scores: DataFrame, key: str = "db_name", flags=FLAGS) -> DataFrame:
    """E19 per ``key`` and overall (``rollup``; the overall row has key
    ``'ALL'``): total, count and percent of each flag."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in flags:
        aggs += [F.count_if(F.col(f) == 1).alias(f"{f}_n"),
                 F.round(100.0 * F.count_if(F.col(f) == 1) / F.count(F.lit(1)), 2).alias(f"{f}_pct")]
    r = scores.rollup(key).agg(F.grouping(key).alias("_g"), *aggs)
    return r.withColumn(key, F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col(key))).drop("_g")


def package_pairs(preds: DataFrame, golds: DataFrame, pred_col: str = "pred_sql",
                  post_process: bool = False) -> DataFrame:
    """E1 + E2: ``(idx, db, pred_sql, gold_sql)``; db = ``db_id`` else
    ``db_name``; gold = ``sql`` else ``SQL``; R1 applied to predictions only
    when asked (off by default, as in the original).  Pairing is a full outer
    join on ``idx``; an unmatched row is an error."""
    from quarry.operators.responses import extract_sql

    def pick(df, *names):
        cols = [F.nullif(F.col(n), F.lit("")) for n in names if n in df.columns]
        return F.coalesce(*cols) if cols else F.lit(None).cast("string")

    p = preds.select("idx", pick(preds, pred_col).alias("pred_sql"), F.lit(1).alias("_p"))
    if post_process:
        p = p.withColumn("pred_sql", extract_sql("pred_sql"))
    g = golds.select("idx", pick(golds, "db_id", "db_name").alias("db"),
                     pick(golds, "sql", "SQL").alias("gold_sql"), F.lit(1).alias("_g"))
    j = p.join(g, "idx", "full_outer")
    pairing = (F.when(F.col("_g").isNull(), "no_gold")
               .when(F.col("_p").isNull(), "no_pred").otherwise("ok"))
    return j.select("idx", "db", "pred_sql", "gold_sql", pairing.alias("pairing"))


def check_pairing(pairs: DataFrame) -> None:
    """Lengths must agree; raise when any row lacks its partner."""
    bad = pairs.where(F.col("pairing") != "ok").limit(1).count()
    if bad:
        raise ValueError("predictions and gold records do not pair up on idx")


def merge_results(pairs: DataFrame, scores: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Idx, db, question, pred, gold and the outcome flags, ordered
    by ``sql_idx``."""
    m = pairs.join(scores, "idx", "left")
    if records is not None and "question" in records.columns:
        m = m.join(records.select("idx", "question"), "idx", "left")
    return m.withColumn("sql_idx", F.col("idx"))


def sort_results(df: DataFrame) -> DataFrame:
    """E21."""
    return df.orderBy("sql_idx")


def inspect_predictions(df: DataFrame, prompt_col: str = "prompt", n: int | None = None) -> DataFrame:
    """The question cut out of the prompt - the first non-empty line
    after the last ``【Question】`` (templates also name the section in their
    instruction sentence, so the first occurrence is not the question);
    without the marker the first 200 characters (``...`` when cut).  ``n``
    keeps the first rows (a preview is the feature)."""
    from quarry.operators.responses import strip_ws
    text = F.col(prompt_col)
    pos = F.locate("【Question】", text)
    after = F.substring_index(text, "【Question】", -1)
    first = F.filter(F.split(after, "\n"), lambda l: F.length(strip_ws(l)) > 0)[0]
    fallback = F.when(F.length(text) > 200, F.concat(F.left(text, F.lit(200)), F.lit("..."))).otherwise(text)
    q = F.when(pos > 0, F.coalesce(strip_ws(first), F.lit(""))).otherwise(fallback)
    out = df.withColumn("question_text", q)
    return out.limit(n) if n else out
