"""Executed results as prompt text.

What a statement returned is shown as a prompt shows it: the first rows as they
were stored, or the first line of its error. All texts are rendered in one job:
the first rows of every text are kept by a window group limit, so a text with a
million stored rows sends ten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quarry.functions.cells import cell_value
from quarry.operators.execute import text_id

SHOWN = 10


def result_texts(outcomes: DataFrame, rows: DataFrame, n: int = SHOWN) -> DataFrame:
    """``(text_id, exec_info)`` for E3's ``outcomes`` and ``rows``: up to ``n``
    rows, one a line with values between bars (NULL for null), ``[]`` without
    rows; for a failed text its status and the first line of the message."""
    first = Window.partitionBy("text_id").orderBy("row_no")
    kept = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= n)
    line = F.array_join(F.transform("cells", lambda c: F.coalesce(cell_value(c), F.lit("NULL"))), " | ")
    shown = (kept.groupBy("text_id").agg(F.array_sort(F.collect_list(F.struct("_n", line.alias("line")))).alias("ls"))
             .select("text_id", F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("_rows")))
    failed = F.concat(F.col("status"), F.lit(": "), F.substring_index(F.coalesce("message", F.lit("")), "\n", 1))
    return outcomes.join(shown, "text_id", "left").select(
        "text_id", F.when(F.col("status") == "ok", F.coalesce("_rows", F.lit("[]"))).otherwise(failed).alias("exec_info"))


def refine_outcomes(pairs: DataFrame, scores: DataFrame, texts: DataFrame) -> DataFrame:
    """G4's input ``(idx, pred_sql, ex_eq, exec_info)``: every pair's prediction
    with its score and what running it gave. ``pairs``: (pair_id, db, pred_sql, ...)."""
    return (pairs.withColumn("text_id", text_id(F.col("db"), F.col("pred_sql"))).join(texts, "text_id", "left")
            .join(scores.select("pair_id", "ex_eq"), "pair_id", "left")
            .select(F.col("pair_id").alias("idx"), "pred_sql", F.coalesce("ex_eq", F.lit(0)).alias("ex_eq"), "exec_info"))


def candidates(answers: DataFrame, texts: DataFrame) -> DataFrame:
    """G5's input ``(idx, cand_no, sql, exec_info)`` from ``answers(idx, cand_no,
    db, sql)``; equal answers of a record are one candidate, the first."""
    named = answers.withColumn("text_id", text_id(F.col("db"), F.col("sql")))
    once = named.groupBy("idx", "text_id").agg(F.min(F.struct("cand_no", "sql")).alias("c"))
    order = Window.partitionBy("idx").orderBy("c.cand_no")  # an ensemble's answers: a few rows
    return (once.withColumn("cand_no", F.row_number().over(order)).join(texts, "text_id", "left")
            .select("idx", "cand_no", F.col("c.sql").alias("sql"), "exec_info"))
