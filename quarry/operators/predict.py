"""Inference bookkeeping (I1-I4).  The model itself is a plug-in:
``predict_fn(list[str]) -> list[str]`` runs inside ``mapInPandas`` on Arrow
batches (``spark.sql.execution.arrow.maxRecordsPerBatch`` sets the batch).

A long run can be made as a stream over the stored inputs (:func:`predict_stream`):
each micro-batch's answers are written under its number and then noted in an
append-only log. A run that was killed goes on with the batch it was at, writes
that one again over what it left, and repeats no other."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batched_predict(df: DataFrame, predict_fn: Callable[[list[str]], list[str]],
                    prompt_col: str = "prompt", out_col: str = "pred_sql") -> DataFrame:
    """Add ``pred_sql`` from ``predict_fn`` applied batch by batch."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType())])

    def run(batches):
        for pdf in batches:
            preds = predict_fn(pdf[prompt_col].fillna("").tolist())
            if len(preds) != len(pdf):
                raise ValueError("predict_fn returned a different number of answers")
            yield pdf.assign(**{out_col: pd.Series(preds, index=pdf.index, dtype="object")})
    return df.mapInPandas(run, schema)


def resume_todo(inputs: DataFrame, saved: DataFrame, key: str = "idx",
                pred_col: str = "pred_sql") -> DataFrame:
    """Inputs that still lack a non-empty saved prediction."""
    done = saved.where(F.length(F.coalesce(F.col(pred_col), F.lit(""))) > 0).select(key)
    return inputs.join(done, key, "left_anti")


def resume_merge(saved: DataFrame, fresh: DataFrame, key: str = "idx", pred_col: str = "pred_sql") -> DataFrame:
    """Keep non-empty saved predictions, add the fresh ones."""
    kept = saved.where(F.length(F.coalesce(F.col(pred_col), F.lit(""))) > 0)
    return kept.unionByName(fresh.join(kept.select(key), key, "left_anti"), allowMissingColumns=True)


def head(df: DataFrame, max_samples: int | None, key: str = "idx") -> DataFrame:
    """The first ``max_samples`` rows by position."""
    return df if not max_samples or max_samples < 0 else df.where(F.col(key) < max_samples)


def restore_order(df: DataFrame, key: str = "idx") -> DataFrame:
    """I4: gather in input order."""
    return df.orderBy(key)


def gold_from_conversations(df: DataFrame) -> DataFrame:
    """The gold SQL of a test sample is the second turn's content."""
    return df.withColumn("sql", F.col("conversations")[1]["content"])


def predict_stream(inputs: DataFrame, predict_fn: Callable[[list[str]], list[str]], out_dir: str, prompt_col: str = "prompt",
                   out_col: str = "pred_sql", stop_at: int | None = None):
    """I1 + I2 on a streaming ``inputs``: the started query, which ends when all
    input that is there has been answered. ``stop_at`` fails the run before that
    batch (for tests)."""
    out_dir = out_dir.rstrip("/")

    def answer(batch: DataFrame, number: int) -> None:
        if stop_at is not None and number >= stop_at:
            raise RuntimeError(f"stopped before batch {number}")
        path = f"{out_dir}/answers/batch={number}"
        batched_predict(batch, predict_fn, prompt_col, out_col).write.mode("overwrite").parquet(path)
        n = batch.sparkSession.read.parquet(path).count()
        # a batch that was noted but not committed is noted again: readers take its number once
        batch.sparkSession.range(1).select(F.lit(number).cast("long").alias("batch"), F.lit(n).cast("long").alias("n_rows")).write.mode(
            "append").parquet(f"{out_dir}/log")

    return (inputs.writeStream.foreachBatch(answer).option("checkpointLocation", f"{out_dir}/checkpoint")
            .trigger(availableNow=True).start())


def predicted(spark, out_dir: str) -> DataFrame:
    """The answers of all batches that are noted in the log."""
    out_dir = out_dir.rstrip("/")
    noted = spark.read.schema("batch long, n_rows long").parquet(f"{out_dir}/log").select("batch").distinct()
    return spark.read.parquet(f"{out_dir}/answers").join(noted, "batch", "left_semi").drop("batch")
