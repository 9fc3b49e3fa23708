"""Cleaning model replies as they arrive (R1/R2/A5 on a stream).

The reply cleaners and the schema augmentation are row-local column
expressions (no cross-row state), so they run unchanged on a streaming
DataFrame: files landing in a folder are read with ``readStream``, cleaned,
and appended to Parquet with a checkpoint in the cluster's shared checkpoint
folder, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.augment import sql_tidy
from quarry.operators.responses import clean_sql, extract_sql
from quarry.session import scratch_path

REPLY_SCHEMA = T.StructType([
    T.StructField("idx", T.LongType()), T.StructField("sql", T.StringType()),
    T.StructField("pred_sql", T.StringType()),
])


def clean_replies(df: DataFrame) -> DataFrame:
    """The per-row cleaning applied to each arriving reply."""
    return df.select("idx", "sql", "pred_sql",
                     extract_sql("pred_sql").alias("extracted"),
                     clean_sql("pred_sql").alias("cleaned"),
                     sql_tidy("pred_sql").alias("tidy"))


def stream_clean(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str | None = None,
                 schema: T.StructType = REPLY_SCHEMA, max_files_per_trigger: int = 64,
                 available_now: bool = True):
    """Start a query reading Parquet replies from ``source_dir`` and
    appending cleaned rows to ``sink_dir``.  ``available_now`` processes what
    is there and stops (batch-like catch-up); otherwise it keeps running."""
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(source_dir))
    w = (clean_replies(src).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(sink_dir)
