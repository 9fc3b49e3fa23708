"""Cutting lineage through tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.session import scratch_path


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the folder named by ``spark.checkpoint.dir``
    and read it back: later steps re-read files that survive a lost executor
    instead of recomputing the plan above."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (long) and ``text`` (null read as empty), whatever other
    columns the table has."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def one_each(rows: DataFrame) -> DataFrame:
    """One row (doc_id, label, text) for each id: a grouped minimum by the text's
    hash, combined where the rows lie, so a hot id is one row per task."""
    return rows.groupBy("doc_id").agg(F.first("label").alias("label"), F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select(
        "doc_id", "label", F.col("t.text").alias("text"))


def crc_fold(id_col, n: int):
    """crc32 of the id written as text, modulo ``n`` (null id: null)."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(n))
