"""The corpus pipeline: documents in, clean and encoded documents out.

``STAGES`` are (name, function) pairs. Each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``;
the last one returns each kept document's ids and the text decoded from them.

Defined results: a document with a null id is scored, encoded and kept (it is
never linked, cut or matched); null texts are empty texts; repeated rows share
one fate; stages pass extra columns of ``docs`` through; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import bpe, decontam, lines, minhash, toxicity
from quarry.llm.queries import learned_ids
from quarry.llm.store import keep, read_table
from quarry.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the factorization machine scores 0.5 or more."""
    ship_package(spark)
    machine = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), learned_ids)
    return toxicity.passing(docs, machine, 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The lines of repeated chunks are cut from all texts but the first; ``n_chars`` follows."""
    out = lines.dedup_lines(docs).drop("line_dedup")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group linked at five-word
    shingle similarity of 0.8 or more."""
    ship_package(spark)
    groups = minhash.groups(docs, minhash.Params(words=5))
    extra = groups.where("NOT kept").select(F.col("doc_id").alias("copy_id"))
    return docs.join(extra, docs["doc_id"].cast("long") == extra["copy_id"], "left_anti")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that overlap a benchmark item."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), decontam.Params(shortest=1))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the token ids of every kept document and
    the text they decode to. A smaller cache than usual, and the tables given back after
    each task: the processes also hold what the stages before left, and serve others."""
    ship_package(spark)
    return bpe.encode(docs, cache=60_000, release=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("encoding", encode),
]

#: The first stage is a learned model and the last a tokenizer: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
